"""Relevance judgments and retrieval metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_ws
from ..session import new_folder, stored
from ..sources.replica import read_csv, require_columns, require_rows
from .skew import ordered_rank

REQUIRED = ("query_id", "query_text", "relevant_chunk_id", "relevance_label")


def read_judgments(spark: SparkSession, path: str) -> DataFrame:
    """Judgment rows of a CSV file with ``row_no`` in file order."""
    return read_csv(spark, path, REQUIRED).withColumn("row_no", F.monotonically_increasing_id())


def _clean(name: str) -> Column:
    return strip_ws(F.coalesce(F.col(name).cast("string"), F.lit("")))


def clean_judgments(rows: DataFrame, split: str | None = None) -> DataFrame:
    """query_id, query_text, chunk_id, label of usable rows.

    Rows with a blank id or text are dropped; a split keeps rows of that split and rows
    without one; a label that is not a whole number counts as 0.
    """
    require_columns(rows, REQUIRED, "judgments")
    label = strip_ws(F.coalesce(F.col("relevance_label").cast("string"), F.lit("0"))).try_cast("int")
    out = rows.select(
        _clean("query_id").alias("query_id"),
        _clean("query_text").alias("query_text"),
        _clean("relevant_chunk_id").alias("chunk_id"),
        F.coalesce(label, F.lit(0)).alias("label"),
        *([_clean("split").alias("_split")] if "split" in rows.columns else []),
        *([F.col("row_no")] if "row_no" in rows.columns else []),
    )
    out = out.filter((F.col("query_id") != "") & (F.col("query_text") != "") & (F.col("chunk_id") != ""))
    if split and "_split" in out.columns:
        out = out.filter((F.col("_split") == "") | (F.col("_split") == split))
    return out.drop("_split")


def judged_queries(clean: DataFrame) -> DataFrame:
    """query_id and its first query_text (by ``row_no`` where the rows have it)."""
    pick = F.min_by("query_text", "row_no") if "row_no" in clean.columns else F.min("query_text")
    return clean.groupBy("query_id").agg(pick.alias("query_text"))


def judged_chunks(clean: DataFrame) -> DataFrame:
    """Greatest label per (query, chunk); labels of 0 and below are not kept."""
    return (
        clean.filter(F.col("label") > 0)
        .groupBy("query_id", "chunk_id")
        .agg(F.max("label").alias("label"))
    )


def _gain(label: Column, rank: Column) -> Column:
    return (F.pow(F.lit(2.0), label) - 1) / F.log2(rank + 1)


def labelled_hits(hits: DataFrame, judged: DataFrame, k: int) -> DataFrame:
    """First ``k`` hits of every query with their labels; 0 where there is no judgment."""
    top = hits.filter(F.col("pos") <= k)
    joined = top.join(judged, ["query_id", "chunk_id"], "left")
    return joined.withColumn("label", F.coalesce("label", F.lit(0)))


def per_query_metrics(
    hits: DataFrame, queries: DataFrame, judged: DataFrame, *, k: int = 10, threshold: int = 2
) -> DataFrame:
    """One row per judged query; a query without hits or without positive labels scores 0."""
    label = F.coalesce("label", F.lit(0))
    top = F.col("pos") <= k
    actual = (
        hits.select("query_id", "chunk_id", "pos")
        .join(judged, ["query_id", "chunk_id"], "left")
        .groupBy("query_id")
        .agg(
            F.count(F.lit(1)).alias("_hits"),
            F.sum(F.when(top, _gain(label, F.col("pos")))).alias("_dcg"),
            F.min(F.when(top & (label >= threshold), F.col("pos"))).alias("_first"),
        )
    )
    ideal = (
        ordered_rank(judged, ["query_id"], [F.desc("label")], "_rank", k)
        .groupBy("query_id")
        .agg(F.sum(_gain(F.col("label"), F.col("_rank"))).alias("_ideal"))
    )
    gold = judged.groupBy("query_id").agg(F.count(F.lit(1)).alias("_gold"))
    out = queries
    for part in (actual, ideal, gold):
        out = out.join(part, "query_id", "left")
    zero = F.lit(0.0)
    return out.select(
        "query_id",
        "query_text",
        F.coalesce("_gold", F.lit(0)).alias("num_gold_chunks"),
        F.coalesce("_hits", F.lit(0)).alias("retrieved_count"),
        F.when(F.col("_first").isNotNull(), 1.0).otherwise(0.0).alias("hit_rate"),
        F.coalesce(1.0 / F.col("_first"), zero).alias("mrr"),
        F.coalesce(F.when(F.col("_ideal") > 0, F.col("_dcg") / F.col("_ideal")), zero).alias("ndcg"),
    )


def mean_metrics(per_query: DataFrame, *, threshold: int = 2, split: str | None = None) -> DataFrame:
    """One row of means over all queries; 0 when there is none."""
    zero = F.lit(0.0)
    return per_query.agg(
        F.count(F.lit(1)).alias("queries_evaluated"),
        *[F.coalesce(F.avg(m), zero).alias(f"mean_{m}") for m in ("hit_rate", "mrr", "ndcg")],
    ).withColumns({"relevant_threshold": F.lit(threshold), "split": F.lit(split or "")})


def predictions(
    hits: DataFrame, queries: DataFrame, judged: DataFrame, *, k: int = 10
) -> DataFrame:
    """First ``k`` hits with gold label and a one-line preview of the text."""
    rows = labelled_hits(hits, judged, k).join(queries.select("query_id", "query_text"), "query_id")
    preview = F.translate(F.substring("chunk_text", 1, 300), "\n", " ")
    keep = [c for c in ("company_id", "company_name") if c in rows.columns]
    return rows.select(
        "query_id", "query_text", F.col("pos").alias("rank"), "chunk_id", *keep,
        F.col("label").alias("gold_label"),
        F.coalesce(preview, F.lit("")).alias("chunk_text_preview"),
    )


def evaluate(
    hits: DataFrame, judgments: DataFrame, *, k: int = 10, threshold: int = 2, split: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(per query, means, predictions) of hits against raw judgment rows; raises without any."""
    clean = require_rows(clean_judgments(judgments, split), "judgments")
    # Both are used several times below, and are far smaller than the judgment rows.
    folder = new_folder(judgments.sparkSession, "judged")
    queries, judged = stored(judged_queries(clean), f"{folder}/queries"), stored(judged_chunks(clean), f"{folder}/chunks")
    per_query = per_query_metrics(hits, queries, judged, k=k, threshold=threshold)
    return (
        per_query,
        mean_metrics(per_query, threshold=threshold, split=split),
        predictions(hits, queries, judged, k=k),
    )
