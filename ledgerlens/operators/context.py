"""Scoring prompts, context packing and answer prompts per query."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.payload import endpoint_scores, loose_json_object, payload_scores
from ..functions.text import normalize_text, strip_ws, tokens
from .ranking import collapse_parents, context_size, diversify, rerank
from .skew import ordered_rank

PASSAGE_CHARS = 2500
CONTEXT_CHARS = 14000

SCORING_HEAD = (
    "You grade search results. Give each numbered passage an integer grade: 100 settles the query, "
    "50 touches its topic, 0 has nothing to do with it.\n"
    'Reply with one JSON object whose key "scores" lists the grades in the order of the passages.\n'
)
ANSWER_HEAD = (
    "Write a short answer to the question. Every statement must come from one of the sources and end "
    "with its [id]. Where the sources are silent, say what is missing and stop there."
)


def _ordered_text(df: DataFrame, text: str, sep: str, out: str) -> DataFrame:
    """Texts of each query in list order; the callers' lists are cut to a fixed length."""
    parts = F.sort_array(F.collect_list(F.struct("pos", text)))
    return df.groupBy("query_id").agg(F.array_join(parts[text], sep).alias(out))


def scoring_prompt(
    hits: DataFrame, queries: DataFrame, *, text_col: str = "chunk_text", top_n: int = 50,
    head: str = SCORING_HEAD, passage_chars: int = PASSAGE_CHARS,
) -> DataFrame:
    """query_id, scoring_prompt: the first ``top_n`` passages, numbered, each cut for scoring."""
    text = F.substring(normalize_text(F.col(text_col)), 1, passage_chars)
    passages = hits.filter(F.col("pos") <= top_n).select(
        "query_id", "pos",
        F.concat(F.lit("#"), F.col("pos"), F.lit(" "), text).alias("_passage"),
    )
    joined = _ordered_text(passages, "_passage", "\n", "_passages")
    return joined.join(queries.select("query_id", "normalized"), "query_id").select(
        "query_id",
        F.concat(
            F.lit(head + "\n## Query\n"), "normalized", F.lit("\n\n## Passages\n"), "_passages"
        ).alias("scoring_prompt"),
    )


def response_scores(responses: DataFrame, response_col: str = "response") -> DataFrame:
    """(query_id, pos, new_score) rows from endpoint responses, else from ``{"scores": [..]}`` answers."""
    given = F.col(response_col)
    scores = F.coalesce(endpoint_scores(given), payload_scores(loose_json_object(given)))
    return responses.select("query_id", F.posexplode(scores).alias("_at", "new_score")).select(
        "query_id", (F.col("_at") + 1).alias("pos"), "new_score"
    )


Scorer = Callable[[str, list[str]], Sequence[float]]


def model_scores(
    hits: DataFrame, queries: DataFrame, make_scorer: Callable[[], Scorer], *,
    text_col: str = "chunk_text", top_n: int = 50,
) -> DataFrame:
    """(query_id, pos, new_score) from a scorer that sees one query and its first ``top_n`` texts."""
    schema = T.StructType(
        [
            T.StructField("query_id", T.StringType()),
            T.StructField("pos", T.IntegerType()),
            T.StructField("new_score", T.DoubleType()),
        ]
    )
    pool = hits.filter(F.col("pos") <= top_n).select(
        "query_id", F.struct("pos", normalize_text(F.col(text_col)).alias("text")).alias("_doc")
    )
    lists = (
        pool.groupBy("query_id")
        .agg(F.sort_array(F.collect_list("_doc")).alias("_docs"))
        .join(queries.select("query_id", "normalized"), "query_id")
        .select("query_id", "normalized", F.col("_docs.pos").alias("pos"), F.col("_docs.text").alias("text"))
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for pdf in batches:
            for qid, query, pos, texts in pdf.itertuples(index=False):
                scores = [float(s) for s in scorer(query, list(texts))]
                if len(scores) == len(pos):
                    yield pd.DataFrame({"query_id": qid, "pos": pos, "new_score": scores})

    return lists.mapInPandas(run, schema)


def overlap_scores(
    hits: DataFrame, queries: DataFrame, *, text_cols: Sequence[str] = ("chunk_text",), top_n: int = 50
) -> DataFrame:
    """(query_id, pos, new_score): share of distinct query tokens found in the given columns."""
    asked = queries.select("query_id", F.array_distinct(tokens(F.col("normalized"))).alias("_asked"))
    pool = hits.filter(F.col("pos") <= top_n).select(
        "query_id", "pos", tokens(F.concat_ws(" ", *text_cols)).alias("_seen")
    )
    found = F.size(F.array_intersect("_asked", "_seen"))
    return pool.join(asked, "query_id").select(
        "query_id", "pos", (found / F.greatest(F.size("_asked"), F.lit(1))).alias("new_score")
    )


def assemble_context(
    hits: DataFrame,
    scores: DataFrame | None = None,
    *,
    post_rerank: bool = True,
    top_n: int = 50,
    top_k: int = 10,
    collapse_per_parent: int = 6,
    max_per_parent: int = 3,
    max_context: int = 10,
) -> DataFrame:
    """Rerank (or cut), collapse per parent, diversify, and keep 5 to ``max_context`` chunks per query."""
    bound = max(1, int(top_k))
    ranked = rerank(hits, scores if post_rerank else None, top_n=top_n, top_k=top_k)
    collapsed = collapse_parents(ranked, collapse_per_parent, limit=bound)
    return diversify(collapsed, max_per_parent, limit=min(bound, context_size(top_k, max_context)))


def packed_blocks(
    chunks: DataFrame, *, text_col: str = "chunk_text", max_context_chars: int = CONTEXT_CHARS
) -> DataFrame:
    """query_id, pos, block: the leading ``[id]\\ntext`` blocks that fit the budget.

    A block has at least five characters, so a budget bounds how many can fit and only that
    many blocks of a query are summed up.
    """
    cid = normalize_text(F.coalesce(F.col("chunk_id"), F.lit("")))
    blocks = chunks.select("query_id", "pos", cid.alias("_cid"), normalize_text(F.col(text_col)).alias("_text"))
    blocks = blocks.filter(F.col("_text") != "").select(
        "query_id", "pos",
        F.concat(F.lit("["), F.when(F.col("_cid") == "", "unknown").otherwise(F.col("_cid")),
                 F.lit("]\n"), F.col("_text")).alias("block"),
    )
    leading = ordered_rank(blocks, ["query_id"], [F.asc("pos")], "_rn", max(1, max_context_chars // 5))
    running = Window.partitionBy("query_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = leading.withColumn("_used", F.sum(F.length("block")).over(running))
    return summed.filter(F.col("_used") <= max_context_chars).drop("_rn", "_used")


def answer_prompt(
    chunks: DataFrame, queries: DataFrame, *, text_col: str = "chunk_text",
    max_context_chars: int = CONTEXT_CHARS, head: str = ANSWER_HEAD,
) -> DataFrame:
    """query_id, answer_prompt for every query; '(none)' stands for an empty context."""
    blocks = packed_blocks(chunks, text_col=text_col, max_context_chars=max_context_chars)
    context = _ordered_text(blocks, "block", "\n\n", "_context")
    joined = queries.select("query_id", "normalized").join(context, "query_id", "left")
    return joined.select(
        "query_id",
        F.concat(
            F.lit("## Sources\n"), F.coalesce("_context", F.lit("(none)")), F.lit("\n## Question\n"),
            "normalized", F.lit("\n## Task\n" + head),
        ).alias("answer_prompt"),
    )


def cited_chunks(answers: DataFrame, chunks: DataFrame, answer_col: str = "answer") -> DataFrame:
    """query_id, chunk_id, in_context for every distinct ``[id]`` of an answer."""
    ids = F.array_distinct(
        F.transform(F.regexp_extract_all(F.col(answer_col), F.lit(r"\[([^\[\]]+)\]")), strip_ws)
    )
    cited = answers.select("query_id", F.explode(ids).alias("chunk_id"))
    known = chunks.select("query_id", "chunk_id").distinct().withColumn("in_context", F.lit(True))
    return cited.join(known, ["query_id", "chunk_id"], "left").select(
        "query_id", "chunk_id", F.coalesce("in_context", F.lit(False)).alias("in_context")
    )
