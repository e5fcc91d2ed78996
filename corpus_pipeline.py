"""From raw documents to token ids: each stage takes what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import quality
from ledgerlens.llm.decontamination import contamination
from ledgerlens.llm.jaccard_join import similar_documents
from ledgerlens.llm.line_dedup import dedup_lines
from ledgerlens.llm.queries import SENTENCEPIECE_MODEL, table
from ledgerlens.llm.sentencepiece_codec import encode
from ledgerlens.session import new_folder, stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is learnt from these documents and the labels."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).where(quality.accepted(F.col("score"))).select(*docs.columns)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that earlier ones have; those that lose all go.

    n_chars counts what is left.
    """
    cut = dedup_lines(docs).where("lines_removed = 0 OR trim(text) <> ''")
    n_chars = F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group of near-duplicates; rows without id stay."""
    others = similar_documents(docs.select("doc_id", "text")).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(others.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold benchmark passages."""
    judged = contamination(docs, table(spark, sf_dir, "benchmark"), carry=docs.columns)
    return judged.where(~F.col("contaminated")).select("row.*")


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left."""
    return encode(docs.select("doc_id", "lang", "source", "text"), SENTENCEPIECE_MODEL).select(
        "doc_id", "lang", "source", "n_tokens", "round_trip", "ids"
    )


STAGES = [
    ("quality", keep_quality), ("line_dedup", cut_lines), ("jaccard_join", keep_one_of_group),
    ("decontamination", drop_contaminated), ("sentencepiece", to_tokens),
]

#: Learnt scores, alignments and subword merges have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each keeps is written to the shared folder and read again."""
    docs, folder = table(spark, sf_dir, "documents"), new_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
