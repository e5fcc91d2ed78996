"""The queries of the operators on their whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, quality, sql
from .conversation_repair import damaged, repair, with_all
from .decontamination import contamination
from .embedding_dedup import near_vectors
from .exact_dedup import exact_groups
from .html_text import extracted
from .jaccard_join import similar_documents
from .line_dedup import dedup_lines
from .merkle_manifest import COLUMNS, folded, leaf_digest, manifest, path_digest
from .sampling import held_out
from .sentencepiece_codec import encode
from .suffix_dedup import remove_repeats
from .url_reputation import Rule, ascii_lower, filter_urls

URL_RULES = (
    Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"), Rule("net", "/es/", "block"), Rule("net", "/fr/", "block"),
)

#: Public vocabulary that the queries use; the operator takes any path.
SENTENCEPIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the blocks of lines that an earlier one has."""
    cut = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "lines_removed", "text")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.identified(docs.select("doc_id", "text"), language_id.learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", quality.accepted(F.col("score")).cast("int").alias("predicted"),
    )


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return similar_documents(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page; outcomes are the labels of the document that a url's path numbers."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max(F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 0).when(F.col("quality").isNotNull(), 1)).alias("bad")
    )
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    numbered = pages.withColumn("doc_id", F.expr("try_cast(nullif(regexp_extract(url, '/([0-9]{1,18})([^0-9/]|/$|$)', 1), '') AS BIGINT)"))
    judged = filter_urls(numbered.join(labels, "doc_id", "left"), URL_RULES, bad=F.col("bad"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, whether they are those of the sentencepiece library, and whether they decode to it."""
    encoded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), SENTENCEPIECE_MODEL)
    return encoded.select("doc_id", "n_tokens", "round_trip", "parity", "ids")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every document without its repeats."""
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.floor(F.length("spans") / 16).alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and path digest of every document; texts of a third are folded to lower case and found out."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    altered = leaf_digest(*(ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in COLUMNS))
    suspect = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, altered)
    tree = manifest(docs.withColumn("suspect", suspect), carry=["suspect"])
    found = tree.select(
        "doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("suspect", "leaf"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, kept row and digest of every document."""
    return exact_groups(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after damage."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return with_all(repair(damaged(rows)), rows)


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_line_dedup": (op1_line_dedup, None),
    "op2_html_text": (op2_html_text, None),
    "op3_language_id": (op3_language_id, None),
    "op4_quality": (op4_quality, None),
    "op5_embedding_dedup": (op5_embedding_dedup, sql.NEAR_VECTORS),
    "op6_jaccard_join": (op6_jaccard_join, None),
    "op7_url_filter": (op7_url_filter, sql.URL_FILTER),
    "op8_sentencepiece": (op8_sentencepiece, None),
    "op9_decontamination": (op9_decontamination, sql.DECONTAMINATION),
    "op10_suffix_dedup": (op10_suffix_dedup, None),
    "op11_merkle_manifest": (op11_merkle_manifest, sql.MERKLE_MANIFEST),
    "op12_exact_dedup": (op12_exact_dedup, sql.EXACT_DEDUP),
    "op13_conversation_repair": (op13_conversation_repair, sql.CONVERSATION_REPAIR),
}
