"""Replicated source tables: contract, guards, tombstones, change rows, readers and sinks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import compact, durable
from .snapshots import current, publish

DELETED = "_fivetran_deleted"
SYNCED = "_fivetran_synced"


def contract(owner: str = "house") -> dict[str, list[str]]:
    """Expected columns per source table. ``owner`` is the prefix of the tables' in-house columns."""
    return {
        "market_trends": [
            "company_id", "deal_id", "company_name", "website", "built_world", "climate_tech",
            "theme", "main_category", "subcategory", f"{owner}_impact_framework", "area",
            "deal_no", "deal_date", "deal_year", "invested_equity", "deal_size",
            "total_new_debt", "raised_to_date", f"{owner}_funding_round", "deal_type",
            "deal_type_2", "year_founded", "country", "city", "region", "bay_area",
            "dealcount", "last_updated", DELETED, SYNCED,
        ],
        "companies": ["company_id", "description"],
        "parsed_text": ["id", "website_parsed_text", "website_summary"],
        "company_verticals": ["company_id", "verticals", DELETED],
        "company_keywords": ["company_id", "keywords", DELETED],
        "deals_investors": ["deal_id", "investors", DELETED],
        "investors": ["investor_name", f"{owner}_ranking"],
        "taxonomy": [
            "company_id", "theme", "main_category", "subcategory", f"{owner}_impact_framework",
        ],
    }


def require_columns(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{name} is missing required columns: {missing}")
    return df


def require_table(spark: SparkSession, table: str) -> DataFrame:
    if not spark.catalog.tableExists(table):
        raise RuntimeError(f"upstream table {table} does not exist")
    return spark.table(table)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError(f"upstream table {name} has no rows")
    return df


def read_sources(
    spark: SparkSession, tables: dict[str, str], owner: str = "house"
) -> dict[str, DataFrame]:
    """Catalog tables by contract name, checked for the columns the jobs use."""
    wanted = contract(owner)
    return {
        name: require_columns(require_table(spark, table), wanted[name], table)
        for name, table in tables.items()
    }


def is_live(deleted: Column, null_is_live: bool) -> Column:
    return F.coalesce(deleted, F.lit(False)) == F.lit(False) if null_is_live else deleted == F.lit(False)


def live_rows(df: DataFrame, null_is_live: bool, deleted: str = DELETED) -> DataFrame:
    """Rows that are not tombstoned; strict mode also drops rows whose flag is NULL."""
    return df.filter(is_live(F.col(deleted), null_is_live))


def latest_changes(
    changes: DataFrame, key: Sequence[str], synced: str = SYNCED, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Newest change row per key, tombstones included."""
    order = [F.col(synced).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tiebreak]]
    w = Window.partitionBy(*key).orderBy(*order)
    return changes.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def upsert_by_key(
    target: DataFrame, changes: DataFrame, key: Sequence[str], deleted: str = DELETED
) -> DataFrame:
    """``target`` after applying one change row per key: replace, insert, or delete."""
    key = list(key)
    kept = target.join(changes.select(*key), key, "left_anti")
    return kept.unionByName(live_rows(changes, True, deleted).select(*target.columns))


BUCKETS = 64


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in key]), F.lit(buckets)).cast("int")


def _write_buckets(df: DataFrame, folder: str, key: Sequence[str], buckets: int) -> None:
    df.withColumn("_bucket", _bucket(key, buckets)).repartition("_bucket").write.partitionBy("_bucket").parquet(folder)


def write_keyed(df: DataFrame, path: str, key: Sequence[str], buckets: int = BUCKETS) -> None:
    """Write ``df`` as a table by key below ``path``: a folder per bucket of keys, published together.

    ``buckets`` holds for all later upserts; choose it so that a bucket is a few files.
    """
    folder = f"{path}/{uuid.uuid4().hex}"
    _write_buckets(df, folder, key, buckets)
    layout = [("schema", df.schema.json()), ("buckets", str(buckets))]
    publish(df.sparkSession, path, [*layout, *((f"bucket {b}", f"{folder}/_bucket={b}") for b in _filled(df.sparkSession, folder))])


def _filled(spark: SparkSession, folder: str) -> list[int]:
    """Buckets that a write has filled; at most as many as there are buckets."""
    if spark.read.schema("_bucket int").parquet(folder).isEmpty():
        return []
    return sorted(r["_bucket"] for r in spark.read.parquet(folder).select("_bucket").distinct().collect())


def read_keyed(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """The newest version of a table by key, or its buckets ``only``."""
    entries = dict(current(spark, path))
    schema = T.StructType.fromJson(json.loads(entries["schema"]))
    folders = [p for kind, p in entries.items() if kind.startswith("bucket ") and (only is None or int(kind.split()[1]) in only)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def upsert_keyed(spark: SparkSession, path: str, changes: DataFrame, key: Sequence[str], deleted: str = DELETED) -> None:
    """Apply one change row per key to a table by key, rewriting the buckets of the changed keys only.

    The new buckets are written beside the old ones and published together with the untouched folders, which
    keep their names: readers see all changes or none.
    """
    entries = dict(current(spark, path))
    buckets = int(entries["buckets"])
    changes = durable(changes)
    touched = [r[0] for r in changes.select(_bucket(key, buckets)).distinct().collect()]
    folder = f"{path}/{uuid.uuid4().hex}"
    _write_buckets(upsert_by_key(read_keyed(spark, path, touched), changes, key, deleted), folder, key, buckets)
    kept = [(kind, p) for kind, p in entries.items() if not (kind.startswith("bucket ") and int(kind.split()[1]) in touched)]
    publish(spark, path, [*kept, *((f"bucket {b}", f"{folder}/_bucket={b}") for b in _filled(spark, folder))])


def replace_table(df: DataFrame, table: str) -> None:
    """Full refresh; the new schema replaces the old one."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)


def replace_path(df: DataFrame, path: str) -> None:
    compact(df.write.mode("overwrite")).parquet(path)


def append_path(df: DataFrame, path: str) -> None:
    """Create if missing, then append."""
    compact(df.write.mode("append")).parquet(path)


def read_csv(spark: SparkSession, path: str, required: Sequence[str], *, multi_line: bool = True) -> DataFrame:
    """CSV with a header and string columns; with ``multi_line`` cells may span lines and a file is one task."""
    df = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path)
    return require_columns(df, required, path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
