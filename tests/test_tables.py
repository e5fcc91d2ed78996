"""Replicated sources, silver and gold tables, checks and incremental sync on hand-made rows."""

import datetime as dt
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlens import session
from ledgerlens.operators import gold as G
from ledgerlens.operators import investors as I
from ledgerlens.operators import quality as Q
from ledgerlens.operators import semantic_text as S
from ledgerlens.operators.chunking import chunk
from ledgerlens.sources import replica as R
from ledgerlens.sources.snapshots import current
from ledgerlens.streaming import sync

FLAG = R.DELETED


@pytest.fixture(scope="module")
def src(spark):
    columns = R.contract("own")["market_trends"]
    kinds = {
        "deal_no": "int", "deal_year": "int", "year_founded": "int", "dealcount": "int", "deal_date": "date",
        "invested_equity": "double", "deal_size": "double", "total_new_debt": "double", "raised_to_date": "double",
        "built_world": "boolean", "climate_tech": "boolean", "bay_area": "boolean", FLAG: "boolean",
        "last_updated": "timestamp", R.SYNCED: "timestamp",
    }
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in columns)

    def deal(**given):
        return tuple(given.get(c) for c in columns)

    deals = [
        deal(company_id="c1", deal_id="d1", company_name="One", country="FR", region="EU", deal_date=dt.date(2020, 1, 1), **{FLAG: False}),
        deal(company_id="c1", deal_id="d2", company_name="One", country="", region="EU", deal_date=dt.date(2021, 1, 1), **{FLAG: None}),
        deal(company_id="c2", deal_id="d3", country=None, region=None, deal_date=dt.date(2021, 1, 1), **{FLAG: True}),
        deal(company_id="c3", deal_id="d4", website="w3", country="FR", region=None, **{FLAG: False}),
        deal(company_id="c0", deal_id="d4", website="w0", **{FLAG: False}),
        deal(company_id=None, deal_id="d5", **{FLAG: False}),
    ]
    make = spark.createDataFrame
    return {
        "market_trends": make(deals, schema),
        "companies": make([("c1", " about one "), ("c2", "  ")], "company_id string, description string"),
        "parsed_text": make([("c3", "web", None)], "id string, website_parsed_text string, website_summary string"),
        "company_verticals": make(
            [("c1", " b ", False), ("c1", "a", None), ("c1", "gone", True), ("c1", " ", False), ("c1", "b", False)],
            f"company_id string, verticals string, {FLAG} boolean",
        ),
        "company_keywords": make([("c1", "k", False)], f"company_id string, keywords string, {FLAG} boolean"),
        "deals_investors": make(
            [("d1", "Ann (lead)", False), ("d1", "Bob", False), ("d1", "Ann (again)", None), ("d2", "Cid (x)", False),
             ("d2", "Dee", True), ("d3", "Nobody (x)", False), ("d4", "Bob (y) (z)", False), ("d4", None, False)],
            f"deal_id string, investors string, {FLAG} boolean",
        ),
        "investors": make(
            [("Ann", 1), ("Bob", None), ("Cid", 3), ("Dee", 2)], "investor_name string, own_ranking int"
        ),
        "taxonomy": make(
            [("c1", "T", "", None, "F")],
            "company_id string, theme string, main_category string, subcategory string, own_impact_framework string",
        ),
    }


def ranked(src, **options):
    return I.ranked_investors(src["deals_investors"], src["investors"], owner="own", **options)


def test_tombstones(src):
    rows = src["deals_investors"]
    assert R.live_rows(rows, null_is_live=False).count() == 6
    assert R.live_rows(rows, null_is_live=True).count() == 7


def test_ranked_investors(src):
    assert sorted(map(tuple, ranked(src).collect()), key=str) == [
        ("d1", "Ann", 1), ("d1", "Bob", None), ("d2", "Cid", 3), ("d4", "Bob", None),
    ]
    assert ranked(src, null_is_live=True).filter("deal_id = 'd1' AND investor_name = 'Ann'").count() == 2


def test_all_investors(src):
    out = I.all_investors(src["market_trends"], src["deals_investors"], src["investors"])
    assert dict(map(tuple, out.collect())) == {
        "c1": "Ann, Bob, Cid, Dee", "c2": None, "c3": "Bob", "c0": "Bob",
    }


def test_semantic_text(src):
    out = {r["company_id"]: r["semantic_text"] for r in S.semantic_text(src, owner="own").collect()}
    assert out["c1"] == "\n\n".join([
        "Description: about one", "Verticals: a, b, gone", "Keywords: k", "Investors: Ann, Bob, Cid, Dee",
        "High-quality investors: Ann", "Low-quality investors: Cid", "Untracked investors: Bob",
        "own Taxonomy — theme: T", "own Taxonomy — OWN impact framework: F", "Geography: , EU; FR, EU",
    ])
    # Deal d4 counts for the greatest of its companies only.
    assert out["c3"] == "Website content: web\n\nInvestors: Bob\n\nUntracked investors: Bob\n\nGeography: FR"
    assert out["c0"] == "Investors: Bob"
    assert out["c2"] == ""
    raw = S.semantic_text(src, owner="own", fanout="keep").groupBy("company_id").count()
    assert {r["company_id"]: r["count"] for r in raw.collect()} == {"c0": 1, "c1": 5, "c2": 1, "c3": 1}


@pytest.fixture(scope="module")
def pieces(spark):
    chunks = spark.createDataFrame(
        [(f"{c}-{i}", c, i, f"text {c} {i}") for c in ("c1", "c2", "c3", "new") for i in range(2)] + [("x", None, 0, "t")],
        "chunk_id string, company_id string, chunk_index int, chunk_text string",
    )
    vectors = spark.createDataFrame(
        [("c1-0", "c1", 0, [1.0]), ("c1-1", "c1", 9, [1.0])],
        "chunk_id string, company_id string, chunk_index int, embedding array<double>",
    ).withColumns({"embedding_endpoint": F.lit("e"), "embedded_at": F.lit(None).cast("timestamp")})
    return chunks, vectors


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_gold(spark, src, pieces, broadcast):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        def gold(deals):
            return G.gold_chunks(
                *pieces, src["market_trends"], src["company_verticals"], src["company_keywords"],
                ranked(src), owner="own", deals=deals,
            ).collect()

        every, latest = gold("all"), gold("latest")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # All deals of c2 are tombstoned; "new" has none.
    assert sorted((r["chunk_id"], r["deal_id"] or "") for r in every) == [
        ("c1-0", "d1"), ("c1-0", "d2"), ("c1-1", "d1"), ("c1-1", "d2"), ("c3-0", "d4"), ("c3-1", "d4"),
        ("new-0", ""), ("new-1", ""), ("x", ""),
    ]
    assert sorted((r["chunk_id"], r["deal_id"] or "") for r in latest) == [
        ("c1-0", "d2"), ("c1-1", "d2"), ("c3-0", "d4"), ("c3-1", "d4"), ("new-0", ""), ("new-1", ""), ("x", ""),
    ]
    first = next(r for r in every if r["chunk_id"] == "c1-0" and r["deal_id"] == "d1")
    assert first["embedding"] == [1.0] and first["verticals_array"] == ["a", "b"] and first["keywords_text"] == "k"
    assert (first["investor_names"], first["best_investor_rank"], first["investor_count"]) == ("Ann | Bob", 1, 2)
    assert first["display_title"] == "One"
    assert first["search_text"] == "One" + " " * 6 + "FR  EU" + " " * 4 + "a b k text c1 0"
    assert next(r for r in every if r["chunk_id"] == "c1-1")["embedding"] is None
    assert {r["display_title"] for r in every if r["company_id"] == "c3"} == {"w3"}
    assert {r["display_title"] for r in every if r["company_id"] == "new"} == {"Unknown Company"}


def test_checks(spark, src, tmp_path):
    trends = src["market_trends"]
    path = str(tmp_path / "checks")
    R.append_path(Q.key_count_check(trends, trends.filter("company_id <> 'c1'"), "company_id", "n"), path)
    with pytest.raises(RuntimeError, match="4 source keys, 3 derived keys"):
        Q.require_pass(spark.read.parquet(path), "n")
    R.append_path(Q.key_count_check(trends, trends, "company_id", "n"), path)
    Q.require_pass(spark.read.parquet(path), "n")
    with pytest.raises(RuntimeError, match="no result"):
        Q.require_pass(spark.read.parquet(path), "other")


def test_guards(spark):
    with pytest.raises(RuntimeError, match="does not exist"):
        R.require_table(spark, "no_such_table")
    with pytest.raises(RuntimeError, match="no rows"):
        R.require_rows(spark.range(0), "empty")
    spark.createDataFrame([("c1", "d")], "company_id string, description string").write.mode("overwrite").saveAsTable("profiles")
    assert R.read_sources(spark, {"companies": "profiles"})["companies"].count() == 1
    R.replace_table(spark.createDataFrame([("c1",)], "company_id string"), "profiles")
    with pytest.raises(ValueError, match="description"):
        R.read_sources(spark, {"companies": "profiles"})


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    changes = spark.createDataFrame([("b", 20, False), ("c", 30, True), ("d", 40, None)], f"k string, v int, {FLAG} boolean")
    assert sorted(map(tuple, R.upsert_by_key(target, changes, ["k"]).collect())) == [("a", 1), ("b", 20), ("d", 40)]


def test_sync_equals_rebuild(spark, tmp_path):
    schema = f"company_id string, semantic_text string, {FLAG} boolean, {R.SYNCED} timestamp"
    t = lambda n: dt.datetime(2024, 1, n)
    drops = [
        [("a", "one\n\ntwo", False, t(1)), ("b", "bee", False, t(2)), ("a", "older", False, t(1))],
        [("b", "bee gone", True, t(4)), ("c", "sea", None, t(3)), ("a", "new a", False, t(5))],
        [("a", "late and old", False, t(2)), ("b", "bee older", False, t(3)), ("d", "dee", False, t(1))],
    ]
    source, root, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for rows in drops:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        sync.run_available(
            spark, source, spark.createDataFrame(rows, schema).schema, root, progress, "company_id", chunk,
            tiebreak=["semantic_text"],
        )
    got = sync.current_rows(spark, root, "company_id")
    assert sorted((r["company_id"], r["chunk_text"]) for r in got.collect()) == [
        ("a", "new a"), ("c", "sea"), ("d", "dee"),
    ]
    # A batch that runs twice changes nothing.
    sync.write_batch(spark.createDataFrame(drops[2], schema), 2, root, "company_id", chunk, ["semantic_text"])
    assert sync.current_rows(spark, root, "company_id").count() == 3


def test_sync_stopped_before_its_version(spark, tmp_path, monkeypatch):
    """Readers see a batch whole or not at all; a batch that is run again is published once."""
    schema = f"company_id string, semantic_text string, {FLAG} boolean, {R.SYNCED} timestamp"
    root, at = str(tmp_path / "out"), lambda n: dt.datetime(2024, 1, n)
    first = spark.createDataFrame([("a", "one", False, at(1)), ("b", "two", False, at(1))], schema)
    second = spark.createDataFrame([("a", "new\n\n" + "x" * 90, False, at(2)), ("b", "gone", True, at(2))], schema)

    def texts():
        return sorted(r["chunk_text"] for r in sync.current_rows(spark, root, "company_id").collect())

    sync.write_batch(first, 0, root, "company_id", chunk)

    def stopped(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(sync, "publish", stopped)
        with pytest.raises(RuntimeError, match="stopped"):
            sync.write_batch(second, 1, root, "company_id", chunk)
    assert texts() == ["one", "two"]
    for _ in range(2):
        sync.write_batch(second, 1, root, "company_id", chunk)
        assert texts() == ["new\n\n" + "x" * 90]
    assert len([k for k, _ in current(spark, root) if k == "rows"]) == 2


def test_sync_restarts_from_batch_0(spark, tmp_path):
    """A new progress folder counts its batches from 0 again and leaves the old ones alone; compaction keeps what counts."""
    schema = f"company_id string, semantic_text string, {FLAG} boolean, {R.SYNCED} timestamp"
    root, at = str(tmp_path / "out"), lambda n: dt.datetime(2024, 1, n)
    drops = {
        "first": [("a", "one", False, at(1)), ("b", "two", False, at(5)), ("c", "sea", False, at(1))],
        "second": [("a", "uno", False, at(2)), ("b", "late", False, at(3)), ("c", "sea", True, at(2))],
        "third": [("b", "later", False, at(4)), ("c", "older", False, at(1)), ("d", "new", False, at(1))],
    }
    for name, rows in drops.items():
        df = spark.createDataFrame(rows, schema)
        df.coalesce(1).write.parquet(str(tmp_path / name))
        sync.run_available(spark, str(tmp_path / name), df.schema, root, str(tmp_path / f"progress-{name}"), "company_id", chunk)
        if name == "second":
            sync.compact(spark, root, "company_id")
            assert len(current(spark, root)) == 2
    got = sorted((r["company_id"], r["chunk_text"]) for r in sync.current_rows(spark, root, "company_id").collect())
    assert got == [("a", "uno"), ("b", "two"), ("d", "new")]


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path, rows = str(tmp_path / "keyed"), {f"k{i}": i for i in range(200)}
    R.write_keyed(spark.createDataFrame(list(rows.items()), "k string, v int").repartition(5), path, ["k"], buckets=16)
    before = dict(current(spark, path))
    changes = [("k7", 70, False), ("k8", 80, True), ("new", 1, None)]
    R.upsert_keyed(spark, path, spark.createDataFrame(changes, f"k string, v int, {FLAG} boolean"), ["k"])
    rows = {k: v for k, v in rows.items() if k != "k8"} | {"k7": 70, "new": 1}
    assert sorted(map(tuple, R.read_keyed(spark, path).collect())) == sorted(rows.items())
    after = dict(current(spark, path))
    assert 1 <= sum(before[b] != after.get(b) for b in before) <= 3 and set(before) <= set(after)
    # A bucket that loses its last row, and a table that does.
    gone = spark.createDataFrame([(k, v, True) for k, v in rows.items()], f"k string, v int, {FLAG} boolean")
    R.upsert_keyed(spark, path, gone, ["k"])
    assert R.read_keyed(spark, path).count() == 0
    R.upsert_keyed(spark, path, spark.createDataFrame([("z", 3, None)], f"k string, v int, {FLAG} boolean"), ["k"])
    assert [tuple(r) for r in R.read_keyed(spark, path).collect()] == [("z", 3)]
    empty = str(tmp_path / "empty")
    R.write_keyed(spark.createDataFrame([], "k string, v int"), empty, ["k"])
    assert R.read_keyed(spark, empty).columns == ["k", "v"]


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_tables_are_small_and_shuffles_go(spark, tmp_path):
    """A stage that is written leaves neither shuffle files nor tables in the default codec."""
    before = shuffle_files(spark)
    R.replace_path(spark.range(2000).withColumn("t", F.col("id").cast("string")).repartition(7, "id"), str(tmp_path / "t"))
    made = shuffle_files(spark) - before
    assert made
    for _ in range(50):
        session.release(spark)
        if not made & shuffle_files(spark):
            break
        time.sleep(0.2)
    assert not made & shuffle_files(spark)
    part = next((tmp_path / "t").glob("part-*.parquet"))
    assert pq.read_metadata(part).row_group(0).column(0).compression == "ZSTD"
    kept = session.new_folder(spark, "gone")
    session.stored(spark.range(3), kept)
    session.remove(spark, kept)
    assert not Path(kept.removeprefix("file:")).exists()


def test_a_batch_keeps_no_copy_of_its_changes(spark, tmp_path):
    at, root = dt.datetime(2024, 1, 1), str(tmp_path / "synced")
    changes = spark.createDataFrame([("a", "x" * 50, False, at), ("b", "y", True, at)], f"company_id string, chunk_text string, {R.DELETED} boolean, {R.SYNCED} timestamp")
    folder = Path(session.shared_folder(spark).removeprefix("file:"))
    before = {p.name for p in folder.rglob("*") if p.name.startswith(("changes-", "rdd-"))}
    plans = []
    sync.write_batch(changes, 0, root, "company_id", lambda rows: rows.select("company_id", "chunk_text"), on_batch=lambda parents, rows: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()))
    later = {p.name for p in folder.rglob("*") if p.name.startswith(("changes-", "rdd-"))} - before
    assert not any(name.startswith("changes-") for name in later)
    assert "Join" not in plans[0]  # every parent's newest change is here, so no text moves
    assert [tuple(r) for r in sync.current_rows(spark, root, "company_id").collect()] == [("a", "x" * 50)]
