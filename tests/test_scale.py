"""Steps that have to grow no faster than their input."""

import math
import re
from collections import Counter
from hashlib import md5

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import flows, ranking
from ledgerlens import session
from ledgerlens.functions import text as X
from ledgerlens.operators import postings as L
from ledgerlens.operators import semantic_text as T
from ledgerlens.operators import vectors as D
from ledgerlens.operators.embedding import hash_embedding


def plan(df):
    return df._jdf.queryExecution().toString()


def test_term_counts_of_many_rows(spark):
    texts = [None if i % 7 == 0 else " ".join(f"w{j * i % 11}" for j in range(i % 13)) for i in range(2500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    got = df.select("i", X.term_counts(X.tokens(F.col("t"))).alias("c")).orderBy("i")
    assert "ArrowEvalPython" in plan(got)
    want = [sorted(Counter((t or "").split()).items()) or None for t in texts]
    assert [None if r["c"] is None else [tuple(x) for x in r["c"]] for r in got.collect()] == want


def test_lists_are_made_where_chunks_are_read(spark):
    counts = [[("a", 2), ("b", 1)], None, [("a", 1)], [("a", 5)]]
    kind = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int32())]))
    rows = [None if c is None else [{"term": t, "tf": n} for t, n in c] for c in counts]
    batch = pa.record_batch([pa.array([4, 5, 6, 8]), pa.array([3, 0, 1, 5], pa.int32()), pa.array(rows, kind)], ["doc", "dl", "counts"])
    out = [r for b in L._slice_lists(2)(iter([batch])) for r in b.to_pylist()]
    found = {(r["term"], r["slice"]): (r["n"], r["max_tf"], r["min_dl"], [tuple(x.values()) for x in r["list"]]) for r in out}
    assert found == {("a", 1): (2, 2, 1, [(0, 2, 3), (2, 1, 1)]), ("b", 1): (1, 1, 3, [(0, 1, 3)]), ("a", 2): (1, 5, 5, [(0, 5, 5)])}


def test_hash_vectors_of_many_rows(spark):
    texts = ["Été été 42", "one two two", "...", None] + [f"w{i % 5} w{i % 3}" for i in range(1200)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    got = df.select("i", hash_embedding(F.col("t"), 16).alias("v")).orderBy("i")
    assert "ArrowEvalPython" in plan(got)

    def vector(text):
        n = [0.0] * 16
        for t in re.findall(r"\w+", (text or "").lower()):
            n[int(md5(t.encode()).hexdigest()[:8], 16) % 16] += 1
        norm = math.sqrt(sum(x * x for x in n))
        return [x / norm for x in n] if norm else None

    assert [r["v"] for r in got.collect()] == [vector(t) for t in texts]


def test_company_text_is_made_before_its_labels_repeat_it(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    sources = {
        "market_trends": frame([("c", "d", "France", None), ("e", None, None, None)], "company_id string, deal_id string, country string, region string"),
        "deals_investors": frame([], "deal_id string, investors string, _fivetran_deleted boolean"),
        "investors": frame([], "investor_name string, house_ranking int"),
        "companies": frame([("c", " text ")], "company_id string, description string"),
        "parsed_text": frame([], "id string, website_parsed_text string, website_summary string"),
        "company_verticals": frame([("c", "v1"), ("c", None), ("e", "v2")], "company_id string, verticals string"),
        "company_keywords": frame([("c", "k1"), ("c", " ")], "company_id string, keywords string"),
        "taxonomy": frame([], "company_id string, theme string, main_category string, subcategory string, house_impact_framework string"),
    }
    text = T.semantic_text(sources, fanout="keep")
    assert "_head" in plan(text)
    head, tail = "Description: text", "Geography: France"
    want = [("c", "\n\n".join(p for p in (head, v, k, tail) if p)) for v in ("Verticals: v1", None) for k in ("Keywords: k1", None)]
    assert sorted(map(tuple, text.collect())) == sorted([*want, ("e", "Verticals: v2")])


def test_small_corpus_is_scanned_by_all_cores(spark, tmp_path, monkeypatch):
    rows = [(f"c{i:03d}", [math.sin(i), math.cos(i), 1.0]) for i in range(200)]
    spark.createDataFrame(rows, "chunk_id string, embedding array<double>").coalesce(1).write.parquet(str(tmp_path / "v"))
    corpus = spark.read.parquet(str(tmp_path / "v"))
    blocks = D._dealt(D.packed(corpus, "chunk_id", "embedding", [], size=5, prefix="c_"), corpus)
    assert corpus.rdd.getNumPartitions() == 1 and sum(n > 0 for n in blocks.rdd.glom().map(len).collect()) > 4
    queries = corpus.where("chunk_id < 'c040'").withColumnRenamed("chunk_id", "query_id")
    hits = D.dense_topk(queries, corpus, 3, block_rows=5)
    want = sorted(map(tuple, hits.collect()))
    # A task may hold the hits of five queries: each pass meets a share of them, and none is lost.
    monkeypatch.setattr(D, "HELD_HITS", 15)
    assert sorted(map(tuple, D.dense_topk(queries, corpus, 3, block_rows=5).collect())) == want and len(want) == 120


def test_documents_arrive_in_several_files(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i} " * 50, "en" if i % 2 else "fr", f"src{i % 3}", 400) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    files = []

    def stop(spark, drops, *rest, **options):
        files.append(len(spark.read.parquet(drops).inputFiles()))
        raise InterruptedError

    monkeypatch.setattr(flows.sync, "run_available", stop)
    with pytest.raises(InterruptedError):
        flows.index_synced(spark, str(tmp_path))
    assert files[0] > 1


def test_work_is_dealt_by_bytes(spark, tmp_path):
    spark.range(20_000).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    cores, size = spark.sparkContext.defaultParallelism, session.plan_bytes(rows)
    # A table of more bytes than the cores' share gets as many tasks as its bytes need.
    assert session.spread_work(rows, "id", size // (4 * cores)).rdd.getNumPartitions() >= 4 * cores
    assert session.spread_work(rows, "id").rdd.getNumPartitions() == cores


def test_hit_lists_are_stored_by_column(spark, monkeypatch):
    hits = spark.createDataFrame(
        [("q", 1, 1, "a", 1.0, "p", 0, "x"), ("q", 1, 2, "a", 2.0, "p", 0, "y")],
        "query_id string, rewrite_no int, hit_no int, chunk_id string, score double, parent string, chunk_index int, chunk_text string",
    )
    monkeypatch.setattr(ranking, "view", lambda *_: hits)
    kept = ranking._deduped(spark, "")
    assert "ExistingRDD" not in plan(kept) and len(kept.select("query_id", "pos").inputFiles()) > 0
    assert [tuple(r) for r in kept.select(*ranking.HIT).collect()] == [("q", 1, "a", 2.0, "p", 0, "y")]
