"""Metrics against a plain restatement, and the CSV path."""

import math
import random

import pytest

from ledgerlens.operators import evaluation as V
from ledgerlens.sources import replica as R


def gain(labels):
    return sum((2**rel - 1) / math.log2(i + 1) for i, rel in enumerate(labels, 1))


def judge(rows, split):
    texts, labels = {}, {}
    for qid, text, cid, label, s in rows:
        qid, text, cid = ((x or "").strip() for x in (qid, text, cid))
        if not (qid and text and cid) or (split and (s or "").strip() not in ("", split)):
            continue
        texts.setdefault(qid, text)
        try:
            value = int((label or "0").strip())
        except ValueError:
            value = 0
        if value > labels.setdefault(qid, {}).get(cid, 0):
            labels[qid][cid] = value
    return texts, labels


def make(seed):
    rng = random.Random(seed)
    gold = [
        (rng.choice(["q1", " q2", "q3 ", "q4", "", None]), rng.choice(["text a", "text b", " "]),
         rng.choice(["c1", "c2", "c3", "c4", "c5", None]), rng.choice(["0", "1", " 2", "3", "x", None, "-1"]),
         rng.choice([None, "", "dev", "test"]))
        for _ in range(60)
    ]
    hits = []
    for q in ("q1", "q2", "q3", "zz"):
        chunks = rng.sample(["c1", "c2", "c3", "c4", "c5", "c6"], rng.randint(1, 6))
        hits += [(q, i, c, f"line one\nof {c}") for i, c in enumerate(chunks, 1)]
    return gold, hits


@pytest.mark.parametrize("seed,split,k", [(1, None, 3), (2, "dev", 2), (3, "test", 10)])
def test_metrics(spark, tmp_path, seed, split, k):
    gold, hits = make(seed)
    path = tmp_path / "gold.csv"
    import csv

    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(["query_id", "query_text", "relevant_chunk_id", "relevance_label", "split", "notes"])
        out.writerows([["" if x is None else x for x in r] + ['a "note",\nover lines'] for r in gold])
    frame = spark.createDataFrame(hits, "query_id string, pos int, chunk_id string, chunk_text string")
    per_query, means, predicted = V.evaluate(frame, V.read_judgments(spark, str(path)), k=k, split=split)
    texts, labels = judge(gold, split)
    want = {}
    for q in texts:
        listed = [h[2] for h in hits if h[0] == q]
        own = labels.get(q, {})
        found = [own.get(c, 0) for c in listed[:k]]
        ideal = gain(sorted(own.values(), reverse=True)[:k])
        first = next((i for i, x in enumerate(found, 1) if x >= 2), None)
        want[q] = (
            texts[q], len(own), len(listed), 1.0 if first else 0.0, 1 / first if first else 0.0,
            pytest.approx(gain(found) / ideal if ideal else 0.0),
        )
    assert {r[0]: tuple(r)[1:] for r in per_query.collect()} == want
    row = means.first()
    assert row["queries_evaluated"] == len(want)
    assert row["mean_mrr"] == pytest.approx(sum(w[4] for w in want.values()) / len(want))
    assert {(r["query_id"], r["rank"], r["chunk_id"], r["gold_label"]) for r in predicted.collect()} == {
        (h[0], h[1], h[2], labels.get(h[0], {}).get(h[2], 0)) for h in hits if h[0] in texts and h[1] <= k
    }
    assert all("\n" not in r["chunk_text_preview"] for r in predicted.collect())


def test_no_queries_gives_zero_means(spark):
    empty = spark.createDataFrame([], "query_id string, query_text string, hit_rate double, mrr double, ndcg double")
    row = V.mean_metrics(empty).first()
    assert (row["queries_evaluated"], row["mean_ndcg"]) == (0, 0.0)


def test_missing_columns(spark, tmp_path):
    R.write_csv(spark.createDataFrame([("a",)], "query_id string"), str(tmp_path / "x"))
    with pytest.raises(ValueError, match="query_text"):
        V.read_judgments(spark, str(tmp_path / "x"))


def test_no_usable_judgments(spark):
    rows = spark.createDataFrame([("", "t", "c", "1")], ", ".join(f"{c} string" for c in V.REQUIRED))
    hits = spark.createDataFrame([("q", 1, "c", "x")], "query_id string, pos int, chunk_id string, chunk_text string")
    with pytest.raises(RuntimeError, match="no rows"):
        V.evaluate(hits, rows)
