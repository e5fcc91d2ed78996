from pyspark.sql import functions as F

from ledgerlens.operators import context as N
from ledgerlens.operators import results as C


def blocks(spark, texts, budget):
    df = spark.createDataFrame(
        [("q", i, f"c{i}", t) for i, t in enumerate(texts, 1)], "query_id string, pos int, chunk_id string, chunk_text string"
    )
    return [r["block"] for r in N.packed_blocks(df, max_context_chars=budget).orderBy("pos").collect()]


def test_budget(spark):
    # "[c1]\n" has five characters.
    assert blocks(spark, ["aaaaa", " ", "bbbbb", "ccccc"], 20) == ["[c1]\naaaaa", "[c3]\nbbbbb"]
    assert blocks(spark, ["aaaaa", "bbbbb"], 19) == ["[c1]\naaaaa"]
    # A block that does not fit ends the context, even if a later one would fit.
    assert blocks(spark, ["aaaaa", "b" * 50, "c"], 30) == ["[c1]\naaaaa"]
    assert blocks(spark, [None, ""], 30) == []


def test_answer_prompt_without_context(spark):
    queries = spark.createDataFrame([("q", "why"), ("r", "how")], "query_id string, normalized string")
    chunks = spark.createDataFrame([("q", 1, "c", " some\n text ")], "query_id string, pos int, chunk_id string, chunk_text string")
    out = dict(map(tuple, N.answer_prompt(chunks, queries).collect()))
    assert out["q"].startswith("## Sources\n[c]\nsome text\n## Question\nwhy\n## Task\n")
    assert out["r"].startswith("## Sources\n(none)\n## Question\nhow\n## Task\n")


def test_scoring_prompt_cuts_passages(spark):
    queries = spark.createDataFrame([("q", "why")], "query_id string, normalized string")
    chunks = spark.createDataFrame([("q", 2, "b", "z" * 20), ("q", 1, "a", "x")], "query_id string, pos int, chunk_id string, chunk_text string")
    text = N.scoring_prompt(chunks, queries, passage_chars=5).first()["scoring_prompt"]
    assert text.endswith("## Query\nwhy\n\n## Passages\n#1 x\n#2 zzzzz")


def test_model_scores_drop_wrong_lengths(spark):
    queries = spark.createDataFrame([("q", "why"), ("r", "bad")], "query_id string, normalized string")
    hits = spark.createDataFrame(
        [("q", 2, "bb"), ("q", 1, "a"), ("r", 1, "c")], "query_id string, pos int, chunk_text string"
    )
    make = lambda: lambda query, docs: [] if query == "bad" else [len(d) for d in docs]
    assert sorted(map(tuple, N.model_scores(hits, queries, make).collect())) == [("q", 1, 1.0), ("q", 2, 2.0)]


def test_best_chunk_per_company(spark):
    rows = [("q", 1, "x", " a ", 0.1), ("q", 2, "y", "b", 0.9), ("q", 3, "z", "a", 0.5), ("q", 4, "w", " ", 0.2), ("q", 5, "v", None, None)]
    df = spark.createDataFrame(rows, "query_id string, pos int, chunk_id string, company_id string, index_score double")
    for limit in (None, 10):
        out = C.best_per_company(df, limit=limit).orderBy("pos").collect()
        assert [(r["pos"], r["chunk_id"]) for r in out] == [(1, "z"), (2, "y"), (3, "w"), (4, "v")]


def test_citations(spark):
    answers = spark.createDataFrame([("q", "as in [a] and [ b ], [a] or [zz]"), ("r", "none")], "query_id string, answer string")
    chunks = spark.createDataFrame([("q", "a"), ("q", "b"), ("r", "zz")], "query_id string, chunk_id string")
    assert sorted(map(tuple, N.cited_chunks(answers, chunks).collect())) == [("q", "a", True), ("q", "b", True), ("q", "zz", False)]
    assert answers.select(F.lit(1)).count() == 2
