import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import payload as P
from ledgerlens.functions import text as X
from ledgerlens.functions import values as V
from ledgerlens.operators.embedding import hash_embedding
from ledgerlens.operators.understanding import understand


def each(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_normalize_text(spark):
    texts = [None, "", "  a \t b\n", "ｆｕｌｌ　ｗｉｄｔｈ", "a b", "ﬁn\x1cx", "café"]
    assert each(spark, texts, X.normalize_text) == ["", "", "a b", "full width", "a b", "fin x", "café"]


def test_strip_ws(spark):
    assert each(spark, ["  a b\n", "\n\n", "x\n", "\u0085y"], X.strip_ws) == ["a b", "", "x", "y"]


def test_language(spark):
    assert each(spark, ["", None, "plain", "é" * 2 + "a" * 8, "é" + "a" * 10], X.detect_language) == [
        "unknown", "unknown", "en", "unknown", "en",
    ]


def test_query_type(spark):
    texts = ["A vs B", "what differs", "How is it compared", "one two three", "", "one two three four", "whatever you say now"]
    assert each(spark, texts, X.detect_query_type) == [
        "comparison", "fact", "comparison", "entity", "entity", "broad", "broad",
    ]


def test_term_counts(spark):
    got = each(spark, ["b a B", "", None, "x_y 7é"], lambda c: X.term_counts(X.tokens(c)))
    pairs = [None if g is None else [(t["term"], t["tf"]) for t in g] for g in got]
    assert pairs == [[("a", 1), ("b", 2)], None, None, [("7é", 1), ("x", 1), ("y", 1)]]


def test_as_float(spark):
    texts = ["1,234", " -2.5e3 ", "nan", "Infinity", "abc", "", None, "1d", ".5", "1e999"]
    assert each(spark, texts, V.as_float) == [1234.0, -2500.0, None, None, None, None, None, None, 0.5, None]
    assert each(spark, ["-2.9", "2.9", "1e30"], V.as_int) == [-2, 2, None]
    assert each(spark, [float("nan"), float("inf"), 2.0], V.as_float, "double") == [None, None, 2.0]


def test_ranking_label(spark):
    got = each(spark, [None, 2.0, 2.5, 5.0, 6.0, math.nan], V.ranking_label, "double")
    assert got == ["Undefined", "High", "Medium", "Medium", "Low", "Undefined"]
    got = each(spark, [None, " ", "high", "UNDEFINED", "x" * 70], lambda c: V.ranking_label(c, numeric=False))
    assert got == ["Undefined", "Undefined", "High", "Undefined", "x" * 64]


def test_investor_list(spark):
    got = each(spark, ["a | b |  | c", "a|b", " x ", None], V.investor_list)
    assert got == ["a, b, c", "a|b", "x", ""]


def test_section(spark):
    assert each(spark, [None, " ", " x "], lambda c: V.section("L: ", c)) == [None, None, "L: x"]


def test_loose_json_object(spark):
    texts = [
        '{"a": 1}', '```json\n{"a": 1}\n```', 'so {"a": {"b": 2}} there', "[1, 2]", "nothing", "{broken}",
        None, "", '"{}"', '{"a": 1} {"b": 2}',
    ]
    got = each(spark, texts, P.loose_json_object)
    assert got == ['{"a": 1}', '{"a": 1}', '{"a": {"b": 2}}', None, None, None, None, None, None, None]


def test_assistant_text(spark):
    texts = [
        '{"choices": [{"message": {"content": "m"}}]}', '{"choices": [{"content": "c"}]}',
        '{"predictions": [{"content": "p"}]}', '{"predictions": ["s"]}', '{"data": ["d"]}',
        '{"choices": [{"message": {"content": 5}}], "data": [{"content": "x"}]}', "plain", '{"other": 1}',
    ]
    assert each(spark, texts, P.assistant_text) == ["m", "c", "p", "s", "d", "x", "plain", '{"other": 1}']


def test_response_vectors(spark):
    texts = [
        '{"predictions": [[1, 2], [3, 4]]}', '{"data": [{"embedding": [1, 2]}]}', '[[0.5]]',
        '{"outputs": [{"vector": [7]}]}', '{"output": [[8]]}', "{}",
    ]
    assert each(spark, texts, P.response_vectors) == [
        [[1.0, 2.0], [3.0, 4.0]], [[1.0, 2.0]], [[0.5]], [[7.0]], [[8.0]], None,
    ]


def test_payload_scores(spark):
    assert each(spark, ['{"scores": [1, "2.5"]}', '{"scores": ["x"]}', '{"scores": 3}', None], P.payload_scores) == [
        [1.0, 2.5], None, None, None,
    ]


def test_understand(spark):
    rows = [
        ("five", "Base  Query", '{"queries": ["a", "b", "c", "d", "e"], "filters": {"region": "ASIA"}}'),
        ("same", "x", '{"queries": [" x ", "ｙ", ""], "filters": {"theme": ["a", "b"], "none": null}}'),
        ("wrong", "q", '{"queries": "text", "filters": [1]}'),
        ("blank", " ", '{"queries": ["a"]}'),
        ("null", "z", None),
    ]
    df = spark.createDataFrame(rows, "query_id string, query_text string, response string")
    out = {r["query_id"]: r for r in understand(df, response_col="response").collect()}
    assert out["five"]["rewritten_queries"] == ["a", "b", "c", "d", "e"]
    assert out["five"]["filters"] == {"region": ["ASIA"]}
    assert out["same"]["rewritten_queries"] == ["x", "y"]
    assert out["same"]["filters"] == {"theme": ["a", "b"]}
    assert out["wrong"]["rewritten_queries"] == ["q"] and out["wrong"]["filters"] == {}
    assert out["blank"]["rewritten_queries"] == [] and out["blank"]["filters"] == {}
    assert out["null"]["rewritten_queries"] == ["z"]
    assert "Base Query" in out["five"]["rewrite_prompt"]


def test_hash_embedding_is_a_unit_vector(spark):
    got = each(spark, ["one two two", "", None], lambda c: hash_embedding(c, 16))
    assert got[1] is None and got[2] is None
    assert len(got[0]) == 16 and math.isclose(sum(x * x for x in got[0]), 1.0)
    assert sorted(got[0])[-1] == pytest.approx(2 / math.sqrt(5))


def test_endpoint_scores(spark):
    given = ['{"predictions": [{"score": 2}, {"other": 1}]}', '{"predictions": [1, 2.5]}', "[3, 4]", '{"scores": [1]}', "no", None]
    assert each(spark, given, P.endpoint_scores) == [[2.0, 0.0], [1.0, 2.5], [3.0, 4.0], None, None, None]
