"""Operators on single texts, pages and urls, and the registered queries with their SQL."""

import os
import random
import sys

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import rows as sorted_rows
from checks.views import TABLES
from ledgerlens.llm import html_text as H
from ledgerlens.llm import language_id, quality
from ledgerlens.llm import sentencepiece_codec as SP
from ledgerlens.llm.decontamination import contamination
from ledgerlens.llm.queries import QUERIES, SENTENCEPIECE_MODEL
from ledgerlens.llm.url_reputation import Rule, filter_urls, host_reputation
from ledgerlens.session import stored

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_same_rows(spark, con, name):
    run, sql = QUERIES[name]
    df, cur = run(spark, SF_DIR), con.execute(sql)
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted_rows(df.columns, map(tuple, df.collect())) == sorted_rows(columns, cur.fetchall())


# urls

RULES = (Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"))


def test_rules_and_parts(spark):
    urls = [
        None, "no scheme", "http://WWW.Example.com/en/x?y#z", "https://a.example.com/en/", "ftp://example.com", "x://com/", "http://notexample.com/en/",
        "http://h.org?a://b", "://p.net#x", "",
    ]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, "http://z.com/", "h")], "page_id int, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(df, RULES).collect()}
    assert got == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        3: ("a.example.com", "/en/", "example.com/en/", "block"), 4: ("example.com", "", None, "allow"), 5: ("com", "/", "com/", "allow"),
        6: ("notexample.com", "/en/", "com/", "allow"), 7: ("h.org", "", None, "allow"), 8: ("p.net", "", None, "allow"), 9: ("", "", None, "allow"),
        None: ("z.com", "/", "com/", "allow"),
    }
    assert filter_urls(df.limit(0), RULES).count() == 0


def test_reputation_shrinks_small_hosts(spark):
    rows = [("bad.spam.org", 1)] * 80 + [("worse.spam.org", 1)] * 60 + [("new.spam.org", None)] + [("one.fine.org", 1)] + [("big.fine.org", 0)] * 200 + [("c.co.uk", 0)] * 5
    got = {r.host: r for r in host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert got["bad.spam.org"].bound > 0.5 and got["new.spam.org"].rate > 0.5
    assert got["new.spam.org"].bound < got["bad.spam.org"].bound
    assert got["one.fine.org"].bound < 0.25 and got["big.fine.org"].rate < 0.05
    assert host_reputation(spark.createDataFrame([], "host string, bad int")).count() == 0


def test_reputation_decides_pages_without_a_rule(spark):
    rows = [(f"http://bad.spam.org/{i}", 1) for i in range(80)] + [(f"http://worse.spam.org/{i}", 1) for i in range(60)]
    rows += [(f"http://big.fine.org/{i}", 0) for i in range(200)] + [("http://new.spam.org/x", None), ("http://new.fine.org/x", None), ("http://bad.spam.org/en/y", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, bad int")
    got = filter_urls(df, [Rule("bad.spam.org", "/en/", "allow")], bad=F.col("bad"))
    verdicts = {(r.host, r.rule, r.verdict): r["count"] for r in got.groupBy("host", "rule", "verdict").count().collect()}
    bound = {r.host: r.bound for r in got.select("host", "bound").distinct().collect()}
    assert verdicts[("bad.spam.org", None, "block")] == 80 and verdicts[("worse.spam.org", None, "block")] == 60
    assert verdicts[("big.fine.org", None, "allow")] == 200 and verdicts[("bad.spam.org", "bad.spam.org/en/", "allow")] == 1
    for host in ("new.spam.org", "new.fine.org"):
        assert verdicts[(host, None, "block" if bound[host] > 0.25 else "allow")] == 1


def test_broken_pages_take_time_by_their_length():
    import time

    def took(mark, n):
        start = time.perf_counter()
        H.leaf_blocks("".join(mark.replace("#", str(i)) for i in range(n)), H.Paths())
        return time.perf_counter() - start

    for mark in ("<a", "<a \">\" ", "</script", "<div><p></b#>", "<div class=a#>", "<a '", "<!--", "<script></script"):
        assert took(mark, 100_000) < 4 * took(mark, 50_000) + 0.5, mark


def test_tags_of_broken_pages():
    def tags(page):
        found, reader, at = [], H.Tags(page), 0
        while at < len(page):
            start, end, closing, name, attributes = reader.after(at)
            if start < len(page):
                found.append((page[start:end], closing, name, attributes))
            at = end
        return found

    assert tags("a<b c='>'>d</b >e") == [("<b c='>'>", False, "b", " c='>'"), ("</b >", True, "b", " ")]
    assert tags("<a x='1>y<i>z") == [("<a x='1>", False, "a", " x='1"), ("<i>", False, "i", "")]
    assert tags("1 < 2 <3 <!x>y<!-- <p> -->z<p") == [("<!x>", False, "", ""), ("<!-- <p> -->", False, "", ""), ("<p", False, "", "")]
    assert tags("</>x<?y>") == [("</>", False, "", ""), ("<?y>", False, "", "")] and tags("") == []


# decontamination

def test_contamination(spark):
    item = " ".join(f"w{k}" for k in range(20))
    docs = [
        (1, "Before, " + item.upper() + " after"), (2, " ".join(f"w{k}" for k in range(12))), (3, None), (4, "..."), (None, item), (5, "It says: Short one!"),
        (6, "x " * 300 + item), (7, "short two"), (1, "short one again"), (8, "w0 w1 " * 40_000),
    ]
    docs = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, word string")
    items = spark.createDataFrame([(10, item), (9, item), (8, "short one"), (7, None), (None, item), (6, "!!")], "item_id long, text string")
    got = sorted(((r.doc_id or -1, r.n_words, r.n_hit, r["items"], r.contaminated) for r in contamination(docs, items, carry=["word"]).collect()), key=repr)
    assert got == sorted([
        (1, 22, 20, ["10", "9"], True), (2, 12, 0, [], False), (3, 0, 0, [], False), (4, 0, 0, [], False), (-1, 20, 20, ["10", "9"], True),
        (5, 4, 2, ["8"], True), (6, 320, 20, ["10", "9"], True), (7, 2, 0, [], False), (1, 3, 2, ["8"], True), (8, 80_000, 0, [], False),
    ], key=repr)
    assert contamination(docs.limit(0), items).count() == 0
    assert {r.n_hit for r in contamination(docs, items.limit(0)).collect()} == {0}


def test_contamination_splits_a_text_once_a_pass(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    judged = contamination(docs, spark.read.parquet(f"{SF_DIR}/benchmark.parquet"), carry=docs.columns)
    plan = judged.where("NOT contaminated").select("row.*")._jdf.queryExecution().optimizedPlan().toString()
    # one for the words that meet the prefixes, one for the words that are compared
    assert plan.count("split(") <= 2


def test_contamination_of_capital_sigma(spark):
    upper, small = "\u039f\u0394\u039f\u03a3", "\u03bf\u03b4\u03bf\u03c2"
    docs = spark.createDataFrame([(1, f"{upper}.AB"), (2, f"{upper}'ab"), (3, f"{upper} AB"), (4, f"{small} ab")], "doc_id long, text string")
    for item in (f"{upper} ab", f"{upper}.AB"):
        items = spark.createDataFrame([(1, item)], "item_id long, text string")
        assert {r.doc_id: r.n_hit for r in contamination(docs, items).collect()} == {1: 2, 2: 2, 3: 2, 4: 0}
    # alone in the table, its words would count 0
    assert [r.n_hit for r in contamination(docs.where("doc_id = 1"), items).collect()] == [2]


# pages

def extract(model, page):
    paths = H.Paths()
    blocks = H.leaf_blocks(page, paths)
    return "\n".join(b.text for b, keep in zip(blocks, model.viterbi(model.page_emissions(blocks, paths))) if keep)


@pytest.fixture(scope="module")
def field():
    return H.train(H.labelled_pages(400))


def test_field_on_pages_not_seen(field):
    paths, right, total = H.Paths(), 0, 0
    for page, labels in H.labelled_pages(150, 77):
        blocks = H.leaf_blocks(page, paths)
        got = field.viterbi(field.page_emissions(blocks, paths))
        right += sum(a == b for a, b in zip(got, labels))
        total += len(labels)
    assert right / total > 0.985


def test_viterbi_is_the_best_path(field):
    import itertools

    rng = np.random.default_rng(2)
    for n in (0, 1, 4, 7):
        e = rng.standard_normal((n, 2)) * 2
        value = lambda p: sum(e[i, x] for i, x in enumerate(p)) + (field.first[p[0]] if p else 0) + sum(field.steps[a, b] for a, b in zip(p, p[1:]))  # noqa: B023, E731
        assert value(field.viterbi(e)) == pytest.approx(max(value(p) for p in itertools.product((0, 1), repeat=n)))


def test_blocks_of_broken_pages():
    def texts(page):
        return [b.text for b in H.leaf_blocks(page, H.Paths())]

    assert texts("<p><b>One &amp; two<br><p>three</p>") == ["One & two", "three"]
    assert texts("<script>var t='</p>'</script><p>a \n\t b&nbsp;c</p><!-- x --><style>p{}") == ["a b c"]
    assert texts("<head><title>t</title><meta x></head><body>k<p>cut off <a href='x") == ["k", "cut off"]
    assert texts("1 < 2 and <ul><li>x<li>y</ul>") == ["1 < 2 and", "x", "y"]
    assert texts("") == [] and texts("<" * 5000) != [] and len(texts("<div>" * 3000 + "deep")) == 1


def test_extracted(spark, field):
    page = (
        "<body><nav><a href=x>Home</a></nav><div class=cookie-notice><p>We use cookies on this site.</p></div><article><h1>Title</h1>"
        "<p>First words of it.</p><p>Second  one &lt;here&gt;.</p><section class=comments><p>I like this post a lot.</p></section></article>"
        "<aside>Read also this.</aside><form><p>Search</p></form><footer>&copy; us</footer>"
    )
    df = spark.createDataFrame([(1, page, "x"), (None, None, "y"), (3, "", None), (1, page, "x")], "page_id int, html string, text string")
    out = H.extracted(df, field)
    assert out.columns == ["page_id", "html", "text", "n_chars"]
    main = "Title\nFirst words of it.\nSecond one <here>."
    assert sorted(((r.page_id or -1, r.text, r.n_chars) for r in out.collect())) == [(-1, "", 0), (1, main, len(main)), (1, main, len(main)), (3, "", 0)]
    assert H.extracted(df.limit(0), field).count() == 0
    assert extract(field, "no tags at all, but a sentence.") == "no tags at all, but a sentence."


# learnt scores

def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    network = language_id.learn(docs, texts=120, steps=250)
    odd = spark.createDataFrame([(1, None, "x", 1.0), (2, "", None, 2.0), (3, "12 34 !", "en", 0.0), (None, "the and of with that", "de", 1.0), (5, "Ωμέγα", "el", 0.0)], "doc_id long, text string, lang string, score double")
    out = language_id.identified(odd, network)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert [got[k] for k in (1, 2, 3)] == [("und", 0.0)] * 3 and got[None][0] == "en" and got[5][0] != "und"
    from ledgerlens.llm.sampling import held_out

    judged = language_id.identified(docs.where(held_out(docs["doc_id"], 4, 2)), network).collect()
    assert sum(r.lang == r.lang_pred for r in judged) / len(judged) > 0.97
    assert language_id.learn(docs.limit(0)) is None
    assert {r.lang_pred for r in language_id.identified(docs, None).limit(5).collect()} == {"und"}


def test_lookups_equal_the_filters():
    network = language_id.ByteNetwork.new(["a", "b"], 1)
    rng = np.random.default_rng(1)
    cut = rng.integers(0, 256, (5, language_id.WINDOW), dtype=np.uint8)
    pooled = []
    for width, weights, bias in zip(language_id.WIDTHS, network.filters, network.bias):
        runs = [network.embedding[cut[:, i : i + width]].reshape(5, -1) @ weights for i in range(language_id.WINDOW - width + 1)]
        pooled.append(np.tanh(np.max(runs, 0) + bias))
    logits = np.concatenate(pooled, 1) @ network.out + network.out_bias
    expected = logits - np.log(np.exp(logits).sum(1, keepdims=True))
    assert np.allclose(network.log_odds(cut, network.tables()), expected, atol=1e-4)


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels)
    from ledgerlens.llm.sampling import held_out

    got = quality.scored(docs.where(held_out(docs["doc_id"], 5, 0)), model).join(labels, "doc_id").collect()
    good, bad = ([r.score for r in got if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    odd = spark.createDataFrame([(None, None, 3), (2, "", 4), (2, "", 4)], "doc_id long, text string, score int")
    assert all(0 <= r.score <= 1 for r in quality.scored(odd, model).collect())
    assert quality.learn(docs, labels.limit(0)) is None and quality.learn(docs.limit(0), labels) is None
    assert {r.score for r in quality.scored(odd, None).collect()} == {0.5}


def test_class_prior():
    rng = np.random.default_rng(1)
    positive = rng.normal(2, 1, 4000)
    unlabelled = np.concatenate((rng.normal(2, 1, 2800), rng.normal(-2, 1, 1200)))
    assert abs(quality.class_prior(positive, unlabelled) - 0.7) < 0.06


# tokens

@pytest.fixture(scope="module")
def model():
    with open(SENTENCEPIECE_MODEL, "rb") as file:
        return file.read()


def test_parity_and_round_trip(model):
    rng = np.random.default_rng(6)
    parts = ["a", "the", "\n", " ", "  ", " " * 37, "é", "▁", "x.", "\t", "<s>", "漢", "\U0001f600"]
    texts = ["".join(rng.choice(parts, 25)) for _ in range(800)]
    assert SP.differing(model, texts) == []
    _, _, same, alike = SP.Codec(model).encode(texts)
    assert all(alike)
    assert same == ["▁" not in t for t in texts]


def test_words_are_forgotten(model):
    codec = SP.Codec(model, remembered=10)
    texts = [" ".join(f"w{k}x{j}" for k in range(30)) for j in range(5)]
    first = [codec.encode([t])[0].tolist() for t in texts]
    assert first == [e.ids for e in SP.build(model).encode_batch(texts, add_special_tokens=False)]
    assert len(codec.ids) <= 60


def unigram_model():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.trainer_spec.model_type = SP.UNIGRAM
    proto.trainer_spec.byte_fallback = True
    proto.normalizer_spec.add_dummy_prefix = True
    proto.normalizer_spec.remove_extra_whitespaces = True
    proto.normalizer_spec.escape_whitespaces = True
    rows = [("<unk>", 0, SP.UNKNOWN), ("<s>", 0, SP.CONTROL), ("</s>", 0, SP.CONTROL)]
    rows += [(f"<0x{b:02X}>", 0, SP.BYTE) for b in range(256)]
    rows += [(p, -float(i + 1) / 2, SP.NORMAL) for i, p in enumerate(["▁", "▁the", "a", "b", "ab", "aba", "t", "h", "e", "he", "▁a", "ba"])]
    for piece, score, kind in rows:
        proto.pieces.add(piece=piece, score=score, type=kind)
    return proto.SerializeToString()


def test_remembered_words_are_packed(model):
    """A list of Python numbers for each word takes several times the memory, which a worker keeps."""
    codec = SP.Codec(model)
    codec.encode([" ".join(f"some{i}thing" for i in range(2000))])
    assert len(codec.ids) == 2000
    assert sum(sys.getsizeof(x) for x in codec.ids.values()) < 2000 * 64 and {type(x) for x in codec.ids.values()} == {bytes}


def test_unigram_scores_and_byte_fallback():
    model = unigram_model()
    assert SP.differing(model, ["the abab", " the  ab ", "ababa the", "é the", ""]) == []


def test_encode(spark, model):
    df = spark.createDataFrame([(None, None, 1), (2, "", 2), (3, "Été à  la plage", 3), (3, "word " * 20_000, 4)], "doc_id long, text string, ids int")
    out = SP.encode(df, SENTENCEPIECE_MODEL)
    assert out.columns == ["doc_id", "text", "ids", "n_tokens", "round_trip", "parity"]
    got = out.collect()
    assert all(r.round_trip and r.parity and r.n_tokens == len(r.ids) for r in got)
    expected = SP.build(model).encode_batch([r.text or "" for r in got], add_special_tokens=False)
    assert [r.ids for r in got] == [e.ids for e in expected]
    assert SP.encode(df.limit(0), SENTENCEPIECE_MODEL).count() == 0


def test_decode(spark):
    """Texts come back; any ids, byte pieces among them, decode as the sentencepiece library decodes them."""
    import sentencepiece

    texts = [None, "", " two  spaces ", "Été \U0001f600 漢字", "x" * 3000, "tab\tand\nline"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("decoded", F.lit(1))
    out = SP.decode(SP.encode(df, SENTENCEPIECE_MODEL), SENTENCEPIECE_MODEL)
    assert out.columns == ["doc_id", "text", "ids", "n_tokens", "round_trip", "parity", "decoded"]
    assert {r.doc_id: r.decoded for r in out.collect()} == {i: t or "" for i, t in enumerate(texts)}
    library = sentencepiece.SentencePieceProcessor(model_file=SENTENCEPIECE_MODEL)
    rng, size = random.Random(5), library.get_piece_size()
    usual = [i for i in range(size) if not library.is_control(i) and not library.is_byte(i) and not library.is_unknown(i)]
    smile = library.encode("\U0001f600")
    lists = [[rng.choice(usual) for _ in range(rng.randrange(1, 30))] + (smile if i % 3 else []) for i in range(60)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lists)] + [(60, None), (61, []), (62, [usual[7], size + 5, None, -1])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in SP.decode(rows, SENTENCEPIECE_MODEL).collect()}
    assert [got[i] for i in range(60)] == library.decode(lists)
    assert (got[60], got[61], got[62]) == (None, "", library.decode([usual[7]]))
    assert SP.decode(rows.limit(0), SENTENCEPIECE_MODEL).count() == 0


def test_parity_tells_other_ids():
    with open(SENTENCEPIECE_MODEL, "rb") as file:
        codec = SP.Codec(file.read())
    real = codec.other.encode

    class Other:
        """A library that cuts one word in another way."""

        def encode(self, texts):
            return [self.encode(t) for t in texts] if isinstance(texts, list) else [1] if "plage" in texts else real(texts)

    codec.other = Other()
    assert codec.encode(["a la plage", "a la mer", "▁own marker", ""])[3] == [False, True, True, True]


# pipeline

def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "jaccard_join", "decontamination", "sentencepiece"]
    source = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs, kept = source, []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        kept.append(docs)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.dtypes == source.dtypes
            docs = docs.checkpoint()
    ids = {r.doc_id for r in kept[-1].collect()}
    run = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in run} == ids and all(r.round_trip and r.n_tokens == len(r.ids) for r in run)
    judged = contamination(kept[2], spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
    assert {r.doc_id for r in judged.where("NOT contaminated").collect()} == ids


def test_small_tables_take_few_files(spark, tmp_path):
    """However many partitions a shuffle has: an executor starts a process for each file, and a stage reads them all again."""
    held = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    own = [f"w{i}" for i in range(60)]
    texts = [" ".join(own[:i] + [f"x{k}" for k in range(i % 3)] + own[i:]) + f"\nline {i}" for i in range(40)]
    docs = stored(spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long"), str(tmp_path / "docs"))
    top = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    old = {d for d, _, _ in os.walk(top)}
    cores = spark.sparkContext.defaultParallelism
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        for name, stage in corpus_pipeline.STAGES[1:4]:
            docs = stored(stage(spark, docs, SF_DIR), str(tmp_path / name))
        assert 0 < docs.count() < 40
        for d, _, names in (x for x in os.walk(top) if x[0] not in old):
            # how many pairs meet isn't known before they are written
            assert sum(n.startswith("part-") for n in names) <= cores or d.endswith("/met"), d
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_pipeline_stages_keep_odd_rows(spark):
    line = "a line of eight words that comes again"
    rows = [(None, line, None, None, None), (2, None, "en", "s", None), (3, "", "en", "s", 0), (4, line + "\nand more of it", "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, SF_DIR)
        assert out.dtypes == docs.dtypes and out.count() == 4, name
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    assert corpus_pipeline.STAGES[4][1](spark, docs, SF_DIR).count() == 4
