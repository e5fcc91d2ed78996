"""Operators on pairs of documents or vectors against brute force, and their odd inputs."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from ledgerlens.llm import jaccard_join
from ledgerlens.llm.components import components
from ledgerlens.llm.embedding_dedup import near_vectors, table_plan
from ledgerlens.llm.jaccard_join import prefix_matches, similar_documents
from ledgerlens.llm.line_dedup import common_blocks, dedup_lines, patience
from ledgerlens.llm.suffix_dedup import KeyFilter, Levels, _repeated_keys, remove_repeats
from ledgerlens.session import fewer_tasks

DOCS = "doc_id long, text string"


def words(rng, n):
    return [rng.choice("ab") + str(rng.randrange(400)) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Texts with exact and near copies, shared passages, short, empty and null ones."""
    rng = random.Random(4)
    rows = []
    base = [words(rng, rng.choice((3, 5, 12, 60, 200))) for _ in range(60)]
    passage = words(rng, 40)
    for i in range(400):
        own = list(rng.choice(base)) if rng.random() < 0.6 else words(rng, rng.choice((1, 4, 5, 30, 90)))
        for _ in range(rng.choice((0, 0, 1, 2, 4))):
            own[rng.randrange(len(own))] = "x" + str(rng.randrange(9999))
        if rng.random() < 0.2:
            at = rng.randrange(len(own) + 1)
            own[at:at] = passage
        cut = rng.choice((7, 11))
        rows.append((i, "\n".join(" ".join(own[k : k + cut]) for k in range(0, len(own), cut))))
    rows += [(400, None), (401, ""), (402, " \n "), (403, ""), (404, "UPPER Case words are folded here"), (405, "upper case\twords are folded HERE")]
    rows += [(406, "long " * 30_000), (407, "long " * 30_000)]
    return rows


def roots(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text):
    w = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(0, k) for k in range(400, 700)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    df = spark.createDataFrame([*links, (None, 3), (3, None)], "a long, b long")
    nodes = {x for a, b in links if a != b for x in (a, b)}
    expected = roots(nodes, [x for x in links if x[0] != x[1]])
    assert {r.node: r.component for r in components(df).collect()} == expected
    assert components(df.limit(0)).count() == 0


def test_few_links_take_few_tasks(spark):
    """However many partitions a shuffle has: a task, file and event of each would cost more than the links."""
    held = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    cores = spark.sparkContext.defaultParallelism
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = components(spark.range(2000).selectExpr("id AS a", "id - id % 50 AS b"))
        assert found.rdd.getNumPartitions() <= cores < 61
        assert {(r.node, r.component) for r in found.collect()} == {(k, k - k % 50) for k in range(2000)}
        assert fewer_tasks(spark.range(0, 1000, 1, 61), 40 * (cores + 1), 40).rdd.getNumPartitions() == cores + 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_similar_documents(spark, corpus):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_documents(spark.createDataFrame(corpus, DOCS).repartition(7)).collect()}
    sets = {i: shingles(t) for i, t in corpus}
    ids = sorted(sets)
    links = [
        (i, j) for i in ids for j in ids
        if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    assert len(links) > 300
    component = roots(ids, links)
    assert found == {i: (len(sets[i]), component[i]) for i in ids}


def test_similar_documents_odd_rows(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (7, text), (7, text), (9, text), (7, "quite another text of six words")]
    df = spark.createDataFrame([(*r, "k") for r in rows], DOCS + ", node string")
    found = sorted(((r.doc_id or -1, r.n_shingles, r.component_id) for r in similar_documents(df).collect()), key=repr)
    assert found == sorted([(-1, 3, None), (7, 3, 7), (7, 3, 7), (9, 3, 7), (7, 2, 7)], key=repr)
    assert similar_documents(df.limit(0)).count() == 0


def test_near_copies_meet_their_hub(spark, monkeypatch):
    """Pairs whose texts are fetched: about one for each near copy, none for texts that share a passage."""
    rng = random.Random(8)
    base, passage = words(rng, 150), words(rng, 12)
    rows = []
    for i in range(300):
        own = list(base)
        for at in rng.sample(range(150), rng.randrange(9)):
            own[at] = f"y{i}x{at}"
        rows.append((i, " ".join(own)))
    for i in range(300, 500):
        rows.append((i, " ".join([f"z{i}x{k}" for k in range(25)] + passage + [f"v{i}x{k}" for k in range(25)])))
    fetched, verified = [], jaccard_join._verified

    def counted(pairs, *more):
        fetched.extend(pairs.collect())
        return verified(pairs, *more)

    monkeypatch.setattr(jaccard_join, "_verified", counted)
    found = {r.doc_id: r.component_id for r in similar_documents(spark.createDataFrame(rows, DOCS).repartition(4)).collect()}
    sets = {i: shingles(t) for i, t in rows}
    links = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert len(links) > 5000 and found == roots(list(sets), links)
    assert len(fetched) < 450


def test_parities_bound_differences():
    rng = np.random.default_rng(5)
    for n, other in ((100, 7), (100, 60), (40, 0), (3, 200)):
        one = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        two = np.unique(np.concatenate((one[other // 2 :], rng.integers(0, 2**63, other).astype(np.uint64))))
        a, b = jaccard_join.parities(np.concatenate((one, two)), np.array([0, len(one), len(one) + len(two)]))
        differ = int(np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)).sum())
        real = len(np.setxor1d(one, two))
        assert differ <= real and (real - differ) % 2 == 0 and (not real or differ > 0.6 * real)


def test_prefixes_lengthen_with_cost():
    assert prefix_matches(np.zeros(40), 10, 30) == 1
    heavy = np.concatenate((np.full(20, 100.0), np.full(20, 101.0)))
    assert prefix_matches(heavy, 10, 30) > 1
    assert prefix_matches(np.full(4, 9.0), 1, 1) == 1


def test_remove_repeats(spark, corpus):
    found = {r.doc_id: (r.n_bytes, bytes(r.kept), len(r.spans) // 16) for r in remove_repeats(spark.createDataFrame(corpus, DOCS).repartition(5)).collect()}
    first = {}
    for i, text in sorted(corpus):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for q in range(len(data) - 49):
            if first.setdefault(data[q : q + 50], i) < i:
                gone[q : q + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(data, gone) if not g)
        assert found[i] == (len(data), kept, len(re.findall(b"\1+", bytes(gone)))), i


def test_remove_repeats_odd_rows(spark):
    text = "".join(chr(97 + k % 26) + str(k) for k in range(60))
    df = spark.createDataFrame([(None, text, 1), (3, text, 2), (3, text, 3), (5, "é" + text, 4), (8, text[:49], 5)], DOCS + ", spans int")
    found = sorted((r.doc_id or -1, len(r.kept)) for r in remove_repeats(df).collect())
    assert found == [(-1, len(text)), (3, len(text)), (3, len(text)), (5, 2), (8, 49)]
    assert remove_repeats(df.limit(0)).count() == 0


def test_levels_grow_geometrically():
    rng = np.random.default_rng(0)
    index, seen = Levels(), {}
    for doc in range(40):
        prints = rng.integers(0, 3000, 100, dtype=np.uint64)
        hit = index.add(prints, np.full(100, doc))
        assert hit.tolist() == [int(p) in seen for p in prints]
        seen.update((int(p), doc) for p in prints)
        sizes = [len(level) for level, _ in index.levels]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:]))


def test_key_filter_grows_with_its_keys():
    rng = np.random.default_rng(3)
    for n in (1, 1000, 300_000):
        keys = np.unique(rng.integers(0, 1 << 48, 3 * n, dtype=np.uint64))
        held, others = keys[::2], keys[1::2]
        found = KeyFilter(4, [(0, KeyFilter.part(others[:1])), (2, KeyFilter.part(held))])
        there = np.full(len(held), 2)
        assert found.holds(held, there).all() and not found.holds(held, np.ones(len(held), int)).any()
        assert found.holds(others, there[: len(others)]).sum() <= 1 + 0.03 * len(others)


def test_repeated_keys_have_a_part_of_the_filter_each(spark):
    text = "".join(chr(97 + k % 26) + str(k) for k in range(400))
    found = _repeated_keys(spark.createDataFrame([(1, text), (2, text + "!"), (3, "z".join(text[300:]))], DOCS), 8)
    assert (found.size > 0).all() and 8 * len(found.bits) == found.size.sum() < 4000
    assert not len(_repeated_keys(spark.createDataFrame([(1, text)], DOCS), 8).bits)


def test_patience():
    assert patience([1, 2, 3], [1, 9, 3]) == [(0, 0), (2, 2)]
    assert patience([1, 2, 3, 4], [3, 1, 2, 4]) == [(0, 1), (1, 2), (3, 3)]
    assert patience([], [1]) == [] and patience([5, 5], [5, 5, 5]) == [(0, 0), (1, 1)]
    rng = random.Random(2)
    for _ in range(300):
        x, y = ([rng.randrange(12) for _ in range(rng.randrange(15))] for _ in range(2))
        found = patience(x, y)
        assert all(x[i] == y[j] for i, j in found)
        assert all(a < c and b < d for (a, b), (c, d) in zip(found, found[1:]))
    assert common_blocks([1, 2, 3], [1, 2, 4], [3, 4, 9], 8) == []
    assert common_blocks([1, 2, 3], [1, 2, 4], [4, 4, 9], 8) == [0, 1]


def in_common_blocks(own, other, sizes, least):
    """Every run of lines of ``own``, looked for at every place of ``other``."""
    gone = set()
    for a in range(len(own)):
        for b in range(a + 1, len(own) + 1):
            run = own[a:b]
            if sum(sizes[a:b]) >= least and any(other[k : k + b - a] == run for k in range(len(other))):
                gone.update(range(a, b))
    return sorted(gone)


def test_common_blocks_repeated_or_crossing():
    p, x, y, z, w = 60, 1, 2, 3, 4
    assert common_blocks([z, p, w], [p, x, p, y], [1, 60, 1], 8) == [1]
    assert common_blocks([p, x, p, y], [z, p, w], [60, 1, 60, 1], 8) == [0, 2]
    assert common_blocks([1, 2, 3, 4], [3, 4, 1, 2], [8, 8, 8, 8], 8) == [0, 1, 2, 3]
    rng = random.Random(5)
    for _ in range(1500):
        kinds, size = rng.choice((3, 6, 12)), [0, *(rng.choice((1, 3, 5, 9)) for _ in range(12))]
        own, other = ([rng.randrange(kinds) for _ in range(rng.randrange(14))] for _ in range(2))
        sizes = [size[line] for line in own]
        assert common_blocks(own, other, sizes, 8) == in_common_blocks(own, other, sizes, 8), (own, other, sizes)


def test_dedup_lines(spark, corpus):
    found = {r.doc_id: (r.lines_removed, r.text) for r in dedup_lines(spark.createDataFrame(corpus, DOCS).repartition(6)).collect()}
    lines = {i: [x if x.strip(" ") else "" for x in t.split("\n")] for i, t in corpus if t is not None}
    holders = defaultdict(set)
    for i, own in lines.items():
        for line in own:
            holders[line].add(i)
    for i, text in corpus:
        gone = set()
        if text is not None:
            naming = defaultdict(set)
            for line in set(lines[i]) - {""}:
                if min(holders[line]) < i:
                    naming[min(holders[line])].add(line)
            for partner, named in sorted(naming.items(), key=lambda x: (min(len(holders[n]) for n in x[1]), x[0])):
                if not all(k in gone for k, line in enumerate(lines[i]) if line in named):
                    gone.update(common_blocks(lines[i], lines[partner], [len(x.split()) for x in lines[i]], 8))
        left = text if not gone else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
        assert found[i] == (len(gone), left), i
    assert sum(n for n, _ in found.values()) > 300


def test_dedup_lines_against_all_earlier_holders(spark):
    short = [f"a{k} b{k} c{k}" for k in range(20)]
    scattered = "\n".join(f"{x}\nfiller{k}" for k, x in enumerate(short))
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame([(1, scattered), (2, "\n".join(short)), (3, "\n".join(short))], DOCS)).collect()}
    assert got == {1: scattered, 2: "\n".join(short), 3: ""}
    rng = random.Random(6)
    kinds = [""] + [" ".join(f"k{k}" for _ in range(rng.choice((1, 2, 3, 5, 9)))) for k in range(15)]
    texts = {i: [rng.choice(kinds) for _ in range(rng.randrange(1, 16))] for i in range(150)}
    rows = spark.createDataFrame([(i, "\n".join(x)) for i, x in texts.items()], DOCS).repartition(5)
    got = {r.doc_id: r.text for r in dedup_lines(rows).collect()}
    runs = set()
    for i, own in texts.items():
        spans = [(a, b) for a in range(len(own)) for b in range(a + 1, len(own) + 1) if len(" ".join(own[a:b]).split()) >= 8]
        gone = {k for a, b in spans if tuple(own[a:b]) in runs for k in range(a, b)}
        runs.update(tuple(own[a:b]) for a, b in spans)
        assert got[i] == "\n".join(x for k, x in enumerate(own) if k not in gone), i


def test_dedup_lines_of_very_long_texts(spark):
    """Twice the lines take about twice the time."""
    import time

    def took(n):
        text = "\n".join(f"line {i} of a long text that two documents share but for one" for i in range(n))
        rows = [(1, text), (2, "own head of the second text, of its own words alone\n" + text.replace("line 7 ", "row 7 "))]
        df = spark.createDataFrame(rows, DOCS).cache()
        df.count()
        start = time.perf_counter()
        got = {r.doc_id: (r.lines_removed, len(r.text.split("\n"))) for r in dedup_lines(df).collect()}
        assert got == {1: (0, n), 2: (n - 1, 2)}
        return time.perf_counter() - start

    took(2000)
    assert took(80_000) < 3 * took(40_000) + 1


def test_dedup_lines_odd_rows(spark):
    line = "a line of eight words that comes again"
    rows = [(None, line, "x", "v"), (4, line, None, "v"), (4, line + "\nmore", "x", "v"), (6, "head\n\n" + line, "x", None)]
    df = spark.createDataFrame(rows, DOCS + ", removed string, version string")
    out = dedup_lines(df)
    assert out.columns == ["doc_id", "text", "removed", "version", "lines_removed"]
    assert sorted(((r.doc_id or -1, r.text, r.lines_removed) for r in out.collect()), key=repr) == sorted(
        [(-1, line, 0), (4, line, 0), (4, line + "\nmore", 0), (6, "head\n", 1)], key=repr
    )
    assert dedup_lines(df.limit(0)).count() == 0


def brute_vectors(rows, threshold=0.98):
    usable = {}
    for i, v, label in rows:
        x = None if v is None or any(e is None for e in v) else np.array(v, float)
        if x is not None and label is not None and len(x) and np.isfinite(x).all() and x.any():
            usable[i] = (x / np.linalg.norm(x), label)
    links = [
        (i, j) for i in usable for j in usable
        if i < j and usable[i][1] == usable[j][1] and len(usable[i][0]) == len(usable[j][0]) and usable[i][0] @ usable[j][0] >= threshold
    ]
    n = defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    component = roots([r[0] for r in rows], links)
    return {r[0]: (n[r[0]], component[r[0]], r[0] == component[r[0]]) for r in rows}


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((12, 16))
    rows = []
    for i in range(700):
        x = centers[rng.integers(12)] + rng.standard_normal(16) * rng.choice((0.0, 0.05, 0.15, 0.8))
        rows.append((i, [float(np.float32(e)) for e in x * rng.choice((1.0, 1.0, 3.0))], int(rng.integers(2))))
    rows += [(700, None, 1), (701, [0.0] * 16, 1), (702, [1.0, None], 1), (703, [float("nan")] * 16, 1), (704, [1.0] * 16, None), (705, [float("inf")] * 16, 1), (706, [], 1), (707, [1.0, 1.0], 1), (708, [2.0, 2.0], 1)]
    out = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out.collect()}
    expected = brute_vectors(rows)
    total = sum(v[0] for v in expected.values())
    assert total > 5000
    assert all(found[i][0] <= expected[i][0] for i in expected)
    assert sum(v[0] for v in found.values()) >= 0.999 * total
    assert found[707] == (1, 707, True) and found[708] == (1, 707, False) and found[706] == (0, 706, True)


def test_near_vectors_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, label int, copy string, sign int"
    same = [1.0, 2.0]
    df = spark.createDataFrame([(None, same, 1, "a", 1), (5, same, 1, "b", 1), (5, same, 1, "c", 1), (3, same, 1, "d", 1), (8, same, 2, "e", 1)], schema)
    found = sorted(((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()), key=repr)
    assert found == sorted([(-1, 0, None, None), (5, 1, 3, False), (5, 1, 3, False), (3, 1, 3, True), (8, 0, 8, True)], key=repr)
    assert near_vectors(df.limit(0)).count() == 0


def test_blocks_of_a_hot_bucket(spark, monkeypatch):
    from ledgerlens.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(5)
    rows = [(i, [float(e) for e in np.ones(8) + rng.standard_normal(8) * 0.05], 1) for i in range(150)]
    out = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    expected = brute_vectors(rows)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out.collect()}
    assert sum(v[0] for v in found.values()) >= 0.999 * sum(v[0] for v in expected.values()) > 10_000


def test_table_plan():
    for rows in (10, 10_000, 10**9):
        bits, tables = table_plan(rows, 0.98, 0.0005)
        together = (1 - np.arccos(0.98) / np.pi) ** bits
        assert (1 - together) ** tables <= 0.0005


def test_digest_of_op10(spark):
    from ledgerlens.llm.queries import op10_suffix_dedup

    out = op10_suffix_dedup(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    empty = hashlib.sha256(b"").hexdigest()
    for r in out.collect():
        assert (r.kept_sha256 == empty) == (r.n_removed == r.n_bytes)
