"""Dataset manifest, exact dedup and conversation repair against brute force, and their odd inputs."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerlens.llm.conversation_repair import EDGES, INSERTS, START, between, damaged, faults, least_path, repair, repaired, with_all
from ledgerlens.llm.exact_dedup import build_index, cell, exact_groups
from ledgerlens.llm.merkle_manifest import BLOCK, folded, leaf_digest, manifest, path_digest
from ledgerlens.llm.positions import with_positions
from ledgerlens.session import new_folder

ROWS = "doc_id long, source string, lang string, n_chars long, text string"
TURNS = "conv_id long, turn long, role string, text string"


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_positions_of_a_group_over_many_ranges(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(500)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, k int").repartition(7)
    got = defaultdict(list)
    for r in with_positions(df, ["g"], ["k"], new_folder(spark, "positions")).collect():
        got[r.g].append((r.at, -1 if r.k is None else r.k, r.n))
    for g in ("a", "b", None):
        own = sorted(got[g])
        assert [x[0] for x in own] == list(range(len(own))) and {x[2] for x in own} == {len(own)}
        assert [x[1] for x in own] == sorted(-1 if k is None else k for h, k in rows if h == g)
    assert with_positions(df.limit(0), ["g"], ["k"], new_folder(spark, "positions")).count() == 0


def tree_of(rows):
    """leaf, subroot, root and siblings of every row, by plain lists; rows that repeat an id are told by their leaf."""

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    leaves, paths, groups = [digest("".join(map(field, r))) for r in rows], defaultdict(str), defaultdict(list)
    for k, r in enumerate(rows):
        groups[r[2]].append(k)

    def climb(nodes):
        while len(nodes) > 1:
            above = []
            for k in range(0, len(nodes), 8):
                run = nodes[k : k + 8]
                for j, (members, _) in enumerate(run):
                    for m in members:
                        paths[m] += "".join(h for i, (_, h) in enumerate(run) if i != j)
                above.append(([m for members, _ in run for m in members], digest("".join(h for _, h in run))))
            nodes = above
        return nodes[0] if nodes else ([], None)

    subroots = []
    for g in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        own = sorted(groups[g], key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaves[k]))
        subroots.append(climb([([k], leaves[k]) for k in own]))
    tops = {m: h for members, h in subroots for m in members}
    root = climb(subroots)[1]
    return [(r[0], leaves[k], tops[k], root, paths[k]) for k, r in enumerate(rows)]


def manifest_rows(df):
    tree = manifest(df).select("*", folded(F.col("leaf"), F.col("path")).alias("f"), path_digest(F.col("path")).alias("p")).collect()
    assert all(r.f == r.root for r in tree)
    return tree


def test_manifest(spark):
    rng = random.Random(2)
    rows = [(i, f"s{i % 3}", "en" if i % 5 else rng.choice(["de", "fr", "ü"]), i, f"text {i} é") for i in range(BLOCK * 9 + 3)]
    rng.shuffle(rows)
    got = manifest_rows(spark.createDataFrame(rows, ROWS).repartition(5))
    expected = {r[0]: r for r in tree_of(rows)}
    assert len(got) == len(rows)
    assert all((r.doc_id, r.leaf, r.subroot, r.root, r.p) == (*expected[r.doc_id][:4], digest(expected[r.doc_id][4])) for r in got)


def test_manifest_sizes_around_runs(spark):
    for sizes in ((1,), (8, 1), (9, 64, 65), (BLOCK, BLOCK + 1, 2), tuple([1] * 20)):
        rows = [(i * 100 + g, None, f"l{g:02}", None, "") for g, n in enumerate(sizes) for i in range(n)]
        got = sorted((r.doc_id, r.leaf, r.subroot, r.root, r.p) for r in manifest_rows(spark.createDataFrame(rows, ROWS)))
        assert got == sorted((*r[:4], digest(r[4])) for r in tree_of(rows)), sizes


def test_manifest_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, ""), (1, "s", None, 3, "x" * 100_000), (1, "s", None, 3, "x" * 100_000), (1, "t", "en", None, "a"), (2, "", "", 0, "")]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], ROWS + ", digest string, block int")
    got = sorted(((r.doc_id or 0, r.leaf, r.subroot, r.root, r.p) for r in manifest_rows(df)), key=repr)
    assert got == sorted(((r[0] or 0, *r[1:4], digest(r[4])) for r in tree_of(rows)), key=repr)
    assert manifest(df.limit(0)).count() == 0


def test_manifest_finds_changes(spark):
    rows = [(i, "s", "en" if i % 2 else "de", 1, f"Text {i}") for i in range(700)]
    df = spark.createDataFrame(rows, ROWS)
    other = leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.lower("text"))
    tree = manifest(df.withColumn("digest", other), carry=["digest"])
    assert tree.where(folded(F.col("digest"), F.col("path")) == F.col("root")).count() == 0


SPACE = re.compile("[\x20\x09-\x0d]")


def exact_of(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), min(g)[1] == i, digest(k)) for k, g in groups.items() for _, i in g}


def copies(n):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdé") * rng.randrange(1, 4) for _ in range(rng.choice((0, 1, 3, 30)))) for _ in range(n // 4)]
    rows = [(i, rng.choice(base).replace(" ", rng.choice([" ", "\n", "  ", "\t\x0b"]))) for i in range(n)]
    return [*rows, (n, None), (n + 1, ""), (n + 2, " \r\n"), (n + 3, "long\x0c " * 20_000), (n + 4, "long" * 20_000), (n + 5, "a\xa0b"), (n + 6, "ab")]


def test_exact_groups(spark):
    rows = copies(600)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert {r.doc_id: tuple(r)[1:] for r in exact_groups(df).collect()} == exact_of(rows)


def test_exact_groups_of_colliding_keys(spark):
    """With keys of three bits nearly all texts collide, and their bytes decide."""
    rows = copies(150)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for bits in (1, 3):
        assert {r.doc_id: tuple(r)[1:] for r in exact_groups(df, bits=bits, capacity=200).collect()} == exact_of(rows)


def test_hash_index(spark):
    rows = [(i, f"{i % 400} " + "x" * (i % 50)) for i in range(1200)] + [(i, "hot") for i in range(2000, 2500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    capacity = 1500
    index = build_index(df, new_folder(spark, "index"), capacity=capacity)
    pointers = index.directory.collect()
    assert sorted(r.cell for r in pointers) == list(range(2**index.depth)) and index.depth > 1
    buckets = {r.low % 2**64: r.depth for r in pointers}
    # Buckets are aligned ranges of keys that cover all of them, and a cell points to the one that it lies in.
    end = 0
    for low in sorted(buckets):
        assert low == end and low % 2 ** (64 - buckets[low]) == 0
        end = low + 2 ** (64 - buckets[low])
    assert end == 2**64
    assert all((r.cell >> (index.depth - r.depth)) << (64 - r.depth) == r.low % 2**64 for r in pointers)
    kept = index.chains.select("*", F.length("text").alias("n"), cell(F.col("key"), index.depth).alias("cell")).collect()
    places = {r.cell: r for r in pointers}
    load, keys = defaultdict(int), defaultdict(set)
    for r in kept:
        assert places[r.cell].low == r.low
        load[r.low] += r.n + 64
        keys[r.low].add(r.key)
    repeated = {k for k, g in itertools.groupby(sorted(SPACE.sub("", t) for _, t in rows)) if len(list(g)) > 1}
    assert repeated <= {r.text for r in kept} and len(kept) == len({r.text for r in kept})
    assert all(load[low] <= capacity or len(keys[low]) == 1 for low in load)


def test_exact_groups_odd_rows(spark):
    rows = [(None, "a b"), (7, "ab"), (7, "a b"), (7, "a b"), (3, None), (None, " "), (None, None)]
    df = spark.createDataFrame([(*r, "k", 1, None) for r in rows], "doc_id long, text string, key string, row int, chain int")
    out = exact_groups(df)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    got = sorted(((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in out.collect()))
    assert got == sorted([(-1, 7, 4, False), (7, 7, 4, False), (7, 7, 4, False), (7, 7, 4, True), (3, -1, 3, False), (-1, -1, 3, False), (-1, -1, 3, True)])
    assert exact_groups(df.limit(0)).count() == 0


def test_exact_dedup_plan_is_native(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string")
    plan = exact_groups(rows)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|MapPartitions", plan.split("== Optimized Logical Plan ==")[1])


CODES = "abcdefghijklmnop"


def cheapest(codes):
    """Plain search: all labels in order of cost and audit, one per node and audit, no meeting in the middle."""
    best, heap, found = {}, [(0, "", 0, START)], []
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if found and cost > found[0][0]:
            break
        if best.setdefault((i, q), cost) < cost:
            continue
        if i == len(codes) and q in (0, 3):
            found.append((cost, audit))
        steps = [((i + 1, b), c, x) for a, b, c, x in EDGES[codes[i]] if a == q] if i < len(codes) else []
        for (j, b), c, x in steps + [((i, b), c, x) for a, b, c, x in INSERTS if a == q]:
            heapq.heappush(heap, (cost + c, audit + x, j, b))
    return min(found)


def test_repaired_against_all_paths():
    for n in range(4):
        for codes in itertools.product(CODES, repeat=n):
            assert repaired("".join(codes)) == cheapest(codes), codes
    rng = random.Random(4)
    for _ in range(400):
        codes = "".join(rng.choice("aeeiieiaehkm") for _ in range(rng.randrange(4, 13)))
        assert repaired(codes) == cheapest(codes), codes


def test_segments_give_the_whole():
    rng = random.Random(5)
    for _ in range(150):
        codes = "".join(rng.choice(CODES) for _ in range(rng.randrange(1, 14)))
        cuts = sorted(rng.sample(range(len(codes) + 1), min(3, len(codes))))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)]) if b > a]
        steps = [between([EDGES[c] for c in p], INSERTS) for p in parts]
        assert least_path(steps, (), START, (0, 3)) == repaired(codes), codes


def damage_of(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fate:
            new = (c, t, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
            out += [new, new] if fate == 3 else [new]
    return out


def repairs_of(ids, rows):
    """Every conversation by plain lists and the plain search."""
    out = {}
    for conv in ids:
        own = [r[1:] for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(f"{len(r[1].encode())}:{r[1]}{r[2]}")))
        seen, codes, n = set(), "", {"": 0, "blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            bare = SPACE.sub("", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            n[fault] += 1
            codes += CODES["suao".index(role[:1] if role[:1] and role[:1] in "sua" else "o") * 4 + list(n).index(fault)]
        turns = {r[0] for r in own} - {None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = cheapest(codes)
        lines, left, state = [], iter(own), "a"
        for edit in audit:
            row = next(left) if edit != "I" else None
            if edit != "D":
                given = "assistant" if state == "u" else "user"
                role, text = (given, "") if edit == "I" else (given if edit == "R" else row[1], row[2])
                lines.append(f"{role}:{text}")
                state = role[:1]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, digest("\n".join(lines)))
    return out


def conversations(rng):
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.choice((1, 2, 5, 9))):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = rng.choice([f"fine {turn}.", "same.", " \n", "", None, "cut off", "ends! \t", f"No {rng.randrange(5)}?"])
            rows.append((conv, rng.choice([None, turn, turn, turn, turn + 3]), role, text))
    return rows + [(99, 1, "user", "word " * 30_000), (99, 2, "assistant", "done.")]


def test_repair(spark):
    rows = conversations(random.Random(6))
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    out = with_all(repair(damaged(df)), df)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r)[1:] for r in out.collect()} == repairs_of({r[0] for r in rows}, damage_of(rows))


def test_repair_of_a_long_conversation_in_segments(spark):
    rng = random.Random(7)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"t{t}.", "again.", "cut", " "])) for t in range(130)]
    rows += [(2, t, ("user", "assistant")[t % 2], f"t{t}.") for t in range(3)]
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in repair(df, segment=8, merged=3).collect()}
    assert got == repairs_of({1, 2}, rows)
    assert got[2][5:7] == (3, "KKKI")


def test_repair_odd_rows(spark):
    rows = [(1, 1, "user", "a."), (1, 1, "user", "a."), (2, None, None, None), (3, 5, "system", "s.")]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], TURNS + ", audit string, at int")
    got = {r.conv_id: tuple(r)[1:] for r in repair(df).collect()}
    assert got == repairs_of({1, 2, 3}, [tuple(" " if x is None and k > 1 else x for k, x in enumerate(r)) for r in rows])
    assert repair(df.limit(0)).count() == 0
    nothing = with_all(repair(df.limit(0)), df.limit(1)).first()
    assert tuple(nothing)[1:] == (0, 0, 0, 0, 0, 0, "", digest(""))
    assert {r.fault for r in faults(df).where("conv_id = 1").collect()} == {"", "duplicate"}
