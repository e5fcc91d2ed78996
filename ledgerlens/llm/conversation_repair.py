"""Least-cost repair of the turns of conversations, found by a bidirectional Dijkstra search."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import new_folder, shuffle_width, stored

from .positions import same, with_positions

# What blank texts consist of, and marks that end a text.
SPACES = " \t\n\x0b\x0c\r"
ENDS = r"[.!?]"
# Costs of the edits and of a truncated row that stays.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: Role initials that may follow in each state: start, behind a system row, behind a user row, behind an assistant row.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
START, FINAL = 0, (0, 3)
#: Role that edits give in each state.
GIVEN = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
FAULTS = ("", "blank", "duplicate", "truncated")
KINDS = "suao"  # initials; o is any other
SEGMENT = 1024  # rows of a conversation that a task searches at once
MERGED = 64  # segments put together at once

Edge = tuple[int, int, int, str]  # state before, state after, cost, audit


def edit_edges(code: str) -> list[Edge]:
    """Edits that take one row, coded as a letter: its role initial and its fault."""
    kind, fault = KINDS["abcdefghijklmnop".index(code) // 4], FAULTS["abcdefghijklmnop".index(code) % 4]
    edges = [(q, q, DELETE, "D") for q in range(4)]
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED if fault == "truncated" else 0
        edges += [(q, NEXT[q][kind], more, "K") for q in range(4) if kind in NEXT[q]]
        edges += [(q, GIVEN[q][1], REROLE + more, "R") for q in range(4)]
    return edges


INSERTS: list[Edge] = [(q, GIVEN[q][1], INSERT, "I") for q in range(4)]
EDGES = {c: edit_edges(c) for c in "abcdefghijklmnop"}


def least_path(steps: Sequence[Sequence[Edge]], stays: Sequence[Edge], start: int, ends: Sequence[int]) -> tuple[int, str] | None:
    """Least cost, then least audit, from ``start`` to a state in ``ends`` behind all steps; None if there is no path.

    Nodes are (rows done, state). ``steps`` lead to the next row, ``stays`` (of cost above 0) don't. One
    heap grows from the start and one from the ends, the cheaper one first, until their least costs
    together exceed the best crossing: by then every path of that cost has an edge from
    a node settled forward to a node settled backward, and the least concatenated audit over these
    edges wins. Equal costs are settled in the order of rows, so a node's audit is final when
    it is popped. Of two equal-cost audits of a node none is the beginning of the other (what
    follows it would be inserts, which cost), so the least audit of a part is a part of the least whole.
    """
    n = len(steps)
    best: dict[tuple[int, int], tuple[int, str]] = {(0, start): (0, "")}
    back = {(n, q): (0, "") for q in ends}
    heaps = [[(0, 0, start)], [(0, 0, q) for q in ends]]
    heapq.heapify(heaps[1])
    done: tuple[set, set] = (set(), set())
    least = None

    def out(i: int, q: int) -> Iterator[tuple[tuple[int, int], int, str]]:
        if i < n:
            yield from (((i + 1, b), cost, audit) for a, b, cost, audit in steps[i] if a == q)
        yield from (((i, b), cost, audit) for a, b, cost, audit in stays if a == q)

    def into(i: int, q: int) -> Iterator[tuple[tuple[int, int], int, str]]:
        if i:
            yield from (((i - 1, a), cost, audit) for a, b, cost, audit in steps[i - 1] if b == q)
        yield from (((i, a), cost, audit) for a, b, cost, audit in stays if b == q)

    while heaps[0] and heaps[1] and (least is None or heaps[0][0][0] + heaps[1][0][0] <= least):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, order, q = heapq.heappop(heaps[side])
        node = (order, q) if side == 0 else (n - order, q)
        if node in done[side]:
            continue
        done[side].add(node)
        labels, others = (best, back) if side == 0 else (back, best)
        if node in others:
            total = cost + others[node][0]
            least = total if least is None else min(least, total)
        audit = labels[node][1]
        for far, price, letters in (out if side == 0 else into)(*node):
            label = (cost + price, audit + letters if side == 0 else letters + audit)
            if far not in labels or label < labels[far]:
                labels[far] = label
                heapq.heappush(heaps[side], (label[0], far[0] if side == 0 else n - far[0], far[1]))
            if far in others:
                total = label[0] + others[far][0]
                least = total if least is None else min(least, total)
    if least is None:
        return None
    done[0].add((0, start))
    done[1].update((n, q) for q in ends)
    crossings = [best[v][1] + back[v][1] for v in done[0] & done[1] if best[v][0] + back[v][0] == least]
    for node in done[0]:
        for far, price, letters in out(*node):
            if far in done[1] and best[node][0] + price + back[far][0] == least:
                crossings.append(best[node][1] + letters + back[far][1])
    return least, min(crossings)


@lru_cache(maxsize=1 << 16)
def repaired(codes: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a whole conversation."""
    return least_path([EDGES[c] for c in codes], INSERTS, START, FINAL)


def between(steps: Sequence[Sequence[Edge]], stays: Sequence[Edge]) -> list[Edge]:
    """The cheapest way through a run of steps for every state before and behind it."""
    ways = [(a, b, least_path(steps, stays, a, [b])) for a in range(4) for b in range(4)]
    return [(a, b, *way) for a, b, way in ways if way]


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) as short rows in order: conv_id, turn, at, n, initial, fault.

    The order is by turn (nulls first), then role, then a digest of role and text. Roles and texts that
    are null are one space. Equal rows are told by the digest, over all tasks.
    """
    folder = new_folder(rows.sparkSession, "conversation_faults")
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    last = F.substr(F.rtrim(text, F.lit(SPACES)), F.lit(-1))
    own = F.when(last == "", "blank").when(~last.rlike(ENDS), "truncated").otherwise("")
    short = rows.select(
        "conv_id", "turn", role.alias("role"), _digest(role, text).alias("digest"), F.substr(role, F.lit(1), F.lit(1)).alias("initial"), own.alias("fault")
    )
    # Written first: finding the ranges reads them too, and would read the texts again.
    short = stored(short, f"{folder}/short")
    placed = stored(with_positions(short, ["conv_id"], ["turn", "role", "digest"], folder), f"{folder}/placed")
    again = placed.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("times"))
    again = stored(again.where("times > 1").drop("times"), f"{folder}/again")
    marked = placed.join(again, same(placed, again, ["conv_id", "digest"], ["c", "d"]), "left")
    fault = F.when((F.col("fault") != "blank") & (F.col("at") > F.col("first")), "duplicate").otherwise(F.col("fault"))
    return marked.select("conv_id", "turn", "at", "n", "initial", fault.alias("fault"))


def _digest(role: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)


def _code(initial: Column, fault: Column) -> Column:
    """A letter for the role initial and the fault of a row, as ``edit_edges`` reads it."""
    kind = F.instr(F.lit(KINDS[:3]), initial)
    kind = F.when((initial != "") & (kind > 0), kind - 1).otherwise(3)
    place = F.array_position(F.array(*map(F.lit, FAULTS)), fault) - 1
    return F.char(F.lit(97) + kind * 4 + place)


_FOUND = "conv_id {0}, segment long, n long, cost long, audit string, ways array<struct<a:int,b:int,cost:long,audit:string>>"
_WAYS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _search(column: str, most: int, stays: Sequence[Edge], steps: Callable[[object], list], whole: Callable[[object], tuple[int, str]]) -> Callable:
    """Arrow function: rows of at most ``most`` parts to cost and audit, parts of longer ones to the ways through."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cost, audit, ways = [], [], []
            for n, parts in zip(batch.column("n").to_pylist(), batch.column(column).to_pylist(), strict=True):
                found = whole(parts) if n <= most else (None, None)
                cost.append(found[0])
                audit.append(found[1])
                ways.append(None if n <= most else between(steps(parts), stays))
            ways = [None if w is None else [dict(zip(("a", "b", "cost", "audit"), x, strict=True)) for x in w] for w in ways]
            columns = [*(batch.column(c) for c in ("conv_id", "segment", "n")), pa.array(cost, pa.int64()), pa.array(audit, pa.string()), pa.array(ways, _WAYS)]
            yield pa.record_batch(columns, ["conv_id", "segment", "n", "cost", "audit", "ways"])

    return search


def cheapest_edits(marked: DataFrame, folder: str, segment: int = SEGMENT, merged: int = MERGED) -> DataFrame:
    """(conv_id, cost, audit) of every conversation of ``marked`` (``faults``).

    Conversations of up to ``segment`` rows are searched whole. Longer ones are cut into segments, of which
    the cheapest ways between any two states are found; ``merged`` segments at a time become one, until
    the search runs over the last of them. No task holds more rows than a segment has.
    """

    def joined(parts: list[dict]) -> list[list[Edge]]:
        return [[tuple(way.values()) for way in p["ways"]] for p in parts]

    kind = dict(marked.dtypes)["conv_id"]
    codes = marked.select("conv_id", "n", "at", F.floor(F.col("at") / segment).alias("segment"), _code(F.col("initial"), F.col("fault")).alias("code"))
    segments = codes.groupBy("conv_id", "n", "segment").agg(F.sort_array(F.collect_list(F.struct("at", "code"))).alias("rows"))
    segments = segments.select("conv_id", "n", "segment", F.array_join("rows.code", "").alias("codes"))
    search = _search("codes", segment, INSERTS, lambda codes: [EDGES[c] for c in codes], repaired)
    found, size, turn = stored(segments.mapInArrow(search, _FOUND.format(kind)), f"{folder}/segments"), segment, 0
    whole, open_ = found.where("cost IS NOT NULL"), found.where("cost IS NULL")
    search = _search("parts", merged, (), joined, lambda parts: least_path(joined(parts), (), START, FINAL))
    while not open_.isEmpty():
        parts = open_.select("conv_id", F.ceil(F.col("n") / size).alias("n"), F.floor(F.col("segment") / merged).alias("run"), "segment", "ways")
        runs = parts.groupBy("conv_id", "n", "run").agg(F.sort_array(F.collect_list(F.struct("segment", "ways"))).alias("parts"))
        runs, size, turn = runs.select("conv_id", F.col("run").alias("segment"), "n", "parts"), merged, turn + 1
        found = stored(runs.mapInArrow(search, _FOUND.format(kind)), f"{folder}/merged-{turn}")
        whole, open_ = whole.union(found.where("cost IS NOT NULL")), found.where("cost IS NULL")
    return whole.select("conv_id", "cost", "audit")


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each conversation's repaired rows; its audit comes first, then its rows in order.

    Rows stream through; only the audit of the conversation at hand is held.
    """
    conv = text = None
    audit, place, state, first, open_ = "", 0, START, True, False

    def add(role: str, body: str) -> None:
        nonlocal text, state, first
        text.update((("" if first else "\n") + f"{role}:{body}").encode())
        first = False
        state = NEXT[state][role[:1]]

    def inserts() -> None:
        nonlocal place
        while place < len(audit) and audit[place] == "I":
            add(GIVEN[state][0], "")
            place += 1

    for batch in batches:
        ids, digests = [], []
        for conv_, edits, role, body in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")), strict=True):
            if edits is not None:
                if open_:
                    ids.append(conv)
                    digests.append(text.hexdigest())
                conv, audit, place, state, text, first, open_ = conv_, edits, 0, START, hashlib.sha256(), True, True
                inserts()
                continue
            edit = audit[place]
            place += 1
            if edit != "D":
                add(GIVEN[state][0] if edit == "R" else role, body)
            inserts()
        yield pa.record_batch([pa.array(ids, batch.schema.field("conv_id").type), pa.array(digests, pa.string())], ["conv_id", "repaired_sha256"])
    if open_:
        yield pa.record_batch([pa.array([conv], batch.schema.field("conv_id").type), pa.array([text.hexdigest()])], ["conv_id", "repaired_sha256"])


def repair(rows: DataFrame, *, segment: int = SEGMENT, merged: int = MERGED) -> DataFrame:
    """Faults, cheapest repair and its digest for every conversation of ``rows`` (conv_id, turn, role, text).

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. A row's first
    fault counts. Edits keep (0), rerole to user or assistant (3), delete (4, required for blank
    and duplicate rows) or insert an empty user or assistant turn (3); truncated rows that stay add 3. The
    repaired roles' initials are ``(s?(ua)+)?``; of the cheapest edits the audit, their initials in order, is
    least. The digest is of ``role:text`` of the repaired rows, joined by newlines.

    A null conv_id is a conversation of its own; null turns come first and don't count in gaps; null roles
    and texts are one space. Rows with the same turn are in order of role and a digest of role and text; rows that
    repeat role and text are duplicates. Very long texts are read once and held by one task at a time. An
    empty table has no conversations. Other columns are not read.

    Rows are placed over ranges of (conv_id, turn), so that a very long conversation spreads over tasks, as do its
    search and its counts; only the last digest reads one conversation's rows in a single task, as a
    stream that Spark has sorted (SHA-256 can't be split).
    """
    folder = new_folder(rows.sparkSession, "conversation_repair")
    marked = stored(faults(rows), f"{folder}/marked")
    edits = stored(cheapest_edits(marked, folder, segment, merged), f"{folder}/edits")
    turns = marked.groupBy("conv_id", "turn").agg(*(F.sum((F.col("fault") == f).cast("long")).alias(f) for f in FAULTS[1:]))
    counts = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"), *(F.sum(f).alias(f) for f in FAULTS[1:])
    )
    # The initials of neighbours meet by place, so no task holds a conversation.
    ends = marked.select("conv_id", F.explode_outer(F.array(
        F.struct(F.col("at").alias("pair"), F.col("initial").alias("x"), F.lit(None).cast("string").alias("y")),
        F.struct((F.col("at") - 1).alias("pair"), F.lit(None).cast("string").alias("x"), F.col("initial").alias("y")),
    )).alias("e")).select("conv_id", "e.*")
    pairs = ends.groupBy("conv_id", "pair").agg(F.max("x").alias("x"), F.max("y").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    illegal = pairs.groupBy("conv_id").agg(F.sum((~F.concat("x", "y").isin("su", "ua", "au")).cast("long")).alias("illegal"))
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    none = F.lit(None).cast("string")
    lines = rows.select("conv_id", F.lit(1).alias("kind"), "turn", role.alias("role"), _digest(role, text).alias("digest"), none.alias("audit"), text.alias("text"))
    lines = lines.unionByName(edits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).alias("turn"), none.alias("role"), none.alias("digest"), "audit", none.alias("text")))
    lines = lines.repartition(shuffle_width(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    digests = lines.select("conv_id", "audit", "role", "text").mapInArrow(_rewritten, f"conv_id {dict(rows.dtypes)['conv_id']}, repaired_sha256 string")
    out = edits
    for part in (counts, illegal, digests):
        part = part.withColumnRenamed("conv_id", "_c")
        out = out.join(part, out["conv_id"].eqNullSafe(part["_c"]), "left").drop("_c")
    return out.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", F.coalesce("illegal", F.lit(0)).alias("illegal"), "cost", "audit", "repaired_sha256"
    )


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with the faults that the checksum of ``conv_id:turn`` deals out of 20.

    0 drops a row, 1 empties its text, 2 takes its end marks, 3 repeats it, 4 makes it the user's. Nulls are one
    space, but for conv_id and turn themselves.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    dealt = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key) % 20).alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.explode_outer(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    kept = dealt.where("fate <> 0").select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("_copy"))
    return kept.drop("_copy")


def with_all(found: DataFrame, ids: DataFrame) -> DataFrame:
    """``found`` (``repair``) and a row of zeros for every other conv_id of ``ids``."""
    ids = ids.select(F.col("conv_id").alias("_id")).distinct()
    joined = ids.join(found, ids["_id"].eqNullSafe(found["conv_id"]), "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty = {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}
    return joined.withColumn("conv_id", F.col("_id")).drop("_id").withColumns(zero | empty).select(*found.columns)
