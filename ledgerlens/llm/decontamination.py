"""Benchmark decontamination as a prefix-filtered join of item windows with documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.text import let
from ledgerlens.session import fewer_tasks, new_folder, stored

from .url_reputation import ascii_lower

#: ASCII bytes that end a word, once A-Z are folded and before.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BREAK_UNFOLDED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _outer(parts: Column) -> tuple[Column, Column]:
    """How many empty strings a break at its beginning and end leaves in a split text."""
    first = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
    last = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return first, last


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""

    def inner(parts: Column) -> Column:
        first, last = _outer(parts)
        return F.transform(F.slice(parts, first + 1, F.size(parts) - first - last), ascii_lower)

    return let(F.split(F.coalesce(text, F.lit("")), BREAK_UNFOLDED), inner)


def _folded(text: Column) -> Column:
    """Lower-cased, letter by letter: the small form of a capital sigma hangs on its neighbours otherwise."""
    return F.replace(F.lower(text), F.lit("\u03c2"), F.lit("\u03c3"))


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(item_id, words) for every run of ``size`` words of an item, or the whole of a shorter one."""
    items = benchmark.where("item_id IS NOT NULL").select("item_id", words(F.col("text")).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("k", F.least(F.size("w"), F.lit(size)))
    starts = items.withColumn("start", F.explode(F.expr("sequence(1, size(w) - k + 1)")))
    return starts.select("item_id", F.expr("slice(w, start, k)").alias("words"))


def _anchored(windows: DataFrame, counts: DataFrame, folder: str) -> DataFrame:
    """Windows with their necessary prefix: the rarest word of each, and its place.

    A document holds a window only if it holds all of its words, so one word is prefix enough.
    Windows with a word that no document holds are left out.
    """
    windows = stored(windows.withColumn("window_id", F.monotonically_increasing_id()), f"{folder}/windows")
    tokens = windows.select("window_id", F.posexplode(F.transform("words", _folded)).alias("place", "word"))
    rare = tokens.join(counts, "word", "left").groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "place")).alias("rarest")
    ).where("rarest.n > 0")
    anchored = windows.join(rare, "window_id").select("window_id", "item_id", "words", "rarest.word", "rarest.place")
    return stored(fewer_tasks(anchored, windows.count(), 1 << 15), f"{folder}/anchored")


def contamination(documents: DataFrame, benchmark: DataFrame, *, size: int = 13, share: int = 20, carry: Sequence[str] = ()) -> DataFrame:
    """Count the words of every document that lie in an occurrence of a benchmark window.

    Returns one row per row of ``documents`` (doc_id, text): doc_id, n_words, n_hit, items (sorted
    item ids as strings), contaminated (n_hit > 0 and ``share`` * n_hit >= n_words). Windows are
    ``size`` consecutive words of an item, all words of a shorter one. Null and empty texts have no
    words and no hits; repeated rows and null doc_ids are judged row by row; items with null
    id or text have no windows; an empty benchmark leaves all counts 0. Other columns are not read,
    but for those named by ``carry``, which come back as fields of a last column ``row``.

    Words of items are counted over all documents, summed before their shuffle. Document words meet
    the rarest word of each window (Spark broadcasts that side where it is below its bound, and splits hot
    words otherwise), length and position bounds go before the shuffle, and the windows left are
    compared word by word with the text, which moves once. Texts are split once in each of these passes: what
    reads a split text is an outer generator or stands behind one, and the result comes out of a
    generator, as a filter on it would otherwise be pushed down to a copy of the split.
    """
    folder = new_folder(documents.sparkSession, "decontamination")
    # Folded further than A-Z, which is quicker; as many words, and equal where the others are.
    loose = documents.select("doc_id", F.split(_folded(F.coalesce("text", F.lit(""))), BREAK).alias("w"))
    windows = item_windows(benchmark, size)
    asked = windows.select(F.explode(F.transform("words", _folded)).alias("word")).distinct()
    asked = stored(fewer_tasks(asked, size * windows.count()), f"{folder}/words")
    counts = loose.select(F.explode_outer("w").alias("word")).join(asked, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    anchored = _anchored(windows, counts, folder)
    prefixes = anchored.select("word", "place", F.size("words").alias("k"), "window_id")
    places = loose.select("doc_id", F.size("w").alias("parts"), "w").select("doc_id", "parts", F.posexplode_outer("w").alias("pos", "word"))
    start = F.col("pos") - F.col("place")
    fits = (start >= 0) & (start + F.col("k") <= F.col("parts"))
    found = places.join(prefixes, "word").where(fits).select("doc_id", start.alias("start"), "window_id")
    found = found.join(anchored.select("window_id", "item_id", "words"), "window_id").groupBy("doc_id").agg(
        F.collect_list(F.struct("start", F.size("words").alias("k"), F.col("item_id").cast("string").alias("item_id"), "words")).alias("found")
    ).withColumnRenamed("doc_id", "found_in")
    row = F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row") if carry else F.lit(None).alias("row")
    joined = documents.select("doc_id", "text", row).join(found.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("found_in")), "left")
    read = joined.select("doc_id", F.split(F.coalesce("text", F.lit("")), BREAK_UNFOLDED).alias("w"), "found", "row")
    same = F.filter("found", lambda f: F.transform(F.slice("w", f["start"] + 1, f["k"]), ascii_lower) == f["words"])
    n_words = F.size("w") - sum(_outer(F.col("w")))
    read = read.select("doc_id", n_words.cast("long").alias("n_words"), F.coalesce(same, F.expr("filter(found, f -> false)")).alias("same"), "row")
    spans = F.array_sort(F.transform("same", lambda f: F.struct(f["start"].alias("s"), (f["start"] + f["k"]).alias("e"))))
    hit = F.aggregate(
        spans, F.expr("struct(0 AS upto, 0L AS hit)"),
        lambda a, s: F.struct(
            F.greatest(a["upto"], s["e"]).alias("upto"),
            (a["hit"] + F.greatest(F.lit(0), s["e"] - F.greatest(a["upto"], s["s"]))).alias("hit"),
        ),
        lambda a: a["hit"],
    )
    items = F.coalesce(F.array_sort(F.array_distinct(F.transform("same", lambda f: f["item_id"]))), F.array().cast("array<string>"))
    judged = read.select("doc_id", "n_words", F.coalesce(hit, F.lit(0).cast("long")).alias("n_hit"), items.alias("items"), "row")
    contaminated = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    columns = ["doc_id", "n_words", "n_hit", "items", contaminated.alias("contaminated"), *(["row"] if carry else [])]
    return judged.select(F.inline_outer(F.array(F.struct(*columns))))
