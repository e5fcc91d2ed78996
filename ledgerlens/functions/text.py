"""Text expressions: whitespace, normalisation, query language and type, tokens."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character that counts as white space in Unicode, plus the four ASCII separators.
WS = r"[\s\x1c-\x1f]"
NON_ASCII = r"[^\x00-\x7F]"

# Words that decide the type of a query.
COMPARISON_MARKS = (" vs ", "versus", "compare", "difference between")
FACT_STARTS = ("who ", "what ", "when ", "where ", "why ", "how ")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside one expression."""
    return F.get(F.transform(F.array(value), body), 0)


def strip_ws(c: Column) -> Column:
    """Strip all white space at both ends (SQL ``trim`` removes spaces only)."""
    return F.regexp_replace(c, rf"(?U)\A{WS}++|(?<!{WS}){WS}++\z", "")


def collapse_ws(c: Column) -> Column:
    return F.regexp_replace(strip_ws(c), rf"(?U){WS}+", " ")


def is_blank(c: Column) -> Column:
    """NULL, empty or spaces only."""
    return F.coalesce(F.trim(c.cast("string")), F.lit("")) == ""


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip_ws(c.cast("string")), F.lit(""))


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfkc_each(s: pd.Series) -> pd.Series:
    return s.map(
        lambda xs: None
        if xs is None
        else [None if x is None else unicodedata.normalize("NFKC", x) for x in xs]
    )


def normalize_text(c: Column) -> Column:
    """NFKC, strip, one space per white-space run; NULL gives ''.

    Only texts with characters outside ASCII travel to Python.
    """
    foreign = c.rlike(NON_ASCII)
    folded = F.when(foreign, _nfkc(F.when(foreign, c))).otherwise(c)
    return collapse_ws(F.coalesce(folded, F.lit("")))


def normalize_each(c: Column) -> Column:
    """``normalize_text`` over an array of strings."""
    foreign = F.exists(c, lambda x: F.coalesce(x, F.lit("")).rlike(NON_ASCII))
    folded = F.when(foreign, _nfkc_each(F.when(foreign, c))).otherwise(c)
    return F.transform(folded, lambda x: collapse_ws(F.coalesce(x, F.lit(""))))


def detect_language(c: Column) -> Column:
    """'en' when more than nine tenths of the characters are ASCII, else 'unknown'."""
    ascii_share = F.length(F.regexp_replace(c, NON_ASCII, "")) / F.length(c)
    return F.when(F.length(c) > 0, F.when(ascii_share > 0.9, "en").otherwise("unknown")).otherwise(
        "unknown"
    )


def word_count(c: Column) -> Column:
    stripped = strip_ws(c)
    return F.when(stripped == "", 0).otherwise(F.size(F.split(stripped, rf"(?U){WS}+")))


def detect_query_type(c: Column) -> Column:
    """comparison, fact, entity (three words at most) or broad; the first that fits."""
    t = F.lower(F.coalesce(c, F.lit("")))
    comparison = F.lit(False)
    for mark in COMPARISON_MARKS:
        comparison = comparison | t.contains(mark)
    fact = F.lit(False)
    for start in FACT_STARTS:
        fact = fact | t.startswith(start)
    return (
        F.when(comparison, "comparison")
        .when(fact, "fact")
        .when(word_count(t) <= 3, "entity")
        .otherwise("broad")
    )


def tokens(c: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    parts = F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda t: t != "")


ROWS = 1024  # rows whose items are sorted at once


def by_rows(lists: pa.Array, run: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``run`` over a list column, a bounded number of rows at a time."""
    return pa.concat_arrays([run(lists.slice(at, ROWS)) for at in range(0, max(1, len(lists)), ROWS)])


def flat_terms(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of a list column of texts: row and number of every item, and the distinct texts in bytewise order."""
    rows = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    items = lists.flatten().dictionary_encode()
    order = pc.sort_indices(items.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    return rows, place[items.indices.to_numpy(zero_copy_only=False)], items.dictionary.take(order)


def _runs(toks: pa.Array) -> pa.Array:
    rows, items, terms = flat_terms(toks)
    # Distinct (row, term) pairs come out in the order of both.
    pairs, tf = np.unique(rows * max(1, len(terms)) + items, return_counts=True)
    rows, items = np.divmod(pairs, max(1, len(terms)))
    sizes = np.bincount(rows, minlength=len(toks))
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    counts = pa.StructArray.from_arrays([terms.take(pa.array(items)).cast(pa.string()), pa.array(tf, pa.int32())], ["term", "tf"])
    return pa.ListArray.from_arrays(pa.array(ends), counts, mask=pa.array(sizes == 0))


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType())])))
def _counted(toks: pa.Array) -> pa.Array:
    return by_rows(toks, _runs)


def term_counts(toks: Column) -> Column:
    """array<struct<term, tf>> of an array of tokens, in order of the terms; NULL without tokens.

    Arrow takes the tokens of many rows at once, so that a row costs by its tokens only.
    """
    return _counted(toks)
