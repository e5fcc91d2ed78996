"""All registered queries: name -> (Spark callable, comparison SQL or None)."""

from __future__ import annotations

from . import flows, ranking, retrieval, silver, texts

QUERIES = {
    **silver.QUERIES, **texts.QUERIES, **ranking.QUERIES, **retrieval.QUERIES, **flows.QUERIES,
}
