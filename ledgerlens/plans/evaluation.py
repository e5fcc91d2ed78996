"""Evaluation of the answer flow against relevance judgments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evaluation import (
    clean_judgments,
    judged_chunks,
    judged_queries,
    mean_metrics,
    per_query_metrics,
    predictions,
)
from ..operators.search import SearchIndex
from ..session import durable
from ..sources.replica import require_rows, write_csv, write_json
from .answering import answer_queries


def evaluate_answers(
    judgments: DataFrame, index: SearchIndex, *, k: int = 10, threshold: int = 2, split: str | None = None,
    top_k: int = 10, **options,
) -> dict[str, DataFrame]:
    """per_query, means and predictions of the context chunks that judged queries get.

    Judgments are cleaned once; ``options`` go to ``answer_queries``. Each query's row says which
    rewrites were searched and with which filters.
    """
    clean = durable(require_rows(clean_judgments(judgments, split), "judgments"))
    queries, judged = durable(judged_queries(clean)), durable(judged_chunks(clean))
    out = answer_queries(queries, index, top_k=max(k, top_k), **options)
    hits = durable(out["chunks"])
    asked = out["query_info"].select("query_id", "rewritten_queries", "filters")
    per_query = durable(per_query_metrics(hits, queries, judged, k=k, threshold=threshold).join(asked, "query_id"))
    return {
        "per_query": per_query,
        "means": mean_metrics(per_query, threshold=threshold, split=split),
        "predictions": predictions(hits, queries, judged, k=k),
    }


def write_evaluation(result: dict[str, DataFrame], root: str) -> None:
    """Predictions as CSV; per-query rows (with lists and maps) and means as JSON."""
    write_csv(result["predictions"], f"{root}/predictions")
    for name in ("per_query", "means"):
        write_json(result[name].withColumn("written_at", F.current_timestamp()), f"{root}/{name}")
