"""End-to-end flows: the table build, company search, files, and incremental sync."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import payload as P
from ledgerlens.operators import context as N
from ledgerlens.operators import evaluation as V
from ledgerlens.operators import maintenance as M
from ledgerlens.operators import search as S
from ledgerlens.operators.embedding import hash_embedding
from ledgerlens.plans.answering import find_companies
from ledgerlens.plans.build import build_tables
from ledgerlens.session import new_folder
from ledgerlens.sources import replica as R
from ledgerlens.streaming import sync

from . import ranking, retrieval, silver, texts
from .views import sources, table, view, with_views


def built(spark, d):
    """Every table of the build, with its number of rows and of distinct keys."""
    tables = build_tables(spark, sources(spark, d), new_folder(spark, "build"))
    keys = {
        "all_investors": "company_id", "ranked_investors": "deal_id", "semantic_text": "company_id",
        "chunks": "chunk_id", "embeddings": "chunk_id", "gold": "chunk_id",
    }
    out = None
    for name, key in keys.items():
        row = tables[name].agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(key).alias("n_keys"),
        )
        out = row if out is None else out.unionByName(row)
    return out


GOLD = """
    SELECT chunk_id FROM chunked WHERE company_id IN
        (SELECT company_id FROM market_trends WHERE coalesce(_fivetran_deleted, false) = false)"""
BUILT_SQL = texts.sql(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys FROM {rel}"
        for name, key, rel in (
            ("all_investors", "company_id", "all_inv"), ("ranked_investors", "deal_id", "ranked"),
            ("semantic_text", "company_id", "sem_text"), ("chunks", "chunk_id", "chunked"),
            ("embeddings", "chunk_id", "chunked"), ("gold", "chunk_id", f"({GOLD})"),
        )
    ),
    src="SELECT company_id AS id, semantic_text AS t FROM sem_text",
)


def company_search(spark, d):
    """Company rows for every benchmark text from a freshly built searchable table."""
    gold = build_tables(spark, sources(spark, d), new_folder(spark, "build"))["gold"]
    index = S.build_index(gold, fields=["theme", "region"])
    rows = find_companies(view(spark, d, "text_queries"), index, embed_query=hash_embedding)
    return rows.select("query_id", "pos", "company_id", "company_name", "score", "investor_ranking")


#: The build, the hybrid search over its table, and the company rows, chained.
COMPANY_CTES = {
    **texts.CTES, **retrieval.CTES,
    "src": "SELECT company_id AS id, semantic_text AS t FROM sem_text",
    "corpus": f"""
        SELECT c.chunk_id, c.company_id, c.chunk_index, c.chunk_text, {silver.SEARCHED} AS search_text,
               m.company_name, i.best_investor_rank
        FROM chunked c LEFT JOIN latest_deal m ON c.company_id = m.company_id
        LEFT JOIN vertical_set v ON c.company_id = v.company_id
        LEFT JOIN keyword_set k ON c.company_id = k.company_id
        LEFT JOIN inv_summary i ON m.deal_id = i.deal_id
        WHERE m.company_id IS NOT NULL OR c.company_id NOT IN (SELECT company_id FROM market_trends)""",
    "doc_tokens": f"SELECT chunk_id, {retrieval.TOKENS.format('search_text')} AS ts FROM corpus",
    "rescored": f"""
        SELECT c.query_id, c.chunk_id, c.pos, c.score AS index_score, k.company_id, k.chunk_index, k.company_name, k.best_investor_rank,
               len(list_intersect(a, list_distinct({retrieval.TOKENS.format('k.chunk_text')}))) / len(a) AS s
        FROM candidates c JOIN asked USING (query_id) JOIN corpus k ON k.chunk_id = c.chunk_id
        QUALIFY row_number() OVER (PARTITION BY c.query_id ORDER BY s DESC, pos) <= 10""",
}
COMPANY_SQL = with_views("""
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY first) AS INT) AS pos, company_id, best.name AS company_name, score,
           CASE WHEN best.rank IS NULL THEN 'Undefined' WHEN best.rank <= 2 THEN 'High' WHEN best.rank <= 5 THEN 'Medium' ELSE 'Low' END AS investor_ranking
    FROM (SELECT query_id, company_id, min(p3) AS first, max(index_score) AS score,
                 arg_max({'name': company_name, 'rank': best_investor_rank}, {'score': index_score, 'place': -p3}) AS best
          FROM context10 GROUP BY 1, 2)""", **COMPANY_CTES)


def judgments_csv(spark, d):
    """Judgments written as CSV, read back and cleaned."""
    path = new_folder(spark, "judgments")
    R.write_csv(ranking._gold(spark, d), path)
    return V.judged_chunks(V.clean_judgments(V.read_judgments(spark, path), "dev"))


def predictions_csv(spark, d):
    """Predictions written as CSV and read back."""
    path = new_folder(spark, "predictions")
    R.write_csv(ranking.predictions(spark, d), path)
    return R.read_csv(spark, path, ["query_id", "chunk_id"]).withColumns(
        {"rank": F.col("rank").cast("int"), "gold_label": F.col("gold_label").cast("int")}
    )


def synced(spark, d):
    """Deals arrive as files by status, in an order unlike that of their changes."""
    drops, root = new_folder(spark, "drops"), new_folder(spark, "synced")
    changes = view(spark, d, "market_trends").select(
        "company_id", "deal_id", "deal_size", "house_funding_round", R.DELETED, R.SYNCED
    )
    changes.repartition(3, "house_funding_round").write.parquet(drops)
    sync.run_available(
        spark, drops, changes.schema, root, new_folder(spark, "progress"), "company_id",
        lambda rows: rows.select("company_id", "deal_id", "deal_size"),
        files_per_batch=1, tiebreak=["deal_id"],
    )
    return sync.current_rows(spark, root, "company_id")


SYNCED_SQL = with_views("""
    SELECT company_id, deal_id, deal_size FROM (
      SELECT * FROM market_trends
      QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY _fivetran_synced DESC, deal_id DESC) = 1)
    WHERE coalesce(_fivetran_deleted, false) = false""")


def index_synced(spark, d):
    """Term counts of an index that follows its documents: all of them, then amended, deleted and late ones."""
    docs = view(spark, d, "corpus").select(F.col("chunk_id").alias("company_id"), "chunk_text", "lang")
    drops, root, path = (new_folder(spark, name) for name in ("documents", "synced", "index"))
    gone, at = F.col("deleted").alias(R.DELETED), F.to_timestamp("at").alias(R.SYNCED)
    turns = [
        docs.withColumns({"deleted": F.lit(False), "at": F.lit("2024-01-02")}),
        docs.where("lang <> 'en'").withColumns({"chunk_text": F.concat("chunk_text", F.lit(" amended "), "lang"), "deleted": F.lit(False), "at": F.lit("2024-01-04")}),
        docs.where("length(chunk_text) < 300").withColumns({"deleted": F.lit(True), "at": F.lit("2024-01-03")}),
        docs.withColumns({"chunk_text": F.lit("late"), "deleted": F.lit(False), "at": F.lit("2024-01-01")}),
    ]

    def build(rows):
        return rows.select(F.col("company_id").alias("chunk_id"), "company_id", "chunk_text", hash_embedding(F.col("chunk_text")).alias("embedding"))

    def follow(parents, rows):
        M.update_index(rows, path, parents=parents, parent="company_id", text_col="chunk_text", fields=["company_id"])

    progress = new_folder(spark, "progress")
    for turn in turns:
        # A turn is a batch of as many files as its rows need.
        arrived = turn.select("company_id", "chunk_text", gone, at)
        arrived.write.mode("append").parquet(drops)
        sync.run_available(spark, drops, arrived.schema, root, progress, "company_id", build, on_batch=follow)
    M.merge_segments(spark, path, fields=["company_id"])
    rows = sync.current_rows(spark, root, "company_id")
    index = S.open_index(rows, path, fields=["company_id"])
    terms = index.terms.groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
    vectors = index.dense.agg(F.count(F.lit(1)).alias("n_vectors"))
    return terms.crossJoin(F.broadcast(index.stats.select("n_docs", "n_tokens"))).crossJoin(F.broadcast(vectors))


INDEX_SQL = with_views(r"""
    SELECT * FROM (WITH now AS (
      SELECT chunk_id, chunk_text || CASE WHEN lang <> 'en' THEN ' amended ' || lang ELSE '' END AS t FROM corpus
      WHERE length(chunk_text) >= 300 OR lang <> 'en'),
    words AS (SELECT chunk_id, list_filter(string_split_regex(lower(t), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS ts FROM now),
    sums AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_tokens, count(*) AS n_vectors FROM words)
    SELECT term, count(*) AS df, n_docs, n_tokens, n_vectors
    FROM (SELECT chunk_id, unnest(list_distinct(ts)) AS term FROM words), sums GROUP BY ALL)""")


def merged_filters(spark, d):
    """Caller filters for theme and country; the extracted theme wins."""
    rows = texts._answers(spark, d)
    extra = F.create_map(
        F.lit("theme"), F.array(F.lit("MACHINERY")), F.lit("country"), F.array(F.lit("FRANCE"))
    )
    found = P.rewrite_filters(P.loose_json_object(F.col("response")))
    return rows.select("query_id", texts._filters_text(P.merge_filters(extra, found)).alias("filters"))


MERGED_SQL = with_views("""
    SELECT query_id, CASE conv_id % 5
        WHEN 0 THEN 'country=FRANCE;region=ASIA|EUROPE;theme=BUILDING'
        WHEN 2 THEN 'country=FRANCE;deal_year=2019;theme=MACHINERY'
        ELSE 'country=FRANCE;theme=MACHINERY' END AS filters
    FROM user_turns""")


def _make_scorer():
    return lambda query, docs: [float(len(t)) for t in docs]


def model_scores(spark, d):
    return N.model_scores(ranking._turns(spark, d), ranking._asked(spark, d), _make_scorer)


def overlap_scores(spark, d):
    hits = ranking._turns(spark, d).withColumn("title", F.col("chunk_id"))
    scores = N.overlap_scores(hits, ranking._asked(spark, d), text_cols=("title", "chunk_text"))
    return scores.withColumn("new_score", F.round("new_score", 6))


OVERLAP_SQL = r"""
    SELECT t.query_id, pos, round(len(list_intersect(a, list_distinct(list_filter(
             string_split_regex(lower(chunk_id || ' ' || chunk_text), '[^\p{L}\p{N}]+'), lambda w: w <> ''))))
           / len(a), 6) AS new_score
    FROM turns t JOIN (SELECT query_id, list_distinct(string_split(normalized, ' ')) AS a FROM asked) q
      ON t.query_id = q.query_id WHERE pos <= 50"""

QUERIES = {
    "build_tables": (built, BUILT_SQL),
    "company_search": (company_search, COMPANY_SQL),
    "judgments_csv": (judgments_csv, ranking.sql("SELECT * FROM judged")),
    "predictions_csv": (
        predictions_csv,
        ranking.QUERIES["evaluation_predictions"][1],
    ),
    "incremental_sync": (synced, SYNCED_SQL),
    "index_sync": (index_synced, INDEX_SQL),
    "merged_filters": (merged_filters, MERGED_SQL),
    "model_scores": (
        model_scores,
        ranking.sql(r"""SELECT query_id, pos, CAST(length(trim(regexp_replace(chunk_text, '\s+', ' ', 'g'))) AS DOUBLE)
                        AS new_score FROM turns WHERE pos <= 50"""),
    ),
    "overlap_scores": (overlap_scores, ranking.sql(OVERLAP_SQL)),
}
