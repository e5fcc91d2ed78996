"""Searchable tables and batch retrieval."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.operators import evaluation as V
from ledgerlens.operators import postings as L
from ledgerlens.operators import search as S
from ledgerlens.operators import vectors as D
from ledgerlens.operators.context import ANSWER_HEAD
from ledgerlens.operators.embedding import hash_embedding
from ledgerlens.plans.answering import answer_queries, query_outputs
from ledgerlens.plans.evaluation import evaluate_answers, write_evaluation
from ledgerlens.session import new_folder, stored

from .views import table, view, with_views

PROBES = 3
K = 10
FIELDS = ["lang", "source"]
TOKENS = r"list_filter(string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"


def bm25(queries: str, k: int, condition: str = "true") -> str:
    """BM25 hits of a relation (query_id, query_text, ...) named ``queries``."""
    return f"""
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INT)
                 AS hit_no, chunk_id, score
        FROM (SELECT q.query_id, p.chunk_id,
                     round(sum(q.qtf * ln(1.0 + (n_docs - df + 0.5) / (df + 0.5)) * (p.tf * 2.2)
                       / (p.tf + 1.2 * (0.25 + 0.75 * p.dl / avg_dl))), 6) AS score
              FROM (SELECT query_id, term, count(*) AS qtf
                    FROM (SELECT query_id, unnest({TOKENS.format('query_text')}) AS term FROM {queries})
                    GROUP BY 1, 2) q
              JOIN term_df USING (term) JOIN postings p USING (term)
              CROSS JOIN corpus_size
              JOIN corpus c ON c.chunk_id = p.chunk_id JOIN {queries} qq ON qq.query_id = q.query_id
              WHERE {condition} GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) <= {k}"""


def cosine(queries: str, corpus: str, k: int) -> str:
    """Cosine hits of hashed token counts (id, b, n) given as relations of pairs."""
    return f"""
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INT)
                 AS hit_no, chunk_id, score
        FROM (SELECT q.id AS query_id, c.id AS chunk_id, round(sum(q.n * c.n), 6) AS score
              FROM {queries} q JOIN {corpus} c USING (b) GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) <= {k}"""


def hashed(relation: str, key: str, text: str) -> str:
    return f"""
        SELECT id, b, n / sqrt(sum(n * n) OVER (PARTITION BY id)) AS n FROM (
          SELECT id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS b, count(*) AS n
          FROM (SELECT {key} AS id, unnest({TOKENS.format(text)}) AS term FROM {relation}) GROUP BY 1, 2)"""


CTES = {
    "doc_tokens": f"SELECT chunk_id, {TOKENS.format('chunk_text')} AS ts FROM corpus",
    "postings": """
        SELECT chunk_id, len(ts) AS dl, term, count(*) AS tf
        FROM (SELECT chunk_id, ts, unnest(ts) AS term FROM doc_tokens) GROUP BY ALL""",
    "term_df": "SELECT term, count(*) AS df FROM postings GROUP BY 1",
    "corpus_size": "SELECT count(*) AS n_docs, avg(len(ts)) AS avg_dl FROM doc_tokens",
    "full_text": bm25("text_queries", K),
    "q_hash": hashed("text_queries", "query_id", "query_text"),
    "c_hash": hashed("corpus", "chunk_id", "chunk_text"),
    "dense": cosine("q_hash", "c_hash", K),
    "fused": f"""
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INT)
                 AS hit_no, chunk_id, score
        FROM (SELECT query_id, chunk_id, round(sum(1.0 / (60 + hit_no)), 9) AS score
              FROM (SELECT * FROM dense UNION ALL SELECT * FROM full_text) GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) <= {K}""",
    # One query per label: the mean of its vectors.
    "prototypes": """
        SELECT CAST(label AS STRING) AS query_id, list(m ORDER BY i) AS v
        FROM (SELECT label, i, avg(x) AS m
              FROM (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(0, 64)) AS i FROM embeddings)
              GROUP BY 1, 2) GROUP BY 1""",
    "prototype_hits": f"""
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INT)
                 AS hit_no, chunk_id, score
        FROM (SELECT query_id, 'd' || vec_id AS chunk_id,
                     round(list_cosine_similarity(v, list_transform(embedding, lambda x: x::DOUBLE)), 6) AS score
              FROM prototypes CROSS JOIN embeddings)
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) <= {K}""",
    # Rewrites: the lines of a text, then the text; filters by its length.
    "rewritten": """
        SELECT query_id, query_text AS whole,
               list_filter(list_transform(string_split(query_text, chr(10)), lambda l: trim(l)), lambda l: l <> '') AS ls,
               CASE WHEN length(query_text) < 150 THEN 'xx' WHEN length(query_text) < 250 THEN 'en' END AS lang_filter,
               CASE WHEN length(query_text) >= 350 THEN ['src1', 'src2', 'src3'] END AS source_filter
        FROM text_queries""",
    "rewrite_rows": """
        SELECT query_id AS qid, unnest(rs) AS query_text, unnest(range(0, len(rs))) AS rewrite_no,
               lang_filter, source_filter
        FROM (SELECT *, list_slice(CASE WHEN list_contains(ls, whole) THEN ls ELSE list_append(ls, whole) END, 1, 5)
              AS rs FROM rewritten)""",
    "rewrite_queries": "SELECT *, qid || '#' || rewrite_no AS query_id FROM rewrite_rows",
    "filtered": bm25(
        "rewrite_queries", 20,
        "(lang_filter IS NULL OR lang_filter = c.lang)"
        " AND (source_filter IS NULL OR list_contains(source_filter, c.source))",
    ),
    "unfiltered": bm25("rewrite_queries", 20),
    "found": """
        SELECT r.qid, r.rewrite_no, f.* FROM filtered f JOIN rewrite_queries r ON f.query_id = r.query_id""",
    "merged": """
        SELECT qid, rewrite_no, hit_no, chunk_id, score, true AS with_filters FROM found
        UNION ALL
        SELECT r.qid, r.rewrite_no, hit_no, chunk_id, score, false
        FROM unfiltered u JOIN rewrite_queries r ON u.query_id = r.query_id
        WHERE (lang_filter IS NOT NULL OR source_filter IS NOT NULL) AND r.qid NOT IN (SELECT qid FROM found)""",
    "placed": """
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rewrite_no, hit_no) AS p FROM merged""",
    "rewrite_hits": """
        SELECT qid AS query_id, chunk_id, score, with_filters, rewrite_no,
               CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, first_p) AS INT) AS pos
        FROM (SELECT *, min(p) OVER (PARTITION BY qid, chunk_id) AS first_p,
                     row_number() OVER (PARTITION BY qid, chunk_id ORDER BY score DESC, p) AS rn FROM placed)
        WHERE rn = 1""",
    # Judgments: a document with all sentences of a benchmark text is a 3, with some a 1.
    "q_sentences": r"""
        SELECT DISTINCT query_id, s FROM (SELECT query_id, trim(unnest(string_split_regex(query_text, '[.\n]+'))) AS s
        FROM text_queries) WHERE s <> ''""",
    "d_sentences": r"""
        SELECT DISTINCT chunk_id, s FROM (SELECT chunk_id, trim(unnest(string_split_regex(chunk_text, '[.\n]+'))) AS s
        FROM corpus) WHERE s <> ''""",
    "shared": """
        SELECT query_id, chunk_id, count(*) AS n FROM q_sentences JOIN d_sentences USING (s) GROUP BY 1, 2""",
    "wanted": "SELECT query_id, count(*) AS m FROM q_sentences GROUP BY 1",
    "judged": """
        SELECT query_id, chunk_id, CASE WHEN n = m THEN 3 ELSE 1 END AS label
        FROM shared JOIN wanted USING (query_id)""",
    "text_metrics": f"""
        SELECT q.query_id, coalesce(g.n, 0) AS num_gold_chunks,
               CASE WHEN first_pos IS NULL THEN 0.0 ELSE 1.0 END AS hit_rate,
               round(coalesce(1.0 / first_pos, 0.0), 6) AS mrr,
               round(CASE WHEN ideal > 0 THEN coalesce(dcg, 0) / ideal ELSE 0.0 END, 6) AS ndcg
        FROM text_queries q
        LEFT JOIN (SELECT query_id, count(*) AS n FROM judged GROUP BY 1) g ON q.query_id = g.query_id
        LEFT JOIN (SELECT h.query_id, sum((pow(2, coalesce(label, 0)) - 1) / log2(hit_no + 1)) AS dcg,
                          min(hit_no) FILTER (label >= 2) AS first_pos
                   FROM full_text h LEFT JOIN judged j ON h.query_id = j.query_id AND h.chunk_id = j.chunk_id
                   GROUP BY 1) a ON q.query_id = a.query_id
        LEFT JOIN (SELECT query_id, sum((pow(2, label) - 1) / log2(rk + 1)) AS ideal
                   FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY label DESC) AS rk FROM judged)
                   WHERE rk <= {K} GROUP BY 1) i ON q.query_id = i.query_id""",
}


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The whole flow: hybrid candidates, overlap scores, collapse, diversity, packing.
CTES.update({
    "plain_queries": r"""
        SELECT query_id, trim(regexp_replace(query_text, '\s+', ' ', 'g')) AS query_text FROM text_queries""",
    "p_hash": hashed("plain_queries", "query_id", "query_text"),
    "dense50": cosine("p_hash", "c_hash", 50),
    "full50": bm25("plain_queries", 50),
    "candidates": """
        SELECT query_id, chunk_id, score,
               row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS pos
        FROM (SELECT query_id, chunk_id, round(sum(1.0 / (60 + hit_no)), 9) AS score
              FROM (SELECT * FROM dense50 UNION ALL SELECT * FROM full50) GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) <= 50""",
    "asked": f"SELECT query_id, list_distinct({TOKENS.format('query_text')}) AS a FROM plain_queries",
    "rescored": """
        SELECT c.query_id, c.chunk_id, c.pos, len(list_intersect(a, list_distinct(ts))) / len(a) AS s,
               k.company_id, k.chunk_index, k.chunk_text
        FROM candidates c JOIN asked USING (query_id) JOIN doc_tokens t ON t.chunk_id = c.chunk_id
        JOIN corpus k ON k.chunk_id = c.chunk_id
        QUALIFY row_number() OVER (PARTITION BY c.query_id ORDER BY s DESC, pos) <= 10""",
    "placed10": """
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, pos) AS p FROM rescored""",
    "distinct10": """
        SELECT *, min(p) OVER (PARTITION BY query_id, company_id) AS p_first FROM placed10
        QUALIFY row_number() OVER (PARTITION BY query_id, company_id, chunk_index ORDER BY s DESC, p) = 1""",
    "collapsed10": """
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, p_first, r) AS p2
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id, company_id ORDER BY s DESC, p) AS r
              FROM distinct10) WHERE r <= 6""",
    "context10": """
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY p2) AS p3
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id, company_id ORDER BY p2) AS r3 FROM collapsed10)
        WHERE r3 <= 3""",
    "packed10": r"""
        SELECT query_id, sum(n) + 2 * (count(*) - 1) AS n_context
        FROM (SELECT query_id, n, sum(n) OVER (PARTITION BY query_id ORDER BY p3) AS used
              FROM (SELECT query_id, p3, length(chunk_id) + 3
                             + length(trim(regexp_replace(chunk_text, '\s+', ' ', 'g'))) AS n FROM context10))
        WHERE used <= 14000 GROUP BY 1""",
})
ANSWERED_SQL = f"""
    SELECT q.query_id, q.query_text AS normalized,
           (SELECT CAST(count(*) AS INT) FROM candidates c WHERE c.query_id = q.query_id) AS n_candidates,
           (SELECT string_agg(chunk_id, ',' ORDER BY p3) FROM context10 x WHERE x.query_id = q.query_id) AS chunks,
           CAST(length({_lit(ANSWER_HEAD)}) + length('## Sources## Question## Task') + 5 + length(q.query_text)
             + coalesce(n_context, length('(none)')) AS INT) AS n_prompt
    FROM plain_queries q LEFT JOIN packed10 USING (query_id)"""


def sql(text: str) -> str:
    return with_views(text, **CTES)


def _index(spark, d, vectors=False, fields=()):
    corpus = view(spark, d, "corpus")
    if vectors:
        # The vectors of a real index are stored; here they are written once per query.
        corpus = stored(corpus.withColumn("embedding", hash_embedding(F.col("chunk_text"))), new_folder(spark, "vectors"))
    return S.build_index(
        corpus, text_col="chunk_text", vector="embedding" if vectors else None, fields=fields
    )


def _queries(spark, d, vectors=False):
    q = view(spark, d, "text_queries")
    return q.withColumn("embedding", hash_embedding(F.col("query_text"))) if vectors else q


def _prototypes(spark, d):
    parts = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy("label").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("embedding")
    ).withColumnRenamed("label", "query_id")


def dense(**options):
    return lambda s, d: D.dense_topk(_prototypes(s, d), view(s, d, "doc_vectors"), K, **options)


def probed(spark, d):
    """Clusters around the label means, so that the comparison can follow the probes."""
    queries = _prototypes(spark, d)
    centers = np.array([r["embedding"] for r in queries.orderBy("query_id").collect()])
    corpus = view(spark, d, "doc_vectors").withColumn("chunk_text", F.lit("x"))
    index = S.build_index(corpus, text_col="chunk_text", centers=centers)
    return S.retrieve(queries.withColumn("query_text", F.lit("x")), index, K, mode="DENSE", probes=PROBES)


PROBED_SQL = f"""
    WITH centers AS (SELECT v, row_number() OVER (ORDER BY CAST(query_id AS INT)) AS cluster FROM prototypes),
      member AS (
        SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e,
               (SELECT arg_max(cluster, list_cosine_similarity(v, list_transform(embedding, lambda x: x::DOUBLE))) FROM centers) AS cluster
        FROM embeddings),
      probe AS (
        SELECT query_id, p.v, cluster FROM prototypes p CROSS JOIN centers c
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY list_cosine_similarity(p.v, c.v) DESC, cluster) <= {PROBES})
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INT) AS hit_no, chunk_id, score
    FROM (SELECT query_id, 'd' || vec_id AS chunk_id, round(list_cosine_similarity(v, e), 6) AS score
          FROM probe JOIN member USING (cluster))
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) <= {K}"""


def quantised(spark, d):
    """How many of the exact best a search over quantised vectors finds; its queries are each tenth vector, moved a bit."""
    corpus = view(spark, d, "doc_vectors")
    moved = F.transform("embedding", lambda x, i: x.cast("double") + F.sin(i.cast("double")) * 0.05)
    queries = corpus.where("CAST(substr(chunk_id, 2) AS BIGINT) % 10 = 0").select(F.col("chunk_id").alias("query_id"), moved.alias("embedding"))
    books = D.train_codebooks(corpus)
    codes = D.quantised(corpus, books, new_folder(spark, "codes"))
    near = D.quantised_topk(queries, codes, books, corpus, K)
    exact = D.dense_topk(queries, corpus, K)
    both = exact.join(near.select("query_id", "chunk_id", F.col("score").alias("near")), ["query_id", "chunk_id"], "left")
    found = both.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_exact"), F.count("near").alias("n_found"))
    return found.agg(
        F.count(F.lit(1)).alias("n_queries"), F.sum("n_exact").alias("n_exact"), (F.sum("n_found") >= 0.9 * F.sum("n_exact")).alias("recall_reached")
    )


QUANTISED_SQL = f"""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
      q AS (SELECT 'd' || vec_id AS query_id, list_transform(e, lambda x, i: x + sin(i - 1) * 0.05) AS w FROM v WHERE vec_id % 10 = 0),
      hits AS (SELECT query_id FROM q CROSS JOIN v
               QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(w, e), 6) DESC, 'd' || vec_id) <= {K})
    SELECT count(DISTINCT query_id) AS n_queries, count(*) AS n_exact, true AS recall_reached FROM hits"""


def retrieve(mode: str):
    vectors = mode != "FULL_TEXT"
    return lambda s, d: S.retrieve(_queries(s, d, vectors), _index(s, d, vectors), K, mode=mode)


def full_text_joined(spark, d):
    """Slices of 16 chunks, of which one is searched before the others are bounded."""
    index = S.build_index(view(spark, d, "corpus"), text_col="chunk_text", vector=None, slice_bits=4)
    return S.full_text_topk(_queries(spark, d), index, K, lead=1)


def term_stats(spark, d):
    lexical = L.lexical_rows(view(spark, d, "corpus"), "chunk_text")
    posted = L.postings(lexical)
    return posted.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf"), F.max("dl").alias("longest")
    )


def _understood(spark, d):
    q = view(spark, d, "text_queries")
    text = F.col("query_text")
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    n = F.length(text)
    none = F.create_map().cast("map<string,array<string>>")

    def only(field: str, *values: str):
        return F.create_map(F.lit(field), F.array(*[F.lit(v) for v in values]))

    filters = (
        F.when(n < 150, only("lang", "xx"))
        .when(n < 250, only("lang", "en"))
        .when(n >= 350, only("source", "src1", "src2", "src3"))
        .otherwise(none)
    )
    return q.select(
        "query_id", text.alias("normalized"),
        F.slice(F.array_distinct(F.array_append(lines, text)), 1, 5).alias("rewritten_queries"),
        filters.alias("filters"),
    )


def rewrites(spark, d):
    index = _index(spark, d, fields=FIELDS)
    hits = S.retrieve_rewrites(_understood(spark, d), index, mode="FULL_TEXT", per_query_top_k=20)
    applied = F.coalesce(F.size("_filters_applied") > 0, F.lit(False))
    return hits.select("query_id", "pos", "chunk_id", "score", "rewrite_no", applied.alias("filters_applied"))


REWRITES_SQL = """
    SELECT h.query_id, pos, chunk_id, score, CAST(rewrite_no AS INT) AS rewrite_no,
           with_filters AND (lang_filter IS NOT NULL OR source_filter IS NOT NULL) AS filters_applied
    FROM rewrite_hits h JOIN rewritten r ON h.query_id = r.query_id"""


def _answered(spark, d):
    index = _index(spark, d, vectors=True)
    return answer_queries(
        view(spark, d, "text_queries"), index, mode="HYBRID", embed_query=hash_embedding,
        columns=["company_id", "chunk_index", "chunk_text"],
    )


def answered(spark, d):
    out = query_outputs(_answered(spark, d))
    return out.select(
        "query_id", "normalized", F.size("candidates").alias("n_candidates"),
        F.array_join("chunks.chunk_id", ",").alias("chunks"), F.length("answer_prompt").alias("n_prompt"),
    )


def judgments(spark, d):
    """Which documents hold the sentences of a benchmark text."""

    def sentences(df, key: str, text: str):
        parts = F.filter(F.transform(F.split(text, r"[.\n]+"), lambda x: F.trim(x)), lambda s: s != "")
        return df.select(key, F.explode(F.array_distinct(parts)).alias("s"))

    q = sentences(view(spark, d, "text_queries"), "query_id", "query_text")
    c = sentences(view(spark, d, "corpus"), "chunk_id", "chunk_text")
    shared = c.join(q, "s").groupBy("query_id", "chunk_id").agg(F.count(F.lit(1)).alias("n"))
    wanted = q.groupBy("query_id").agg(F.count(F.lit(1)).alias("m"))
    return shared.join(wanted, "query_id").select(
        "query_id", "chunk_id", F.when(F.col("n") == F.col("m"), 3).otherwise(1).alias("label")
    )


def text_metrics(spark, d):
    hits = retrieve("FULL_TEXT")(spark, d).withColumnRenamed("hit_no", "pos")
    out = V.per_query_metrics(hits, view(spark, d, "text_queries"), judgments(spark, d), k=K)
    return out.select(
        "query_id", "num_gold_chunks", "hit_rate", F.round("mrr", 6).alias("mrr"), F.round("ndcg", 6).alias("ndcg")
    )


def evaluated(spark, d):
    """Judgments through the whole flow to metrics, written as JSON and read back."""
    texts = view(spark, d, "text_queries")
    raw = judgments(spark, d).join(texts, "query_id").select(
        "query_id", "query_text", F.col("chunk_id").alias("relevant_chunk_id"), F.col("label").alias("relevance_label")
    )
    columns = ["company_id", "chunk_index", "chunk_text"]
    result = evaluate_answers(raw, _index(spark, d, True), embed_query=hash_embedding, columns=columns)
    root = new_folder(spark, "evaluation")
    write_evaluation(result, root)
    kept = spark.read.schema(result["per_query"].schema).json(f"{root}/per_query")
    return kept.select(
        "query_id", "num_gold_chunks", "retrieved_count", "hit_rate", F.round("mrr", 6).alias("mrr"),
        F.round("ndcg", 6).alias("ndcg"), F.array_join("rewritten_queries", "|").alias("rewrites"),
        F.size("filters").alias("n_filters"),
    )


EVALUATED_SQL = f"""
    SELECT g.query_id, g.n AS num_gold_chunks, coalesce(h.n, 0) AS retrieved_count,
           CASE WHEN first_pos IS NULL THEN 0.0 ELSE 1.0 END AS hit_rate,
           round(coalesce(1.0 / first_pos, 0.0), 6) AS mrr, round(coalesce(dcg, 0) / ideal, 6) AS ndcg,
           p.query_text AS rewrites, 0 AS n_filters
    FROM (SELECT query_id, count(*) AS n FROM judged GROUP BY 1) g JOIN plain_queries p ON p.query_id = g.query_id
    LEFT JOIN (SELECT x.query_id, count(*) AS n, sum((pow(2, coalesce(label, 0)) - 1) / log2(p3 + 1)) AS dcg,
                      min(p3) FILTER (label >= 2) AS first_pos
               FROM context10 x LEFT JOIN judged j ON x.query_id = j.query_id AND x.chunk_id = j.chunk_id
               GROUP BY 1) h ON h.query_id = g.query_id
    JOIN (SELECT query_id, sum((pow(2, label) - 1) / log2(rk + 1)) AS ideal
          FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY label DESC) AS rk FROM judged)
          WHERE rk <= 10 GROUP BY 1) i ON i.query_id = g.query_id"""

QUERIES = {
    "term_stats": (
        term_stats,
        sql("""SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf, CAST(max(dl) AS INT) AS longest
               FROM postings GROUP BY 1"""),
    ),
    "full_text_topk": (retrieve("FULL_TEXT"), sql("SELECT * FROM full_text")),
    "full_text_topk_joined": (full_text_joined, sql("SELECT * FROM full_text")),
    "dense_topk": (dense(), sql("SELECT * FROM prototype_hits")),
    "dense_topk_sharded": (dense(block_rows=3), sql("SELECT * FROM prototype_hits")),
    "dense_topk_text": (retrieve("DENSE"), sql("SELECT * FROM dense")),
    "probed_topk": (probed, sql(f"SELECT * FROM ({PROBED_SQL})")),
    "quantised_recall": (quantised, sql(f"SELECT * FROM ({QUANTISED_SQL})")),
    "hybrid_topk": (retrieve("HYBRID"), sql("SELECT * FROM fused")),
    "filtered_rewrites": (rewrites, sql(REWRITES_SQL)),
    "evaluate_answers": (evaluated, sql(EVALUATED_SQL)),
    "answer_queries": (answered, sql(ANSWERED_SQL)),
    "text_judgments": (judgments, sql("SELECT query_id, chunk_id, CAST(label AS INT) AS label FROM judged")),
    "text_search_metrics": (text_metrics, sql("SELECT * FROM text_metrics")),
}
