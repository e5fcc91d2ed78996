"""Hit-list operators on logged hits, context packing, company rows, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import context as N
from ledgerlens.operators import evaluation as V
from ledgerlens.operators import ranking as K
from ledgerlens.operators import results as C

from ledgerlens.session import new_folder, stored

from .views import table, view, with_views

CTES = {
    "arrived": """
        SELECT * FROM (
          SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rewrite_no, hit_no) AS INT)
                   AS pos, chunk_id, coalesce(score, similarity, 0.0) AS score, parent, chunk_index, chunk_text
          FROM logged_hits) WHERE chunk_id IS NOT NULL""",
    "deduped": """
        SELECT query_id, chunk_id, score, parent, chunk_index, chunk_text,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first_pos) AS INT) AS pos
        FROM (SELECT *, min(pos) OVER (PARTITION BY query_id, chunk_id) AS first_pos,
                     row_number() OVER (PARTITION BY query_id, chunk_id ORDER BY score DESC, pos) AS rn
              FROM arrived) WHERE rn = 1""",
    "keyed": """
        SELECT *, coalesce(nullif(parent, ''), '__unknown__') AS p FROM deduped""",
    "collapsed": """
        SELECT query_id, chunk_id, score, parent, chunk_index, chunk_text, p,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, p_first, rk) AS INT) AS pos
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id, p ORDER BY score DESC, pos) AS rk
              FROM (SELECT *, min(pos) OVER (PARTITION BY query_id, p) AS p_first,
                           CASE WHEN chunk_index IS NULL THEN 1 ELSE
                             row_number() OVER (PARTITION BY query_id, p, chunk_index
                                                ORDER BY score DESC, pos) END AS ri
                    FROM keyed) WHERE ri = 1) WHERE rk <= 6""",
    "spread": """
        SELECT query_id, chunk_id, score, parent, chunk_index, chunk_text,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY pos) AS INT) AS pos
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id, p ORDER BY pos) AS rn FROM collapsed)
        WHERE rn <= 3""",
    # New scores for the first 50 hits; suppliers in debt give one score too few.
    "new_scores": """
        SELECT query_id, pos, (pos * 7919) % 101 / 1.0 AS new_score
        FROM deduped JOIN supplier ON query_id = CAST(s_suppkey AS STRING)
        WHERE pos <= 50 AND (s_acctbal >= 0 OR pos > 1)""",
    "reranked": """
        SELECT d.query_id, d.chunk_id, parent, chunk_index, chunk_text,
               coalesce(new_score, score) AS score,
               CASE WHEN new_score IS NOT NULL THEN 'rerank' ELSE 'hybrid' END AS source,
               CAST(row_number() OVER (PARTITION BY d.query_id ORDER BY new_score DESC NULLS LAST, d.pos) AS INT) AS pos
        FROM deduped d LEFT JOIN
             (SELECT * FROM new_scores WHERE query_id IN
                (SELECT CAST(s_suppkey AS STRING) FROM supplier WHERE s_acctbal >= 0)) n
          ON d.query_id = n.query_id AND d.pos = n.pos
        WHERE d.pos <= 50 QUALIFY row_number() OVER (PARTITION BY d.query_id
          ORDER BY new_score DESC NULLS LAST, d.pos) <= 10""",
    "r_keyed": "SELECT *, coalesce(nullif(parent, ''), '__unknown__') AS p FROM reranked",
    "r_collapsed": """
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, p_first, rk) AS npos
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id, p ORDER BY score DESC, pos) AS rk
              FROM (SELECT *, min(pos) OVER (PARTITION BY query_id, p) AS p_first,
                           CASE WHEN chunk_index IS NULL THEN 1 ELSE
                             row_number() OVER (PARTITION BY query_id, p, chunk_index
                                                ORDER BY score DESC, pos) END AS ri
                    FROM r_keyed) WHERE ri = 1) WHERE rk <= 6""",
    "assembled": """
        SELECT query_id, chunk_id, score, source, parent, chunk_index, chunk_text,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY npos) AS INT) AS pos
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id, p ORDER BY npos) AS rn FROM r_collapsed)
        WHERE rn <= 3""",
    "blocks": r"""
        SELECT query_id, pos, block FROM (
          SELECT *, sum(length(block)) OVER (PARTITION BY query_id ORDER BY pos) AS used FROM (
            SELECT query_id, pos, '[' || chunk_id || ']' || chr(10)
                   || trim(regexp_replace(chunk_text, '\s+', ' ', 'g')) AS block
            FROM turns WHERE trim(regexp_replace(chunk_text, '\s+', ' ', 'g')) <> '')) WHERE used <= 1500""",
    "turns": """
        SELECT CAST(conv_id AS STRING) AS query_id, CAST(turn + 1 AS INT) AS pos,
               conv_id || ':' || turn AS chunk_id, text AS chunk_text FROM conversations""",
    "asked": """
        SELECT DISTINCT CAST(conv_id AS STRING) AS query_id, 'conversation ' || conv_id AS normalized
        FROM conversations""",
    "gold_rows": """
        SELECT CAST(l_suppkey AS STRING) AS query_id, ' supplier ' || l_suppkey AS query_text,
               CAST(l_partkey AS STRING) AS relevant_chunk_id,
               CASE WHEN l_quantity > 45 THEN '3' WHEN l_quantity > 40 THEN ' 2 ' WHEN l_quantity > 35 THEN '1'
                    WHEN l_quantity > 30 THEN 'x' ELSE '0' END AS relevance_label,
               CASE l_returnflag WHEN 'A' THEN 'dev' WHEN 'R' THEN 'test' ELSE ' ' END AS split
        FROM lineitem""",
    "clean": """
        SELECT query_id, trim(query_text) AS query_text, relevant_chunk_id AS chunk_id,
               coalesce(TRY_CAST(trim(relevance_label) AS INT), 0) AS label
        FROM gold_rows WHERE trim(split) IN ('', 'dev')""",
    "judged": "SELECT query_id, chunk_id, max(label) AS label FROM clean WHERE label > 0 GROUP BY 1, 2",
    "judged_q": "SELECT query_id, min(query_text) AS query_text FROM clean GROUP BY 1",
    "labelled": """
        SELECT d.*, coalesce(j.label, 0) AS label FROM deduped d
        LEFT JOIN judged j ON d.query_id = j.query_id AND d.chunk_id = j.chunk_id WHERE pos <= 10""",
    "per_query": """
        SELECT q.query_id, q.query_text, coalesce(g.n, 0) AS num_gold_chunks,
               coalesce(h.n, 0) AS retrieved_count,
               CASE WHEN a.first_pos IS NULL THEN 0.0 ELSE 1.0 END AS hit_rate,
               coalesce(1.0 / a.first_pos, 0.0) AS mrr,
               CASE WHEN i.ideal > 0 THEN coalesce(a.dcg, 0) / i.ideal ELSE 0.0 END AS ndcg
        FROM judged_q q
        LEFT JOIN (SELECT query_id, count(*) AS n FROM judged GROUP BY 1) g ON q.query_id = g.query_id
        LEFT JOIN (SELECT query_id, count(*) AS n FROM deduped GROUP BY 1) h ON q.query_id = h.query_id
        LEFT JOIN (SELECT query_id, sum((pow(2, label) - 1) / log2(pos + 1)) AS dcg,
                          min(pos) FILTER (label >= 2) AS first_pos FROM labelled GROUP BY 1) a
          ON q.query_id = a.query_id
        LEFT JOIN (SELECT query_id, sum((pow(2, label) - 1) / log2(rk + 1)) AS ideal
                   FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY label DESC) AS rk
                         FROM judged) WHERE rk <= 10 GROUP BY 1) i ON q.query_id = i.query_id""",
}


def sql(text: str) -> str:
    return with_views(text, **CTES)


def _arrived(spark, d):
    return stored(K.arrival_hits(view(spark, d, "logged_hits")), new_folder(spark, "arrived"))


def _deduped(spark, d, limit=None):
    """Deduplicated lists, written once because the steps after them read them several times."""
    return stored(K.dedupe_best(_arrived(spark, d), limit=limit), new_folder(spark, "deduped"))


HIT = ("query_id", "pos", "chunk_id", "score", "parent", "chunk_index", "chunk_text")


def _scores(spark, d, hits):
    debt = table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("string").alias("query_id"), (F.col("s_acctbal") < 0).alias("debt")
    )
    kept = hits.filter("pos <= 50").join(debt, "query_id").filter("NOT debt OR pos > 1")
    return kept.select("query_id", "pos", ((F.col("pos") * 7919) % 101 / F.lit(1.0)).alias("new_score"))


def _pool(spark, d):
    """The leading hits that reranking looks at."""
    return _deduped(spark, d, limit=50)


def reranked(spark, d):
    hits = _pool(spark, d)
    return K.rerank(hits, _scores(spark, d, hits)).select(*HIT, "source")


def assembled(spark, d):
    hits = _pool(spark, d)
    return N.assemble_context(hits, _scores(spark, d, hits)).select(*HIT, "source")


def _turns(spark, d):
    return table(spark, d, "conversations").select(
        F.col("conv_id").cast("string").alias("query_id"), (F.col("turn") + 1).cast("int").alias("pos"),
        F.concat_ws(":", "conv_id", "turn").alias("chunk_id"), F.col("text").alias("chunk_text"),
    )


def _asked(spark, d):
    return table(spark, d, "conversations").select(
        F.col("conv_id").cast("string").alias("query_id"),
        F.concat(F.lit("conversation "), "conv_id").alias("normalized"),
    ).distinct()


def packed(spark, d):
    return N.packed_blocks(_turns(spark, d), max_context_chars=1500)


def answer_prompts(spark, d):
    out = N.answer_prompt(_turns(spark, d), _asked(spark, d), max_context_chars=1500)
    return out.select("query_id", F.md5("answer_prompt").alias("prompt_md5"))


def scoring_prompts(spark, d):
    out = N.scoring_prompt(_turns(spark, d), _asked(spark, d))
    return out.select("query_id", F.md5("scoring_prompt").alias("prompt_md5"))


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


ANSWER_SQL = f"""
    SELECT a.query_id, md5('## Sources' || chr(10) || coalesce(ctx, '(none)') || chr(10) || '## Question' || chr(10) || normalized
           || chr(10) || '## Task' || chr(10) || {_lit(N.ANSWER_HEAD)}) AS prompt_md5
    FROM asked a LEFT JOIN (SELECT query_id, string_agg(block, chr(10) || chr(10) ORDER BY pos) AS ctx
                            FROM blocks GROUP BY 1) b ON a.query_id = b.query_id"""
SCORING_SQL = rf"""
    SELECT a.query_id, md5({_lit(N.SCORING_HEAD)} || chr(10) || '## Query' || chr(10) || normalized || repeat(chr(10), 2) || '## Passages' || chr(10)
           || string_agg('#' || pos || ' '
                || substr(trim(regexp_replace(chunk_text, '\s+', ' ', 'g')), 1, 2500), chr(10) ORDER BY pos))
           AS prompt_md5
    FROM asked a JOIN turns t ON a.query_id = t.query_id WHERE pos <= 50 GROUP BY a.query_id, normalized"""


def response_scores(spark, d):
    """Scores written into a model answer per query and read back."""
    hits = _scores(spark, d, _pool(spark, d))
    listed = hits.groupBy("query_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "new_score"))), lambda x: x["new_score"]).alias("s")
    )
    answer = F.concat(F.lit("Here: "), F.to_json(F.struct(F.col("s").alias("scores"))))
    return N.response_scores(listed.select("query_id", answer.alias("response")))


RESPONSE_SQL = """
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY pos) AS INT) AS pos, new_score
    FROM new_scores"""


def _company_rows(spark, d):
    """Deals as result chunks: a query per nation, a chunk per deal."""
    trends = view(spark, d, "market_trends")
    return trends.select(
        F.col("country").alias("query_id"), F.col("deal_no").alias("pos"),
        F.concat(F.lit("c"), "deal_id").alias("chunk_id"),
        F.when(F.col("theme") == "BUILDING", F.concat(F.lit(" "), "company_id")).otherwise(
            F.when(F.col("theme") != "MACHINERY", F.col("company_id")).otherwise(" ")
        ).alias("company_id"),
        F.concat_ws(" ", "company_name", "deal_type").alias("chunk_text"),
        F.round(F.col("deal_size") % 1000, 2).alias("index_score"),
        "company_name", "website", "theme", "main_category", "subcategory", "year_founded",
        "country", "region", "city", "house_funding_round", "deal_type", "deal_type_2",
        "raised_to_date", "invested_equity", "deal_size",
        F.col("area").alias("keywords_text"),
        F.concat_ws(" | ", "main_category", "theme").alias("investor_names"),
        F.when(F.col("deal_year") > 1994, F.col("deal_year") - 1994).alias("best_investor_rank"),
    )


COMPANY_CTES = {
    "rows_": """
        SELECT country AS query_id, deal_no AS pos, 'c' || deal_id AS chunk_id,
               CASE theme WHEN 'BUILDING' THEN ' ' || company_id WHEN 'MACHINERY' THEN ' ' ELSE company_id END AS company_id,
               company_name || ' ' || deal_type AS chunk_text, round(deal_size % 1000, 2) AS index_score, *
               EXCLUDE (company_id)
        FROM market_trends""",
    "best": """
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY k_first) AS INT) AS place
        FROM (SELECT *, min(pos) OVER (PARTITION BY query_id, k) AS k_first,
                     row_number() OVER (PARTITION BY query_id, k ORDER BY index_score DESC, pos) AS rn
              FROM (SELECT *, coalesce(nullif(trim(company_id), ''), chunk_id) AS k FROM rows_)) WHERE rn = 1""",
}
COMPANY_SQL = """
    SELECT query_id, place AS pos, index_score AS score, trim(company_id) AS company_id, company_name, website,
           CAST(NULL AS STRING) AS linkedin, theme, main_category, subcategory, country, region,
           CAST(year_founded AS BIGINT) AS year_founded,
           CAST(trunc(coalesce(raised_to_date, deal_size, invested_equity)) AS BIGINT) AS total_equity_raised,
           house_funding_round AS latest_deal_type, CAST(NULL AS STRING) AS keywords,
           main_category || ', ' || theme AS preferred_investors,
           CASE WHEN deal_year <= 1994 THEN 'Undefined' WHEN deal_year <= 1996 THEN 'High'
                WHEN deal_year <= 1999 THEN 'Medium' ELSE 'Low' END AS investor_ranking,
           chunk_text AS description
    FROM best"""


def company_rows(spark, d):
    return C.company_results(C.best_per_company(_company_rows(spark, d)))


def citations(spark, d):
    """Answers cite their own turn and the one after it; the last turn has no successor."""
    turns = _turns(spark, d)
    answers = turns.select(
        "query_id", F.concat(F.lit("See ["), "chunk_id", F.lit("] and ["), "query_id", F.lit(":"),
                             F.col("pos"), F.lit("], again ["), "chunk_id", F.lit("].")).alias("answer"),
    )
    return N.cited_chunks(answers, turns).distinct()


CITED_SQL = """
    SELECT DISTINCT c.query_id, c.chunk_id, t.chunk_id IS NOT NULL AS in_context
    FROM (SELECT query_id, chunk_id FROM turns UNION SELECT query_id, query_id || ':' || pos FROM turns) c
    LEFT JOIN turns t ON c.query_id = t.query_id AND c.chunk_id = t.chunk_id"""


def _gold(spark, d):
    line = table(spark, d, "lineitem")
    return spark.sql(CTES["gold_rows"].replace("FROM lineitem", "FROM {lineitem}"), lineitem=line)


def judgments(spark, d):
    return V.judged_chunks(V.clean_judgments(_gold(spark, d), "dev"))


def _evaluated(spark, d):
    return V.evaluate(_deduped(spark, d), _gold(spark, d), split="dev")


def per_query(spark, d):
    out = _evaluated(spark, d)[0]
    return out.withColumns({m: F.round(m, 6) for m in ("mrr", "ndcg")})


def means(spark, d):
    out = _evaluated(spark, d)[1]
    return out.withColumns({f"mean_{m}": F.round(f"mean_{m}", 6) for m in ("hit_rate", "mrr", "ndcg")})


def predictions(spark, d):
    return _evaluated(spark, d)[2]


COLS = "query_id, pos, chunk_id, score, parent, chunk_index, chunk_text"

QUERIES = {
    "arrival_hits": (lambda s, d: _arrived(s, d).select(*[c for c in HIT]), sql(f"SELECT {COLS} FROM arrived")),
    "dedupe_best": (
        lambda s, d: K.dedupe_best(_arrived(s, d)).select(*HIT), sql(f"SELECT {COLS} FROM deduped"),
    ),
    "collapse_parents": (
        lambda s, d: K.collapse_parents(_deduped(s, d)).select(*HIT), sql(f"SELECT {COLS} FROM collapsed"),
    ),
    "diversify": (
        lambda s, d: K.diversify(K.collapse_parents(_deduped(s, d))).select(*HIT),
        sql(f"SELECT {COLS} FROM spread"),
    ),
    "rerank": (reranked, sql(f"SELECT {COLS}, source FROM reranked")),
    "assemble_context": (assembled, sql(f"SELECT {COLS}, source FROM assembled")),
    "packed_blocks": (packed, sql("SELECT * FROM blocks")),
    "answer_prompt": (answer_prompts, sql(ANSWER_SQL)),
    "scoring_prompt": (scoring_prompts, sql(SCORING_SQL)),
    "response_scores": (response_scores, sql(RESPONSE_SQL)),
    "company_results": (company_rows, with_views(COMPANY_SQL, **COMPANY_CTES)),
    "cited_chunks": (citations, sql(CITED_SQL)),
    "judgments": (judgments, sql("SELECT * FROM judged")),
    "evaluation_per_query": (
        per_query,
        sql("""SELECT query_id, query_text, num_gold_chunks, retrieved_count, hit_rate,
                      round(mrr, 6) AS mrr, round(ndcg, 6) AS ndcg FROM per_query"""),
    ),
    "evaluation_means": (
        means,
        sql("""SELECT count(*) AS queries_evaluated, round(avg(hit_rate), 6) AS mean_hit_rate,
                      round(avg(mrr), 6) AS mean_mrr, round(avg(ndcg), 6) AS mean_ndcg,
                      CAST(2 AS INT) AS relevant_threshold, 'dev' AS split FROM per_query"""),
    ),
    "evaluation_predictions": (
        predictions,
        sql("""SELECT l.query_id, q.query_text, pos AS rank, chunk_id, label AS gold_label,
                      replace(substr(chunk_text, 1, 300), chr(10), ' ') AS chunk_text_preview
               FROM labelled l JOIN judged_q q ON l.query_id = q.query_id"""),
    ),
}
