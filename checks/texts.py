"""Chunking, embedding, query understanding and JSON columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import payload as P
from ledgerlens.functions import text as X
from ledgerlens.functions import values as V
from ledgerlens.operators import chunking as C
from ledgerlens.operators import context as N
from ledgerlens.operators import embedding as E
from ledgerlens.operators import semantic_text as S
from ledgerlens.operators import understanding as U
from ledgerlens.session import new_folder

from .silver import CTES as SILVER
from .views import sources, table, view, with_views

NN = "chr(10) || chr(10)"
STRIPPED = "chr(10) || chr(13) || chr(9) || ' '"

CTES = {
    **SILVER,
    # Comparison chunker over src(id, t).
    "paras": f"""
        SELECT id, list_filter(list_transform(
                 regexp_split_to_array(replace(t, chr(13), chr(10)), '\\n\\s*\\n+'),
                 lambda p: trim(p, {STRIPPED})), lambda p: p <> '') AS ps
        FROM src WHERE id IS NOT NULL AND trim(t) <> ''""",
    "pieces": f"""
        SELECT id, flatten(list_transform(ps, lambda p:
            CASE WHEN length(p) <= 2500
                 THEN [{{'d': []::VARCHAR[], 'o': p, 'w': true}}]
                 ELSE list_transform(range(0, CAST(ceil((length(p) - 2500) / 2200.0) AS BIGINT) + 1), lambda i:
                     {{'d': []::VARCHAR[], 'o': trim(substr(p, i * 2200 + 1, 2500), {STRIPPED}),
                       'w': false}})
            END)) AS xs FROM paras""",
    "packed": f"""
        SELECT id, list_reduce(list_filter(xs, lambda x: x.o <> ''), lambda a, x:
            CASE WHEN x.w AND a.o = '' THEN {{'d': a.d, 'o': x.o, 'w': true}}
                 WHEN x.w AND length(a.o) + length(x.o) + 2 <= 2500
                 THEN {{'d': a.d, 'o': a.o || {NN} || x.o, 'w': true}}
                 WHEN x.w THEN {{'d': list_append(a.d, a.o), 'o': x.o, 'w': true}}
                 ELSE {{'d': list_append(CASE WHEN a.o = '' THEN a.d ELSE list_append(a.d, a.o) END, x.o),
                        'o': '', 'w': true}} END,
            {{'d': []::VARCHAR[], 'o': '', 'w': true}}) AS r FROM pieces""",
    "packed_list": """
        SELECT id, list_transform(CASE WHEN r.o = '' THEN r.d ELSE list_append(r.d, r.o) END,
                 lambda c: {'d': []::VARCHAR[], 'o': c}) AS cs FROM packed""",
    "attached": f"""
        SELECT id, list_reduce(cs, lambda a, x:
            CASE WHEN a.o = '' THEN {{'d': a.d, 'o': x.o}}
                 WHEN length(x.o) < 80 AND length(a.o) + length(x.o) + 2 <= 2500
                 THEN {{'d': a.d, 'o': a.o || {NN} || x.o}}
                 ELSE {{'d': list_append(a.d, a.o), 'o': x.o}} END,
            {{'d': []::VARCHAR[], 'o': ''}}) AS r FROM packed_list""",
    "chunk_lists": """
        SELECT id, CASE WHEN r.o = '' THEN r.d ELSE list_append(r.d, r.o) END AS cs FROM attached""",
    "numbered": """
        SELECT id, CAST(i AS INT) AS chunk_index, cs[i + 1] AS chunk_text
        FROM (SELECT id, cs, unnest(range(0, len(cs))) AS i FROM chunk_lists)""",
    "chunked": """
        SELECT sha256(id || '|' || chunk_index || '|' || chunk_text) AS chunk_id, id AS company_id,
               chunk_index, chunk_text FROM numbered""",
    # Model answers logged per user turn, in the layouts that occur.
    "answers": """
        SELECT query_id, query_text,
          CASE conv_id % 5
            WHEN 0 THEN '{"queries": ["first view", " second   view ", "first view"], "filters": {"theme": "BUILDING", "region": ["ASIA", "EUROPE"]}}'
            WHEN 1 THEN '```json' || chr(10) || '{"queries": ["fenced"], "filters": {}}' || chr(10) || '```'
            WHEN 2 THEN 'Sure: {"queries": ["a", "b", "c", "d", "e", "f"], "filters": {"deal_year": 2019}} done'
            WHEN 3 THEN '["not", "an object"]'
            ELSE 'nothing {broken' END AS response
        FROM user_turns""",
    "wrapped": """
        SELECT query_id, response,
          CASE CAST(turn AS INT) % 3
            WHEN 0 THEN '{"choices": [{"message": {"content": ' || CAST(to_json(response) AS STRING) || '}}]}'
            WHEN 1 THEN '{"predictions": [' || CAST(to_json(response) AS STRING) || ']}'
            ELSE response END AS logged
        FROM answers JOIN user_turns USING (query_id)""",
    "normed": r"""
        SELECT query_id, query_text, trim(regexp_replace(query_text, '\s+', ' ', 'g')) AS normalized
        FROM user_turns""",
    "vec_json": """
        SELECT CAST(vec_id AS STRING) AS batch_id, label, embedding AS v FROM embeddings""",
}


def sql(text: str, **more: str) -> str:
    return with_views(text, **{**CTES, **more})


DOCS_A = "SELECT CAST(doc_id AS STRING) AS id, text AS t FROM documents"
DOCS_B = "SELECT CAST(doc_id AS STRING) AS id, replace(text, chr(10), chr(10) || chr(10)) AS t FROM documents"


def _soft_end(window: str) -> str:
    """Length of a window of 2,500 characters that ends behind a separator."""
    ends = []
    for mark in C.SOFT_BREAKS:
        end = f"(2501 - strpos(reverse({window}), '{mark[::-1]}'))"
        ends.append(f"CASE WHEN {end} <= 2500 AND {end} - {len(mark)} >= 120 THEN {end} END")
    return f"coalesce({', '.join(ends)}, 2500)"


SOFT_PIECES = f"""
    WITH RECURSIVE ps_ AS (
        SELECT id, unnest(ps) AS p, unnest(range(0, len(ps))) AS pn FROM paras),
      cut AS (
        SELECT id, pn, p, 0 AS off, {_soft_end("substr(p, 1, 2500)")} AS n FROM ps_ WHERE length(p) > 2500
        UNION ALL
        SELECT id, pn, p, off2 AS off, CASE WHEN length(p) - off2 > 2500 THEN {_soft_end("substr(p, off2 + 1, 2500)")} ELSE 2500 END AS n
        FROM (SELECT id, pn, p, off + CASE WHEN n > 300 THEN n - 300 ELSE n END AS off2 FROM cut WHERE length(p) - off > 2500)),
      item AS (
        SELECT id, pn, 0 AS off, p AS o, true AS w FROM ps_ WHERE length(p) <= 2500
        UNION ALL SELECT id, pn, off, trim(substr(p, CAST(off AS BIGINT) + 1, CAST(n AS BIGINT)), {STRIPPED}), false FROM cut)
    SELECT id, list({{'d': []::VARCHAR[], 'o': o, 'w': w}} ORDER BY pn, off) AS xs FROM item GROUP BY id"""
CHUNK_SQL = "SELECT chunk_id, company_id, chunk_index, length(chunk_text) AS n_chars FROM chunked"


def _docs(spark, d, doubled=False):
    text = F.replace("text", F.lit("\n"), F.lit("\n\n")) if doubled else F.col("text")
    return table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("company_id"), text.alias("semantic_text")
    )


def _measured(chunks):
    return chunks.withColumn("n_chars", F.length("chunk_text")).drop("chunk_text")


def semantic_chunks(spark, d):
    return _measured(C.chunk(S.semantic_text(sources(spark, d))))


def soft_chunks(spark, d):
    return _measured(C.chunk(_docs(spark, d, True), soft_breaks=True))


def _rounded(vectors):
    return vectors.select(
        "chunk_id", "company_id", "chunk_index", "embedding_endpoint",
        F.array_join(F.transform("embedding", lambda x: F.format_string("%.6f", x)), ",").alias("vector"),
    )


def hash_vectors(spark, d):
    return _rounded(E.hash_embed(view(spark, d, "doc_chunks")))


HASH_SQL = {
    "toks": r"""
        SELECT chunk_id, unnest(list_filter(string_split_regex(lower(chunk_text), '[^\p{L}\p{N}]+'),
               lambda t: t <> '')) AS term FROM doc_chunks""",
    "buckets": """
        SELECT chunk_id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS b, count(*) AS n
        FROM toks GROUP BY 1, 2""",
    "norms": "SELECT chunk_id, sqrt(sum(n * n)) AS norm FROM buckets GROUP BY 1",
}
HASH_RESULT = """
    SELECT g.chunk_id, c.company_id, c.chunk_index, 'feature-hash' AS embedding_endpoint,
           string_agg(printf('%.6f', coalesce(n, 0) / norm), ',' ORDER BY r) AS vector
    FROM (SELECT chunk_id, norm, unnest(range(0, 64)) AS r FROM norms) g
    LEFT JOIN buckets ON buckets.chunk_id = g.chunk_id AND b = r
    JOIN doc_chunks c ON c.chunk_id = g.chunk_id GROUP BY 1, 2, 3"""


def _make_counter():
    def embedder(texts):
        return [[float(len(t)), float(t.count(" ")), float(t.count("\n"))] for t in texts]

    return embedder


def batch_vectors(spark, d):
    rows = E.embed(view(spark, d, "doc_chunks"), _make_counter, "counter")
    return rows.select(
        "chunk_id", "company_id", "chunk_index", "embedding_endpoint",
        F.array_join(F.transform("embedding", lambda x: x.cast("int")), ",").alias("vector"),
    )


def resumed_vectors(spark, d):
    """Vectors in two runs: of the chunks of long documents, then of all that are missing."""
    chunks, path = view(spark, d, "doc_chunks"), new_folder(spark, "vectors")
    E.embed_missing(chunks.where("chunk_index > 0"), path, _make_counter, "counter")
    rows = E.embed_missing(chunks, path, _make_counter, "counter", waves=2)
    return rows.select(
        "chunk_id", "company_id", "chunk_index", "embedding_endpoint",
        F.array_join(F.transform("embedding", lambda x: x.cast("int")), ",").alias("vector"),
    )


BATCH_SQL = """
    SELECT chunk_id, company_id, chunk_index, 'counter' AS embedding_endpoint,
           length(chunk_text) || ',' || (length(chunk_text) - length(replace(chunk_text, ' ', ''))) || ','
             || (length(chunk_text) - length(replace(chunk_text, chr(10), ''))) AS vector
    FROM doc_chunks"""


def embedding_profile(spark, d):
    return E.embedding_profile(view(spark, d, "doc_vectors"))


def _answers(spark, d):
    turn = view(spark, d, "user_turns")
    kinds = [
        F.lit('{"queries": ["first view", " second   view ", "first view"], '
              '"filters": {"theme": "BUILDING", "region": ["ASIA", "EUROPE"]}}'),
        F.lit('```json\n{"queries": ["fenced"], "filters": {}}\n```'),
        F.lit('Sure: {"queries": ["a", "b", "c", "d", "e", "f"], "filters": {"deal_year": 2019}} done'),
        F.lit('["not", "an object"]'),
        F.lit("nothing {broken"),
    ]
    return turn.withColumn("response", F.get(F.array(*kinds), F.col("conv_id") % 5))


def _wrapped(spark, d):
    quoted = F.expr("substring(to_json(struct(response AS r)), 6, length(to_json(struct(response AS r))) - 6)")
    kinds = [
        F.concat(F.lit('{"choices": [{"message": {"content": '), quoted, F.lit("}}]}")),
        F.concat(F.lit('{"predictions": ['), quoted, F.lit("]}")),
        F.col("response"),
    ]
    return _answers(spark, d).withColumn("logged", F.get(F.array(*kinds), F.col("turn") % 3))


def _filters_text(c):
    items = F.transform(
        F.array_sort(F.map_entries(c)),
        lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], "|")),
    )
    return F.array_join(items, ";")


def query_understanding(spark, d):
    out = U.understand(_wrapped(spark, d), response_col="logged")
    return out.select(
        "query_id", "normalized", "language", "query_type",
        F.array_join("rewritten_queries", " / ").alias("rewrites"),
        _filters_text(F.col("filters")).alias("filters"),
        F.md5("rewrite_prompt").alias("prompt_md5"),
    )


LANGUAGE = r"""CASE WHEN length(normalized) = 0 THEN 'unknown'
    WHEN length(regexp_replace(normalized, '[^\x00-\x7F]', '', 'g')) / length(normalized) > 0.9 THEN 'en'
    ELSE 'unknown' END"""
QTYPE = r"""CASE WHEN regexp_matches(lower(normalized), ' vs |versus|compare|difference between') THEN 'comparison'
    WHEN regexp_matches(lower(normalized), '^(who|what|when|where|why|how) ') THEN 'fact'
    WHEN normalized = '' OR len(string_split(normalized, ' ')) <= 3 THEN 'entity' ELSE 'broad' END"""


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


UNDERSTAND_SQL = f"""
    SELECT n.query_id, normalized, {LANGUAGE} AS language, {QTYPE} AS query_type,
      CASE conv_id % 5
        WHEN 0 THEN array_to_string(list_filter(['first view', 'second view', normalized],
                    lambda q: q <> ''), ' / ')
        WHEN 1 THEN 'fenced / ' || normalized WHEN 2 THEN 'a / b / c / d / e' ELSE normalized END AS rewrites,
      CASE conv_id % 5 WHEN 0 THEN 'region=ASIA|EUROPE;theme=BUILDING' WHEN 2 THEN 'deal_year=2019'
        ELSE '' END AS filters,
      md5(replace({_sql_text(U.REWRITE_TEMPLATE)}, '{{query}}', normalized)) AS prompt_md5
    FROM normed n JOIN user_turns u ON n.query_id = u.query_id"""


def query_plain(spark, d):
    """Understanding without a model: every turn is a query."""
    texts = table(spark, d, "conversations").select(
        F.concat_ws(":", "conv_id", "turn").alias("query_id"), F.col("text").alias("query_text")
    )
    return U.understand(texts).select(
        "query_id", "normalized", "language", "query_type",
        F.array_join("rewritten_queries", " / ").alias("rewrites"),
    )


PLAIN_SQL = {
    "normed": r"""
        SELECT conv_id || ':' || turn AS query_id,
               trim(regexp_replace(text, '\s+', ' ', 'g')) AS normalized FROM conversations"""
}


def loose_json(spark, d):
    obj = P.loose_json_object(P.assistant_text(F.col("logged")))
    return _wrapped(spark, d).select("query_id", "logged", obj.alias("object"))


LOOSE_SQL = """
    SELECT w.query_id, w.logged,
      CASE WHEN conv_id % 5 = 0 THEN w.response
           WHEN conv_id % 5 = 1 THEN '{"queries": ["fenced"], "filters": {}}'
           WHEN conv_id % 5 = 2 THEN regexp_extract(w.response, '\\{.*\\}') END AS object
    FROM wrapped w JOIN user_turns u ON w.query_id = u.query_id"""


def response_vectors(spark, d):
    """Vectors sent through each response layout and read back."""
    rows = table(spark, d, "embeddings").select(
        F.col("vec_id").cast("string").alias("batch_id"), "label",
        F.col("embedding").cast("array<double>").alias("v"),
    )
    vec = F.to_json("v")
    kinds = [
        F.concat(F.lit('{"predictions": ['), vec, F.lit("]}")),
        F.concat(F.lit('{"data": [{"embedding": '), vec, F.lit("}]}")),
        F.concat(F.lit('{"outputs": [{"vector": '), vec, F.lit("}]}")),
        F.concat(F.lit('{"output": [{"values": '), vec, F.lit("}]}")),
        F.concat(F.lit("["), vec, F.lit("]")),
    ]
    rows = rows.withColumn("response", F.get(F.array(*kinds), F.col("label") % 5))
    out = rows.select("batch_id", F.posexplode(P.response_vectors(F.col("response"))).alias("at", "w"))
    return out.select(
        "batch_id", "at", F.array_join(F.transform("w", lambda x: F.round(x, 6).cast("decimal(12,6)")), ",").alias("vector")
    )


VECTOR_SQL = """
    SELECT batch_id, CAST(0 AS INT) AS at, array_to_string(list_transform(v,
           lambda x: CAST(round(x::DOUBLE, 6) AS DECIMAL(12,6))), ',') AS vector FROM vec_json"""


def tolerant_values(spark, d):
    """Numbers and labels out of text columns."""
    rows = table(spark, d, "customer").join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    amount = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("n/a "), F.col("c_name"))).otherwise(
        F.format_number("c_acctbal", 2)
    )
    names = F.concat_ws(" | ", "c_mktsegment", F.lit(" "), "n_name")
    return rows.withColumn("amount", amount).select(
        "c_custkey",
        V.as_float(F.col("amount")).alias("amount_float"),
        V.as_int(F.col("amount")).alias("amount_int"),
        V.investor_list(names).alias("names"),
        V.ranking_label(F.col("c_nationkey")).alias("rank_label"),
        V.ranking_label(F.upper("c_mktsegment"), numeric=False).alias("text_label"),
        V.first_non_blank(F.when(F.col("c_acctbal") > 0, F.lit("  ")), F.col("c_mktsegment")).alias("first_text"),
        V.section("Segment: ", F.col("c_mktsegment")).alias("section"),
    )


VALUES_SQL = """
    SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS amount_float,
           CASE WHEN c_acctbal >= 0 THEN CAST(trunc(c_acctbal) AS BIGINT) END AS amount_int,
           c_mktsegment || ', ' || n_name AS names,
           CASE WHEN c_nationkey <= 2 THEN 'High' WHEN c_nationkey <= 5 THEN 'Medium' ELSE 'Low' END AS rank_label,
           upper(c_mktsegment) AS text_label, c_mktsegment AS first_text,
           'Segment: ' || c_mktsegment AS section
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""


QUERIES = {
    "chunk_documents": (lambda s, d: _measured(C.chunk(_docs(s, d))), sql(CHUNK_SQL, src=DOCS_A)),
    "chunk_paragraphs": (
        lambda s, d: _measured(C.chunk(_docs(s, d, True))), sql(CHUNK_SQL, src=DOCS_B),
    ),
    "chunk_semantic_text": (
        semantic_chunks, sql(CHUNK_SQL, src="SELECT company_id AS id, semantic_text AS t FROM sem_text"),
    ),
    "chunk_soft_breaks": (soft_chunks, sql(CHUNK_SQL, src=DOCS_B, pieces=SOFT_PIECES)),
    "chunk_profile": (
        lambda s, d: C.chunk_profile(C.chunk(_docs(s, d, True))),
        sql("""SELECT count(*) AS n_chunks, count(DISTINCT company_id) AS n_companies,
                      CAST(sum(length(chunk_text)) AS BIGINT) AS total_chars FROM chunked""", src=DOCS_B),
    ),
    "hash_embedding": (hash_vectors, sql(HASH_RESULT, **HASH_SQL)),
    "batch_embedding": (batch_vectors, sql(BATCH_SQL)),
    "resumed_embedding": (resumed_vectors, sql(BATCH_SQL)),
    "embedding_profile": (
        embedding_profile,
        sql("""SELECT count(*) AS n_rows, count(DISTINCT chunk_id) AS n_chunks,
                      CAST(max(len(embedding)) AS INT) AS embedding_dim FROM doc_vectors"""),
    ),
    "query_understanding": (query_understanding, sql(UNDERSTAND_SQL)),
    "query_understanding_plain": (
        query_plain,
        sql(f"SELECT query_id, normalized, {LANGUAGE} AS language, {QTYPE} AS query_type,"
            " normalized AS rewrites FROM normed", **PLAIN_SQL),
    ),
    "loose_json_object": (loose_json, sql(LOOSE_SQL)),
    "response_vectors": (response_vectors, sql(VECTOR_SQL)),
    "tolerant_values": (tolerant_values, with_views(VALUES_SQL)),
}
