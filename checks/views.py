"""The given tables seen as the tables of the contract.

One SQL text per view, valid in both engines: Spark gets the tables as frames, the
comparison engine by name.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.session import spread_small

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
# The given files hold one row group each, which one task has to read.
SPREAD_BY = {
    "orders": "o_orderkey", "lineitem": "l_orderkey", "documents": "doc_id", "pages": "page_id",
    "conversations": "conv_id",
}

VIEWS: dict[str, str] = {
    "market_trends": """
        SELECT CAST(c_custkey AS STRING) AS company_id, CAST(o_orderkey AS STRING) AS deal_id,
               c_name AS company_name,
               CASE WHEN c_acctbal >= 0 THEN 'https://' || lower(c_name) || '.example.com' END AS website,
               c_mktsegment = 'BUILDING' AS built_world, CAST(NULL AS BOOLEAN) AS climate_tech,
               c_mktsegment AS theme, n_name AS main_category, o_orderpriority AS subcategory,
               CAST(NULL AS STRING) AS house_impact_framework, CAST(NULL AS STRING) AS area,
               CAST(o_orderkey AS INT) AS deal_no, CAST(o_orderdate AS DATE) AS deal_date,
               CAST(year(o_orderdate) AS INT) AS deal_year, o_totalprice / 2 AS invested_equity,
               o_totalprice AS deal_size, CAST(NULL AS DOUBLE) AS total_new_debt,
               CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS raised_to_date,
               o_orderstatus AS house_funding_round, o_orderpriority AS deal_type,
               CAST(NULL AS STRING) AS deal_type_2, CAST(1990 + c_nationkey AS INT) AS year_founded,
               n_name AS country, CAST(NULL AS STRING) AS city, r_name AS region,
               CAST(NULL AS BOOLEAN) AS bay_area, CAST(1 AS INT) AS dealcount,
               o_orderdate AS last_updated,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN true
                    WHEN o_orderstatus = 'P' THEN NULL ELSE false END AS _fivetran_deleted,
               o_orderdate AS _fivetran_synced
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
             JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "companies": "SELECT CAST(doc_id AS STRING) AS company_id, text AS description FROM {documents}",
    "parsed_text": """
        SELECT CAST(page_id AS STRING) AS id, html AS website_parsed_text, url AS website_summary
        FROM {pages}""",
    "company_verticals": """
        SELECT DISTINCT CAST(o_custkey AS STRING) AS company_id, ' ' || p_type || ' ' AS verticals,
               CASE p_type WHEN 'SMALL' THEN true WHEN 'PROMO' THEN NULL ELSE false END
                   AS _fivetran_deleted
        FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey JOIN {part} ON p_partkey = l_partkey""",
    "company_keywords": """
        SELECT DISTINCT CAST(o_custkey AS STRING) AS company_id, p_brand AS keywords,
               CASE p_brand WHEN 'Brand#5' THEN true WHEN 'Brand#4' THEN NULL
                    ELSE false END AS _fivetran_deleted
        FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey JOIN {part} ON p_partkey = l_partkey""",
    "deals_investors": """
        SELECT CAST(l_orderkey AS STRING) AS deal_id,
               s_name || CASE l_returnflag WHEN 'R' THEN ' Fund' ELSE '' END
                   || ' (' || l_linestatus || ')' AS investors,
               CASE WHEN l_discount < 0.005 THEN true WHEN l_discount > 0.095 THEN NULL
                    ELSE false END AS _fivetran_deleted
        FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey""",
    "investors": """
        SELECT s_name AS investor_name,
               CAST(CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 3000 THEN 1
                         WHEN s_acctbal < 6000 THEN 2 ELSE 3 END AS INT) AS house_ranking
        FROM {supplier}""",
    "taxonomy": """
        SELECT CAST(c_custkey AS STRING) AS company_id, c_mktsegment AS theme,
               n_name AS main_category,
               CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1000 THEN '' ELSE r_name END
                   AS subcategory,
               CAST(NULL AS STRING) AS house_impact_framework
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
             JOIN {region} ON n_regionkey = r_regionkey""",
    # One chunk per document, with a vector where one of the same number exists.
    "doc_chunks": """
        SELECT 'd' || CAST(doc_id AS STRING) AS chunk_id, CAST(doc_id AS STRING) AS company_id,
               CAST(0 AS INT) AS chunk_index, text AS chunk_text
        FROM {documents}""",
    "doc_vectors": """
        SELECT 'd' || CAST(vec_id AS STRING) AS chunk_id, CAST(vec_id AS STRING) AS company_id,
               CAST(0 AS INT) AS chunk_index, embedding, 'given' AS embedding_endpoint,
               CAST(NULL AS TIMESTAMP) AS embedded_at
        FROM {embeddings}""",
    # The corpus for text search: parents are sources, places in the parent follow the length.
    "corpus": """
        SELECT 'd' || CAST(doc_id AS STRING) AS chunk_id, source AS company_id, source, lang,
               CAST(n_chars / 100 AS INT) AS chunk_index, text AS chunk_text
        FROM {documents}""",
    "text_queries": """
        SELECT CAST(item_id AS STRING) AS query_id, text AS query_text FROM {benchmark}""",
    # Logged hits: a query per supplier, a hit per line; ids and scores repeat.
    "logged_hits": """
        SELECT CAST(l_suppkey AS STRING) AS query_id, l_linenumber AS rewrite_no,
               (l_orderkey * 10000000 + l_partkey) * 100 + CAST(l_quantity AS BIGINT) AS hit_no,
               CASE WHEN l_returnflag = 'A' AND l_discount > 0.095 THEN NULL
                    ELSE CAST(l_partkey AS STRING) END AS chunk_id,
               CAST(NULL AS DOUBLE) AS score,
               CASE WHEN l_tax > 0.075 THEN NULL ELSE l_quantity END AS similarity,
               CASE WHEN p_brand = 'Brand#7' THEN '' ELSE p_brand END AS parent,
               CASE WHEN p_size > 45 THEN NULL ELSE CAST(p_size AS INT) END AS chunk_index,
               p_name || ' ' || p_type AS chunk_text
        FROM {lineitem} JOIN {part} ON p_partkey = l_partkey""",
    "user_turns": """
        SELECT CAST(conv_id AS STRING) || ':' || CAST(turn AS STRING) AS query_id,
               conv_id, turn, text AS query_text
        FROM {conversations} WHERE role = 'user'""",
}

_OPEN: dict[tuple[str, str, str], DataFrame] = {}  # lazy frames; saves reading footers again


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _OPEN:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        _OPEN[key] = spread_small(df, SPREAD_BY[name]) if name in SPREAD_BY else df
    return _OPEN[key]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    used = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in used})


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    names = (
        "market_trends", "companies", "parsed_text", "company_verticals", "company_keywords",
        "deals_investors", "investors", "taxonomy",
    )
    return {n: view(spark, sf_dir, n) for n in names}


def with_views(sql: str, **ctes: str) -> str:
    """``sql`` preceded by the views and extra CTEs that it mentions, directly or not."""
    bodies = {**{n: re.sub(r"\{(\w+)\}", r"\1", v) for n, v in VIEWS.items()}, **ctes}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in bodies:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(bodies[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    head = ",\n".join(f"{n} AS ({bodies[n]})" for n in order)
    return f"WITH {head}\n{sql}" if head else sql
