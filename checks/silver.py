"""Sources, silver and gold tables, quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import gold as G
from ledgerlens.operators import investors as I
from ledgerlens.operators import quality as Q
from ledgerlens.operators import semantic_text as S
from ledgerlens.session import new_folder
from ledgerlens.sources import replica as R

from .views import sources, table, view, with_views

CTES = {
    "ranked": """
        SELECT d.deal_id, i.investor_name, i.house_ranking
        FROM deals_investors d JOIN investors i
          ON trim(split_part(d.investors, '(', 1)) = i.investor_name
        WHERE d._fivetran_deleted = false""",
    "all_inv": """
        SELECT mt.company_id, string_agg(DISTINCT i.investor_name, ', ' ORDER BY i.investor_name)
               AS all_investors
        FROM market_trends mt LEFT JOIN deals_investors di ON mt.deal_id = di.deal_id
             LEFT JOIN investors i ON trim(split_part(di.investors, '(', 1)) = i.investor_name
        WHERE mt.company_id IS NOT NULL GROUP BY mt.company_id""",
    "deal_co": """
        SELECT deal_id, max(company_id) AS company_id FROM market_trends
        WHERE deal_id IS NOT NULL AND company_id IS NOT NULL GROUP BY deal_id""",
    "geo": """
        SELECT company_id, coalesce(string_agg(DISTINCT place, '; ' ORDER BY place), '') AS geography
        FROM (SELECT company_id, nullif(trim(concat_ws(', ', country, region)), '') AS place
              FROM market_trends WHERE company_id IS NOT NULL) GROUP BY company_id""",
    "tiers": """
        SELECT c.company_id,
          coalesce(string_agg(DISTINCT trim(investor_name), ', ' ORDER BY trim(investor_name))
                   FILTER (house_ranking = 1), '') AS investor_list_high,
          coalesce(string_agg(DISTINCT trim(investor_name), ', ' ORDER BY trim(investor_name))
                   FILTER (house_ranking = 2), '') AS investor_list_medium,
          coalesce(string_agg(DISTINCT trim(investor_name), ', ' ORDER BY trim(investor_name))
                   FILTER (house_ranking = 3), '') AS investor_list_low,
          coalesce(string_agg(DISTINCT trim(investor_name), ', ' ORDER BY trim(investor_name))
                   FILTER (house_ranking IS NULL), '') AS investor_list_untracked
        FROM ranked r JOIN deal_co c ON r.deal_id = c.deal_id GROUP BY c.company_id""",
    "vertical_list": """
        SELECT company_id, string_agg(DISTINCT trim(verticals), ', ' ORDER BY trim(verticals)) AS verticals
        FROM company_verticals WHERE trim(verticals) <> '' GROUP BY company_id""",
    "keyword_list": """
        SELECT company_id, string_agg(DISTINCT trim(keywords), ', ' ORDER BY trim(keywords)) AS keywords
        FROM company_keywords WHERE trim(keywords) <> '' GROUP BY company_id""",
    "vertical_set": """
        SELECT company_id, list_sort(list(DISTINCT trim(verticals))) AS verticals_array
        FROM company_verticals
        WHERE coalesce(_fivetran_deleted, false) = false AND trim(verticals) <> '' GROUP BY company_id""",
    "keyword_set": """
        SELECT company_id, list_sort(list(DISTINCT trim(keywords))) AS keywords_array
        FROM company_keywords
        WHERE coalesce(_fivetran_deleted, false) = false AND trim(keywords) <> '' GROUP BY company_id""",
    "inv_summary": """
        SELECT deal_id, string_agg(DISTINCT trim(investor_name), ' | ' ORDER BY trim(investor_name))
                 AS investor_names,
               min(house_ranking) AS best_investor_rank, count(DISTINCT investor_name) AS investor_count
        FROM ranked WHERE trim(investor_name) <> '' GROUP BY deal_id""",
}


def text_cte(verticals: str, keywords: str) -> str:
    def part(label: str, col: str) -> str:
        return (
            f"CASE WHEN coalesce(trim({col}), '') <> '' THEN concat('{label}', trim({col})) END"
        )

    parts = ",\n".join(
        part(label, col)
        for label, col in (
            ("Description: ", "co.description"), ("Website content: ", "w.website_parsed_text"),
            ("Website summary: ", "w.website_summary"), ("Verticals: ", "v.verticals"),
            ("Keywords: ", "k.keywords"), ("Investors: ", "inv.all_investors"),
            ("High-quality investors: ", "ir.investor_list_high"),
            ("Medium-quality investors: ", "ir.investor_list_medium"),
            ("Low-quality investors: ", "ir.investor_list_low"),
            ("Untracked investors: ", "ir.investor_list_untracked"),
            ("house Taxonomy — theme: ", "n.theme"),
            ("house Taxonomy — main category: ", "n.main_category"),
            ("house Taxonomy — subcategory: ", "n.subcategory"),
            ("house Taxonomy — HOUSE impact framework: ", "n.house_impact_framework"),
            ("Geography: ", "g.geography"),
        )
    )
    return f"""
        SELECT c.company_id, trim(concat_ws(chr(10) || chr(10), {parts})) AS semantic_text
        FROM (SELECT DISTINCT company_id FROM market_trends WHERE company_id IS NOT NULL) c
        LEFT JOIN companies co ON c.company_id = co.company_id
        LEFT JOIN parsed_text w ON c.company_id = w.id
        LEFT JOIN {verticals} v ON c.company_id = v.company_id
        LEFT JOIN {keywords} k ON c.company_id = k.company_id
        LEFT JOIN all_inv inv ON c.company_id = inv.company_id
        LEFT JOIN tiers ir ON c.company_id = ir.company_id
        LEFT JOIN taxonomy n ON c.company_id = n.company_id
        LEFT JOIN geo g ON c.company_id = g.company_id"""


CTES["sem_text"] = text_cte("vertical_list", "keyword_list")
CTES["sem_text_raw"] = text_cte("company_verticals", "company_keywords")

TITLE = "coalesce(m.company_name, m.website, m.theme, m.subcategory, 'Unknown Company')"
SEARCHED = "concat_ws(' ', " + ", ".join(
    f"coalesce({c}, '')"
    for c in (
        "m.company_name", "m.theme", "m.main_category", "m.subcategory", "m.house_impact_framework",
        "m.area", "m.country", "m.city", "m.region", "m.house_funding_round", "m.deal_type",
        "m.deal_type_2", "array_to_string(v.verticals_array, ' ')",
        "array_to_string(k.keywords_array, ' ')", "c.chunk_text",
    )
) + ")"


def gold_sql(trends: str, condition: str) -> str:
    return f"""
        SELECT c.chunk_id, c.company_id, m.deal_id, m.deal_date, m.deal_size, m._fivetran_deleted,
               coalesce(len(e.embedding), -1) AS dim, e.embedding_endpoint,
               array_to_string(v.verticals_array, '/') AS verticals,
               array_to_string(k.keywords_array, '/') AS keywords,
               i.investor_names, i.best_investor_rank, i.investor_count,
               {TITLE} AS display_title, md5({SEARCHED}) AS search_md5
        FROM doc_chunks c
        LEFT JOIN doc_vectors e ON c.chunk_id = e.chunk_id AND c.company_id = e.company_id
             AND c.chunk_index = e.chunk_index
        LEFT JOIN {trends} m ON c.company_id = m.company_id
        LEFT JOIN vertical_set v ON c.company_id = v.company_id
        LEFT JOIN keyword_set k ON c.company_id = k.company_id
        LEFT JOIN inv_summary i ON m.deal_id = i.deal_id
        WHERE {condition}"""


CTES["latest_deal"] = """
    SELECT * FROM market_trends WHERE coalesce(_fivetran_deleted, false) = false
    QUALIFY row_number() OVER (PARTITION BY company_id
                               ORDER BY deal_date DESC NULLS LAST, deal_id DESC NULLS LAST) = 1"""


def sql(text: str) -> str:
    return with_views(text, **CTES)


def _ranked(spark, d):
    return I.ranked_investors(view(spark, d, "deals_investors"), view(spark, d, "investors"))


def live(null_is_live: bool):
    def run(spark, d):
        rows = R.live_rows(view(spark, d, "deals_investors"), null_is_live)
        return rows.groupBy("investors").agg(F.count(F.lit(1)).alias("n_rows"))

    return run


def live_sql(condition: str) -> str:
    return sql(
        f"SELECT investors, count(*) AS n_rows FROM deals_investors WHERE {condition} GROUP BY investors"
    )


def all_investors(spark, d):
    return I.all_investors(
        view(spark, d, "market_trends"), view(spark, d, "deals_investors"), view(spark, d, "investors")
    )


def semantic_text(fanout: str):
    def run(spark, d):
        text = S.semantic_text(sources(spark, d), fanout=fanout)
        return text.select(
            "company_id", F.length("semantic_text").alias("n_chars"), F.md5("semantic_text").alias("text_md5")
        )

    return run


def semantic_sql(cte: str) -> str:
    return sql(
        f"SELECT company_id, length(semantic_text) AS n_chars, md5(semantic_text) AS text_md5 FROM {cte}"
    )


def gold(deals: str):
    def run(spark, d):
        wide = G.gold_chunks(
            view(spark, d, "doc_chunks"), view(spark, d, "doc_vectors"), view(spark, d, "market_trends"),
            view(spark, d, "company_verticals"), view(spark, d, "company_keywords"),
            _ranked(spark, d), deals=deals,
        )
        return wide.select(
            "chunk_id", "company_id", "deal_id", "deal_date", "deal_size", "_fivetran_deleted",
            F.when(F.col("embedding").isNull(), -1).otherwise(F.size("embedding")).alias("dim"),
            "embedding_endpoint",
            F.array_join("verticals_array", "/").alias("verticals"),
            F.array_join("keywords_array", "/").alias("keywords"),
            "investor_names", "best_investor_rank", "investor_count", "display_title",
            F.md5("search_text").alias("search_md5"),
        )

    return run


def investor_summary(spark, d):
    return I.investor_summary(_ranked(spark, d)).select(
        "deal_id", "investor_names", "best_investor_rank", "investor_count",
        F.size("investor_names_array").alias("n_names"),
    )


def labels(name: str, value: str):
    def run(spark, d):
        return G.label_summary(view(spark, d, name), value).select(
            "company_id", f"{value}_text", F.array_join(f"{value}_array", "/").alias("listed")
        )

    return run


def key_counts(spark, d):
    src = sources(spark, d)
    check = Q.key_count_check(
        src["market_trends"], S.semantic_text(src), "company_id", "semantic_text_company_count"
    )
    return check.drop("checked_at")


def quality_rows(spark, d):
    chunks, vectors = view(spark, d, "doc_chunks"), view(spark, d, "doc_vectors")
    trends = view(spark, d, "market_trends")
    out = Q.repeated_keys(chunks, "chunk_id", "chunk_key")
    for more in (
        Q.repeated_keys(trends, "company_id", "one_deal_per_company"),
        Q.wrong_vector_size(vectors, 64, "vector_size"),
        Q.orphan_keys(trends, view(spark, d, "companies"), "company_id", "company_without_profile"),
        Q.orphan_keys(chunks, vectors, "chunk_id", "chunk_without_vector"),
    ):
        out = out.unionByName(more)
    return out


QUALITY_SQL = """
    SELECT 'chunk_key' AS check_name, count(*) AS violations
    FROM (SELECT chunk_id FROM doc_chunks GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'one_deal_per_company', count(*)
    FROM (SELECT company_id FROM market_trends GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'vector_size', count(*) FROM doc_vectors WHERE embedding IS NULL OR len(embedding) <> 64
    UNION ALL SELECT 'company_without_profile', count(*) FROM (SELECT DISTINCT company_id FROM market_trends
      WHERE company_id NOT IN (SELECT company_id FROM companies))
    UNION ALL SELECT 'chunk_without_vector', count(*) FROM (SELECT DISTINCT chunk_id FROM doc_chunks
      WHERE chunk_id NOT IN (SELECT chunk_id FROM doc_vectors))"""


def latest_changes(spark, d):
    changes = view(spark, d, "market_trends").select(
        "company_id", "deal_id", "deal_size", "_fivetran_deleted", "_fivetran_synced"
    )
    return R.latest_changes(changes, ["company_id"], tiebreak=["deal_id"]).select(
        "company_id", "deal_id", "deal_size", "_fivetran_deleted"
    )


LATEST_SQL = """
    SELECT company_id, deal_id, deal_size, _fivetran_deleted FROM market_trends
    QUALIFY row_number() OVER (PARTITION BY company_id
      ORDER BY _fivetran_synced DESC NULLS LAST, deal_id DESC NULLS LAST) = 1"""


def upsert(spark, d):
    """Company profiles updated by the newest deal of each company."""
    target = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("company_id"), F.col("c_acctbal").alias("amount")
    )
    changes = latest_changes(spark, d).select(
        "company_id", F.col("deal_size").alias("amount"), "_fivetran_deleted"
    )
    return R.upsert_by_key(target, changes, ["company_id"])


def upsert_in_place(spark, d):
    """The same changes to a table kept by key, of which only the touched buckets are written anew."""
    path = new_folder(spark, "keyed")
    target = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("company_id"), F.col("c_acctbal").alias("amount")
    )
    R.write_keyed(target, path, ["company_id"], buckets=8)
    changes = latest_changes(spark, d).select("company_id", F.col("deal_size").alias("amount"), "_fivetran_deleted")
    R.upsert_keyed(spark, path, changes, ["company_id"])
    return R.read_keyed(spark, path)


UPSERT_SQL = f"""
    SELECT CAST(c_custkey AS STRING) AS company_id, c_acctbal AS amount FROM customer
    WHERE CAST(c_custkey AS STRING) NOT IN (SELECT company_id FROM market_trends)
    UNION ALL
    SELECT company_id, deal_size FROM ({LATEST_SQL}) WHERE coalesce(_fivetran_deleted, false) = false"""


QUERIES = {
    "live_rows_strict": (live(False), live_sql("_fivetran_deleted = false")),
    "live_rows_null_tolerant": (live(True), live_sql("coalesce(_fivetran_deleted, false) = false")),
    "ranked_investors": (_ranked, sql("SELECT * FROM ranked")),
    "all_investors": (all_investors, sql("SELECT * FROM all_inv")),
    "deal_company": (
        lambda s, d: S.deal_company(view(s, d, "market_trends")), sql("SELECT * FROM deal_co"),
    ),
    "company_geography": (
        lambda s, d: S.company_geography(view(s, d, "market_trends")), sql("SELECT * FROM geo"),
    ),
    "tiered_investors": (
        lambda s, d: S.tiered_investors(_ranked(s, d), view(s, d, "market_trends")),
        sql("SELECT * FROM tiers"),
    ),
    "semantic_text": (semantic_text("collapse"), semantic_sql("sem_text")),
    "semantic_text_raw": (semantic_text("keep"), semantic_sql("sem_text_raw")),
    "investor_summary": (
        investor_summary,
        sql("SELECT *, len(string_split(investor_names, ' | ')) AS n_names FROM inv_summary"),
    ),
    "verticals_summary": (
        labels("company_verticals", "verticals"),
        sql("""SELECT company_id, array_to_string(verticals_array, ' ') AS verticals_text,
                      array_to_string(verticals_array, '/') AS listed FROM vertical_set"""),
    ),
    "keywords_summary": (
        labels("company_keywords", "keywords"),
        sql("""SELECT company_id, array_to_string(keywords_array, ' ') AS keywords_text,
                      array_to_string(keywords_array, '/') AS listed FROM keyword_set"""),
    ),
    "gold_chunks_all_deals": (
        gold("all"), sql(gold_sql("market_trends", "coalesce(m._fivetran_deleted, false) = false")),
    ),
    "gold_chunks_latest_deal": (
        gold("latest"),
        sql(gold_sql(
            "latest_deal",
            "m.company_id IS NOT NULL OR c.company_id NOT IN (SELECT company_id FROM market_trends)",
        )),
    ),
    "key_count_check": (
        key_counts,
        sql("""SELECT 'semantic_text_company_count' AS check_name, a.n = b.n AS counts_match,
                      a.n AS source_distinct, b.n AS derived_distinct
               FROM (SELECT count(DISTINCT company_id) AS n FROM market_trends) a
               CROSS JOIN (SELECT count(DISTINCT company_id) AS n FROM sem_text) b"""),
    ),
    "quality_checks": (quality_rows, sql(QUALITY_SQL)),
    "latest_changes": (latest_changes, sql(LATEST_SQL)),
    "upsert_by_key": (upsert, sql(UPSERT_SQL)),
    "upsert_keyed": (upsert_in_place, sql(UPSERT_SQL)),
}
