"""Queries of discovery and page ranges (group C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.fixtures import report_pages, table
from gridloom.operators import discovery as dc
from gridloom.operators import index as ix
from gridloom.plans.index import TOC_RE, WITH_TITLES, titles

SUPPORTED = ["africa", "america", "asia", "europe"]
BASE = WITH_TITLES + rf""", counts AS (SELECT report_id, max(page_count) AS page_count FROM fx_pages GROUP BY 1),
ln AS (SELECT report_id, pdf_page, string_split(page_text, chr(10)) AS ls FROM fx_pages WHERE pdf_page <= 15),
li AS (SELECT report_id, pdf_page, CAST(i - 1 AS INT) AS line_no, ls[i] AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM ln)),
toc AS (SELECT report_id, pdf_page, line_no, lower(regexp_extract(line, '{TOC_RE}', 1)) AS table_number, trim(regexp_extract(line, '{TOC_RE}', 2)) AS title_text,
  CAST(regexp_extract(line, '{TOC_RE}', 3) AS INT) AS printed_page FROM li WHERE regexp_matches(line, '{TOC_RE}')),
aliases AS (SELECT lower(r_name) AS alias, lower(r_name) AS parameter_id, r_regionkey AS priority FROM region),
toc_m AS (SELECT * EXCLUDE (k) FROM (SELECT t.*, a.parameter_id, row_number() OVER (PARTITION BY report_id, table_number ORDER BY priority) AS k FROM toc t
  JOIN aliases a ON contains(lower(t.title_text), a.alias)) WHERE k = 1),
idx_m AS (SELECT * EXCLUDE (k) FROM (SELECT t.*, a.parameter_id, row_number() OVER (PARTITION BY report_id, table_number ORDER BY priority) AS k FROM titles t
  JOIN aliases a ON contains(lower(t.title_text), a.alias)) WHERE k = 1),
offs AS (SELECT report_id, 1 AS "offset" FROM counts),
chain AS (SELECT t.report_id, table_number, title_text, lead(title_text) OVER w AS next_title, pdf_page AS start_page,
  CASE WHEN lead(pdf_page) OVER w IS NULL THEN greatest(pdf_page, page_count) ELSE greatest(pdf_page, lead(pdf_page) OVER w - 1) END AS end_page,
  CASE WHEN lead(pdf_page) OVER w IS NULL THEN 'end_of_document' ELSE 'next_anchor' END AS boundary_rule
  FROM titles t JOIN counts USING (report_id) WINDOW w AS (PARTITION BY t.report_id ORDER BY pdf_page, match_no)),
cat AS (SELECT report_id, parameter_id, coalesce(i.table_number, t.table_number) AS table_number, coalesce(i.title_text, t.title_text) AS title_text,
  coalesce(i.pdf_page, t.printed_page + 1) AS anchor_page, CASE WHEN i.pdf_page IS NOT NULL AND t.printed_page IS NOT NULL THEN 'merged'
    WHEN t.printed_page IS NOT NULL THEN 'toc' ELSE 'index' END AS discovery_source
  FROM (SELECT * FROM toc_m WHERE parameter_id <> 'asia') t FULL JOIN (SELECT * FROM idx_m WHERE parameter_id <> 'africa') i USING (report_id, parameter_id))"""


def page_counts(spark, sf):
    return report_pages(spark, sf).groupBy("report_id").agg(F.max("page_count").alias("page_count"))


def toc(spark, sf):
    return dc.extract_toc(report_pages(spark, sf))


def aliases(spark, sf):
    name = F.lower("r_name")
    return table(spark, sf, "region").select(name.alias("alias"), name.alias("parameter_id"), F.col("r_regionkey").alias("priority"))


def offsets(spark, sf):
    return page_counts(spark, sf).select("report_id", F.lit(1).alias("offset"))


def catalog(spark, sf):
    t = dc.match_alias(toc(spark, sf), aliases(spark, sf)).where("parameter_id <> 'asia'")
    i = dc.match_alias(titles(spark, sf), aliases(spark, sf)).where("parameter_id <> 'africa'")
    return dc.merge_catalog(t, i, offsets(spark, sf))


def ranges(spark, sf):
    return dc.page_range_anchor_chain(titles(spark, sf), page_counts(spark, sf))


def hits(spark, sf):
    """Real pages of the contents' titles beside their printed pages."""
    pages = ix.drop_toc_pages(report_pages(spark, sf))
    entries = toc(spark, sf).select("report_id", "line_no", "printed_page", "title_text")
    hit = pages.join(entries, "report_id").where(F.contains("page_text", "title_text"))
    return hit.groupBy("report_id", F.col("line_no").alias("seq"), "printed_page").agg(F.min("pdf_page").alias("pdf_page"))


def c4_first_phrase_page(spark, sf):
    phrases = table(spark, sf, "nation").select(F.lower("n_name").alias("phrase"))
    more = table(spark, sf, "region").select(F.concat("r_name", F.lit(" charge")).alias("phrase"))
    return dc.first_phrase_page(ix.drop_toc_pages(report_pages(spark, sf)), phrases.union(more))


def overrides(spark, sf):
    text = F.when(F.col("table_number") == "1", "12-14").when(F.col("table_number") == "2", " 7 ").when(F.col("table_number") == "4", "14-12")
    return titles(spark, sf).select("report_id", "table_number", text.alias("override")).where("override IS NOT NULL")


def c11_route_query(spark, sf):
    queries = table(spark, sf, "nation").join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
    queries = queries.select(F.col("n_nationkey").alias("query_id"), F.concat(F.lit("charges in "), F.lower("r_name"), F.lit(" for "), "n_name").alias("query"))
    words = table(spark, sf, "region").select(F.col("r_name").alias("keyword"), F.col("r_regionkey").alias("priority"))
    return dc.route_query(queries, words, ranges(spark, sf))


def c14_select_parameters(spark, sf):
    n = F.length("report_id") % 2
    asked = page_counts(spark, sf).select("report_id", F.when(n == 0, "asia, Europe").when(F.col("report_id").endswith("1"), "all").when(F.col("report_id").endswith("2"), "nothing").otherwise("africa").alias("request"))
    return dc.select_parameters(catalog(spark, sf), asked)


QUERIES = {
    "c1_extract_toc": toc,
    "c2_match_alias": lambda s, d: dc.match_alias(titles(s, d), aliases(s, d), SUPPORTED),
    "c3_merge_catalog": catalog,
    "c4_first_phrase_page": c4_first_phrase_page,
    "c5_calibrate_offset": lambda s, d: dc.calibrate_offset(hits(s, d)),
    "c6_page_range_anchor_chain": ranges,
    "c7_page_range_toc_next": lambda s, d: dc.page_range_toc_next(toc(s, d), offsets(s, d), page_counts(s, d)),
    "c8_page_range_next_anchor": lambda s, d: dc.page_range_next_anchor(titles(s, d), page_counts(s, d)),
    "c9_page_preview": lambda s, d: dc.page_preview(report_pages(s, d), ranges(s, d), 2),
    "c10_catalog_rollup": lambda s, d: dc.catalog_rollup(catalog(s, d), SUPPORTED),
    "c11_route_query": c11_route_query,
    "c12_apply_range_overrides": lambda s, d: dc.apply_range_overrides(ranges(s, d), overrides(s, d)),
    "c13_toc_ranges": lambda s, d: dc.toc_ranges(toc(s, d)),
    "c14_select_parameters": c14_select_parameters,
}

ORACLE_SQL = {
    "c1_extract_toc": f"{BASE} SELECT * FROM toc",
    "c2_match_alias": f"{BASE} SELECT * FROM idx_m WHERE parameter_id IN ('africa', 'america', 'asia', 'europe')",
    "c3_merge_catalog": f"{BASE} SELECT * FROM cat",
    "c4_first_phrase_page": f"""{BASE}, ph AS (SELECT lower(n_name) AS phrase FROM nation UNION ALL SELECT concat(r_name, ' charge') FROM region)
      SELECT r.report_id, ph.phrase, min(k.pdf_page) AS pdf_page, min(k.pdf_page) IS NULL AS missing FROM (SELECT DISTINCT report_id FROM kept) r CROSS JOIN ph
      LEFT JOIN kept k ON k.report_id = r.report_id AND contains(lower(k.page_text), lower(ph.phrase)) GROUP BY 1, 2""",
    "c5_calibrate_offset": f"""{BASE}, h AS (SELECT k.report_id, line_no, printed_page, min(k.pdf_page) - printed_page AS delta FROM kept k JOIN toc t ON k.report_id = t.report_id AND contains(k.page_text,
      t.title_text) GROUP BY 1, 2, 3),
      n AS (SELECT report_id, delta, count(*) AS n, min(line_no) AS seen FROM h GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY n DESC,
        seen) AS k FROM n)
      SELECT report_id, delta AS "offset", 'phrase_search' AS method FROM b WHERE k = 1""",
    "c6_page_range_anchor_chain": f"{BASE} SELECT * FROM chain",
    "c7_page_range_toc_next": f"""{BASE}, p AS (SELECT t.*, page_count, greatest(1, least(printed_page + 1, page_count)) AS start_page FROM toc t JOIN counts USING (report_id)),
      n AS (SELECT *, lead(start_page) OVER (PARTITION BY report_id ORDER BY pdf_page, line_no) AS nx FROM p)
      SELECT report_id, table_number, title_text, start_page, CASE WHEN nx IS NULL THEN page_count ELSE greatest(start_page, nx - 1) END AS end_page FROM n""",
    "c8_page_range_next_anchor": f"""{BASE}, n AS (SELECT a.report_id, a.table_number, a.pdf_page, min(b.pdf_page) AS nx FROM titles a LEFT JOIN titles b ON a.report_id = b.report_id AND b.pdf_page > a.pdf_page
      AND b.table_number <> a.table_number GROUP BY ALL)
      SELECT report_id, table_number, pdf_page AS start_page, CASE WHEN nx IS NULL THEN page_count ELSE greatest(pdf_page, nx - 1) END AS end_page FROM n
        JOIN counts USING (report_id)""",
    "c9_page_preview": f"{BASE} SELECT p.report_id, table_number, pdf_page, array_to_string(string_split(page_text, chr(10))[1:2], chr(10)) AS preview FROM fx_pages p JOIN chain c ON p.report_id = c.report_id AND pdf_page BETWEEN start_page AND end_page",
    "c10_catalog_rollup": f"""{BASE} SELECT report_id, count(*) AS parameter_count, count(*) FILTER (parameter_id IN ('africa', 'america', 'asia', 'europe')) AS supported_count,
      string_agg(DISTINCT discovery_source, ',' ORDER BY discovery_source) AS sources, string_agg(parameter_id, ',' ORDER BY anchor_page, parameter_id) AS parameters
        FROM cat GROUP BY report_id""",
    "c11_route_query": f"""{BASE}, q AS (SELECT n_nationkey AS query_id, r_name AS keyword FROM (SELECT n_nationkey, k.r_name, row_number() OVER (PARTITION BY n_nationkey ORDER BY k.r_regionkey) AS p
      FROM nation JOIN region r ON n_regionkey = r.r_regionkey JOIN region k ON contains(lower(concat('charges in ', lower(r.r_name), ' for ', n_name)), lower(k.r_name)))
        WHERE p = 1),
      h AS (SELECT query_id, keyword, report_id, title_text, start_page, end_page, row_number() OVER (PARTITION BY query_id, report_id ORDER BY start_page, table_number) AS p
        FROM chain JOIN q ON contains(lower(title_text), lower(keyword)))
      SELECT * EXCLUDE (p) FROM h WHERE p = 1""",
    "c12_apply_range_overrides": f"""{BASE} SELECT report_id, table_number, CASE table_number WHEN '1' THEN 12 WHEN '2' THEN 7 ELSE start_page END AS start_page,
      CASE table_number WHEN '1' THEN 14 WHEN '2' THEN 7 ELSE end_page END AS end_page, CASE WHEN table_number IN ('1', '2') THEN 'user' ELSE 'suggested' END AS source
        FROM chain""",
    "c13_toc_ranges": f"{BASE} SELECT report_id, table_number, printed_page AS start_page, lead(printed_page) OVER (PARTITION BY report_id ORDER BY printed_page, line_no) - 1 AS end_page FROM toc",
    "c14_select_parameters": f"""{BASE}, a AS (SELECT report_id, CASE WHEN length(report_id) % 2 = 0 THEN ['asia', 'europe'] WHEN report_id LIKE '%1' OR report_id LIKE '%2' THEN [] ELSE ['africa'] END AS w
      FROM counts)
      SELECT report_id, parameter_id FROM (SELECT c.report_id, parameter_id, list_contains(w, parameter_id) AS named, bool_or(list_contains(w,
        parameter_id)) OVER (PARTITION BY c.report_id) AS anyone FROM cat c JOIN a USING (report_id)) WHERE named OR NOT anyone""",
}
