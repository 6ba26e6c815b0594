"""Queries of sources and page indexing (groups A and B)."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from gridloom.fixtures import WITH_GRID, WITH_PAGES, grid_rows, report_pages, table
from gridloom.operators import index as ix
from gridloom.sources.scratch import new_path

# fixed values: heading and contents-line patterns
TITLE_RE = r"(?i)TABLE[- ]?\d+(?:\([A-Z]\))?\s*:\s*([^\n]+)"
TOC_RE = r"(?i)TABLE[- ]?(\d+(?:\([A-Z]\))?)\s*:\s*(.*?)\s+(\d+)"
#: Pages without contents pages, and their headings, as further table expressions.
WITH_TITLES = WITH_PAGES + rf""", kept AS (
  SELECT * FROM fx_pages WHERE len(list_filter(string_split(page_text, chr(10)), lambda l: regexp_matches(l, '{TOC_RE}'))) <= 2),
found AS (
  SELECT report_id, pdf_page, regexp_extract_all(page_text, '{TITLE_RE}', 0) AS raws, regexp_extract_all(page_text, '{TITLE_RE}', 1) AS ts FROM kept),
titles AS (
  SELECT report_id, pdf_page, CAST(i - 1 AS INT) AS match_no, lower(regexp_extract(raws[i], '\d+(?:\([a-zA-Z]\))?')) AS table_number,
    trim(ts[i]) AS title_text,
    trim(replace(raws[i], regexp_extract(raws[i], '\d+(?:\([a-zA-Z]\))?'), lower(regexp_extract(raws[i], '\d+(?:\([a-zA-Z]\))?')))) AS raw_text
  FROM (SELECT *, unnest(range(1, len(raws) + 1)) AS i FROM found))"""
WITH_INDEX = WITH_TITLES + """, idx AS (
  SELECT p.report_id, p.pdf_page, length(p.page_text) AS text_length, coalesce(n.k, 0) AS table_count, coalesce(n.k, 0) > 0 AS contains_table,
    coalesce(t.names, '') AS titles
  FROM fx_pages p
  LEFT JOIN (SELECT report_id, pdf_page, 1 AS k FROM fx_pages WHERE pdf_page % 3 = 0) n USING (report_id, pdf_page)
  LEFT JOIN (SELECT report_id, pdf_page, string_agg(raw_text, '; ' ORDER BY match_no) AS names FROM titles GROUP BY ALL) t USING (report_id, pdf_page))"""


def titles(spark, sf):
    return ix.detect_titles(ix.drop_toc_pages(report_pages(spark, sf)))


def page_index(spark, sf):
    pages = report_pages(spark, sf)
    tables = pages.where("pdf_page % 3 = 0").select("report_id", "pdf_page", F.lit(1).alias("table_idx"))
    return ix.build_page_index(pages, tables, ix.detect_titles(ix.drop_toc_pages(pages)))


def a1_read_pages(spark, sf):
    from gridloom.sources.readers import clean_pages

    return clean_pages(report_pages(spark, sf).select("report_id", "pdf_page", F.when(F.col("pdf_page") % 7 != 0, F.col("page_text")).alias("page_text")))


def a2_read_raw_rows(spark, sf):
    from gridloom.sources.readers import string_cells

    rows = string_cells(grid_rows(spark, sf).withColumn("cells", F.transform("cells", lambda c: F.when(c != "N/A", c))))
    return rows.select("report_id", "pdf_page", "row_idx", F.array_join("cells", "|").alias("joined"))


def a3_load_catalogs(spark, sf):
    from gridloom.sources.catalogs import catalogs_of

    return catalogs_of(table(spark, sf, "nation"), table(spark, sf, "region"), table(spark, sf, "customer"))["aliases"]


def a3_load_catalog_files(spark, sf):
    """Regions, nations and segments as nested catalog files, loaded as flat dimensions; one list of all."""
    from gridloom.sources.catalogs import load_catalogs, write_catalogs

    nation, region, customer = (table(spark, sf, t) for t in ("nation", "region", "customer"))
    both = nation.join(region, F.expr("n_regionkey = r_regionkey"))
    entries = lambda df, key, value: df.select(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v"))))))
    per = both.groupBy("r_name").agg(F.sort_array(F.collect_list(F.concat(F.lit(" "), "n_name"))).alias("names"), F.sort_array(F.collect_list(F.lower("n_comment") if "n_comment" in nation.columns else F.lower("n_name"))).alias("aliases"))
    segments = customer.select("c_mktsegment").distinct()
    files = {
        "states": region.agg(F.sort_array(F.collect_list("r_name")).alias("states")),
        "state_aliases": entries(nation.select(F.concat("n_name", F.lit(" ")).alias("k"), "n_name"), "k", F.col("n_name")).toDF("state_aliases"),
        "utilities": entries(per, "r_name", F.col("names")).toDF("utilities"),
        "voltages": entries(per, "r_name", F.struct(F.slice("names", 1, 2).alias("aliases"))).toDF("voltages"),
        "units": entries(segments, "c_mktsegment", F.array(F.substring("c_mktsegment", 1, 3), F.lit(" "))).toDF("units"),
        "categories": entries(per, "r_name", F.struct(F.slice("names", 3, 1).alias("aliases"), F.slice("names", 4, 2).alias("subcategories"))).toDF("categories"),
    }
    folder = new_path(spark, "catalogs")
    write_catalogs(files, folder)
    got = load_catalogs(spark, folder)
    none = F.lit(None).cast("string")
    flat = {
        "states": ("canonical", none), "utilities": ("canonical", F.col("state")), "state_aliases": ("alias", F.col("canonical")), "voltages": ("alias", F.col("canonical")),
        "units": ("alias", F.col("canonical")), "categories": ("alias", F.col("canonical")), "subcategories": ("subcategory", F.col("category")),
    }
    parts = [got[k].select(F.lit(k).alias("dimension"), F.col(name).alias("name"), of.alias("of")) for k, (name, of) in flat.items()]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def a5_page_index_csv(spark, sf):
    """Written as CSV twice to one path, and read back."""
    from gridloom.sources.writers import read_page_index_csv, write_page_index_csv

    path = new_path(spark, "page-index")
    for _ in range(2):
        write_page_index_csv(page_index(spark, sf), path)
    return read_page_index_csv(spark, path)


def a8_content_identity(spark, sf):
    from gridloom.sources.readers import content_identity

    return content_identity(report_pages(spark, sf))


def b2_drop_toc_pages(spark, sf):
    return ix.drop_toc_pages(report_pages(spark, sf)).select("report_id", "pdf_page")


def b3_build_page_index(spark, sf):
    return page_index(spark, sf).withColumn("titles", F.array_join("titles", "; "))


def b4_page_index_rollup(spark, sf):
    return ix.page_index_rollup(page_index(spark, sf))


def b5_page_search(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("source").alias("report_id"), F.col("doc_id").alias("pdf_page"), F.col("text").alias("page_text"))
    words = F.slice(F.split("text", " "), 1, 2)
    return ix.page_search(docs, table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.array_join(words, " ").alias("query")))


def b6_title_catalog(spark, sf):
    return ix.title_catalog(titles(spark, sf), min_page=2)


def b7_phrase_pages(spark, sf):
    phrases = table(spark, sf, "region").select(F.concat("r_name", F.lit(" charge")).alias("phrase"))
    return ix.phrase_pages(report_pages(spark, sf), phrases, 2)


QUERIES = {
    "a1_read_pages": a1_read_pages,
    "a2_read_raw_rows": a2_read_raw_rows,
    "a3_load_catalogs": a3_load_catalogs,
    "a3_load_catalog_files": a3_load_catalog_files,
    "a5_page_index_csv": a5_page_index_csv,
    "a8_content_identity": a8_content_identity,
    "b1_detect_titles": titles,
    "b2_drop_toc_pages": b2_drop_toc_pages,
    "b3_build_page_index": b3_build_page_index,
    "b4_page_index_rollup": b4_page_index_rollup,
    "b5_page_search": b5_page_search,
    "b6_title_catalog": b6_title_catalog,
    "b7_phrase_pages": b7_phrase_pages,
}

ORACLE_SQL = {
    "a1_read_pages": f"{WITH_PAGES} SELECT report_id, pdf_page, CASE WHEN pdf_page % 7 = 0 THEN '' ELSE page_text END AS page_text FROM fx_pages",
    "a2_read_raw_rows": f"""{WITH_GRID} SELECT report_id, pdf_page, page_row AS row_idx,
      replace(concat_ws('|', c0, c1, c2, c3, c4, c5, c6, c7), 'N/A', '') AS joined FROM fx_grid""",
    "a3_load_catalogs": """SELECT lower(trim(r_name)) AS alias, r_name AS canonical, 'region' AS kind, CAST(row_number() OVER (ORDER BY r_regionkey) AS INT) AS priority FROM region
      UNION ALL SELECT lower(trim(n_name)), n_name, 'nation', CAST(row_number() OVER (ORDER BY n_nationkey) AS INT) FROM nation
      UNION ALL SELECT lower(trim(c_mktsegment)), c_mktsegment, 'segment', CAST(row_number() OVER (ORDER BY c_mktsegment) AS INT) FROM (SELECT DISTINCT c_mktsegment
        FROM customer)""",
    "a3_load_catalog_files": """WITH p AS (SELECT r_name, list(n_name ORDER BY n_name) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1), s AS (SELECT DISTINCT c_mktsegment AS g FROM customer)
      SELECT 'states' AS dimension, r_name AS name, NULL AS "of" FROM region UNION ALL SELECT 'utilities', unnest(n), r_name FROM p UNION ALL SELECT 'state_aliases',
        lower(n_name), n_name FROM nation
      UNION ALL SELECT 'voltages', lower(r_name), r_name FROM p UNION ALL SELECT 'voltages', lower(unnest(n[1:2])), r_name FROM p UNION ALL SELECT 'units', lower(g), g
        FROM s UNION ALL SELECT 'units', lower(g[1:3]), g FROM s
      UNION ALL SELECT 'categories', lower(r_name), r_name FROM p UNION ALL SELECT 'categories', lower(unnest(n[3:3])), r_name FROM p UNION ALL SELECT 'subcategories',
        lower(unnest(n[4:5])), r_name FROM p""",
    "a5_page_index_csv": f"{WITH_INDEX} SELECT report_id, pdf_page, text_length, table_count, contains_table, titles AS table_titles FROM idx",
    "a8_content_identity": f"""{WITH_PAGES}, g AS (SELECT report_id, floor(pdf_page / 1024) AS b, sha256(string_agg(sha256(page_text), '' ORDER BY pdf_page)) AS d, count(*) AS n FROM fx_pages GROUP BY 1, 2),
      h AS (SELECT report_id, sha256(string_agg(d, '' ORDER BY b)) AS content_hash, CAST(sum(n) AS BIGINT) AS page_count FROM g GROUP BY report_id)
      SELECT report_id, content_hash, substr(content_hash, 1, 16) AS content_id, page_count FROM h""",
    "b1_detect_titles": f"{WITH_TITLES} SELECT * FROM titles",
    "b2_drop_toc_pages": f"{WITH_TITLES} SELECT report_id, pdf_page FROM kept",
    "b3_build_page_index": f"{WITH_INDEX} SELECT * FROM idx",
    "b4_page_index_rollup": f"""{WITH_INDEX} SELECT report_id, count(*) AS page_count, count(*) FILTER (titles <> '') AS pages_with_titles,
      count(*) FILTER (contains_table) AS pages_with_tables, coalesce(string_agg(CAST(pdf_page AS VARCHAR), ',' ORDER BY pdf_page) FILTER (titles <> ''), '') AS anchor_pages
        FROM idx GROUP BY report_id""",
    "b5_page_search": r"""WITH q AS (SELECT item_id AS query_id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(concat_ws(' ', string_split(text, ' ')[1], string_split(text, ' ')[2])), '[^a-z0-9]+'), lambda t: t <> ''))) AS term FROM benchmark),
      n AS (SELECT query_id, count(*) AS n_terms FROM q GROUP BY 1),
      x AS (SELECT source AS report_id, doc_id AS pdf_page, unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda t: t <> ''))) AS term
        FROM documents),
      h AS (SELECT query_id, report_id, pdf_page FROM x JOIN q USING (term) JOIN n USING (query_id) GROUP BY query_id, report_id, pdf_page, n_terms HAVING count(*) = n_terms),
      r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY report_id, pdf_page) AS INT) AS place FROM h)
      SELECT query_id, report_id, pdf_page, place FROM r WHERE place <= 20""",
    "b6_title_catalog": f"""{WITH_TITLES} SELECT DISTINCT report_id, pdf_page, trim(regexp_replace(title_text, '\\s+', ' ', 'g')) AS title FROM titles
      WHERE pdf_page >= 2 AND length(trim(regexp_replace(title_text, '\\s+', ' ', 'g'))) > 8""",
    "b7_phrase_pages": f"""{WITH_PAGES} SELECT concat(r_name, ' charge') AS phrase, report_id, pdf_page, array_to_string(string_split(page_text, chr(10))[1:2], chr(10)) AS preview
      FROM fx_pages JOIN region ON contains(upper(page_text), upper(concat(r_name, ' charge')))""",
}
