"""Queries of extraction and normalisation (groups D and E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.fixtures import CELLS, WITH_BODY, WITH_GRID, grid_body, grid_rows, table
from gridloom.functions import text as tx
from gridloom.operators import extraction as ex
from gridloom.operators import normalize as nm
from gridloom.sources.scratch import written

JOINED = "concat_ws('|', c0, c1, c2, c3, c4, c5, c6, c7)"


def flat(df, *keys):
    """Rows with their cells as one string, so that either engine prints them alike."""
    return df.select(*keys, F.array_join("cells", "|").alias("joined"))


def two_tables(spark, sf):
    """Raw rows whose page 2 (and every third after) has a second, smaller table."""
    rows = grid_rows(spark, sf)
    small = rows.where("pdf_page % 3 = 2 AND row_idx < 4").withColumn("table_idx", F.lit(0)).withColumn("cells", F.slice("cells", 1, 3))
    return rows.unionByName(small)


TWO = WITH_GRID + """, raw AS (SELECT report_id, pdf_page, 1 AS table_idx, page_row AS row_idx, 8 AS w, concat_ws('|', c0, c1, c2, c3, c4, c5, c6, c7) AS joined,
  concat_ws(' ', c0, c1, c2, c3, c4, c5, c6, c7) AS spaced FROM fx_grid
  UNION ALL SELECT report_id, pdf_page, 0, page_row, 3, concat_ws('|', c0, c1, c2), concat_ws(' ', c0, c1, c2) FROM fx_grid WHERE pdf_page % 3 = 2 AND page_row < 4)"""


def ranges_of(spark, sf):
    pages = grid_rows(spark, sf).select("report_id").distinct()
    return pages.select("report_id", F.lit(2).alias("start_page"), (F.lit(4) + F.col("report_id") % 3).alias("end_page"))


def merged(spark, sf):
    return ex.merge_pages(grid_rows(spark, sf))


def ragged(spark, sf):
    """Rows cut after their last filled cell."""
    last = F.array_max(F.transform(F.sequence(F.lit(1), F.size("cells")), lambda i: F.when(F.element_at("cells", i) != "", i).otherwise(0)))
    return grid_body(spark, sf).withColumn("cells", F.slice("cells", 1, F.greatest(last, F.lit(1))))


def shifted(spark, sf):
    """Merged grids with the header of c2 one column to the right, over the empty c3."""
    rows = merged(spark, sf)
    cells = F.when(F.col("row_no") == 1, F.array(*map(F.lit, ["State", "Utility", "", "Year", "LT", "11 kV", "33 kV", "132 kV"]))).otherwise(F.col("cells"))
    return written(rows.withColumn("cells", cells), "shifted")


def clean(spark, sf):
    return nm.clean_cells(grid_body(spark, sf))


def states(spark, sf):
    from gridloom.sources.catalogs import names, ranked

    seg = ranked(table(spark, sf, "customer"), "c_mktsegment")
    catalog = names(seg, "c_mktsegment", F.col("place"), "segment").select("canonical", "priority")
    aliases = spark.createDataFrame([("auto", "AUTOMOBILE", 1), ("bldg", "BUILDING", 2), ("hh", "HOUSEHOLD", 3)], "alias string, canonical string, priority int")
    return catalog, aliases


def filled(spark, sf):
    return nm.forward_fill_group(written(clean(spark, sf), "clean"))


def e9_values(spark, sf):
    name = F.col("c_mktsegment")
    k = F.col("c_custkey") % 5
    shape = (
        F.when(k == 0, F.concat(F.lower(name), F.lit("(cid:3) *"))).when(k == 1, F.concat(F.lit("the "), name, F.lit(" group")))
        .when(k == 2, F.lit("auto")).when(k == 3, F.lit("new bldg zone")).otherwise(F.concat(F.lit("x"), name))
    )
    return table(spark, sf, "customer").select(shape.alias("value")).distinct()


def e9_resolve_state(spark, sf):
    return nm.resolve_state(e9_values(spark, sf), *states(spark, sf))


def e10_detect_group_in_row(spark, sf):
    return nm.detect_group_in_row(clean(spark, sf), *states(spark, sf))


def sectioned(spark, sf):
    """The grids with a section line in place of every 50th row."""
    line = F.array(F.lit(""), F.when(F.col("row_no") % 100 == 0, "Low Recovery").otherwise("Medium"), *[F.lit("")] * 6)
    rows = written(clean(spark, sf), "clean").withColumn("cells", F.when(F.col("row_no") % 50 == 0, line).otherwise(F.col("cells")))
    return nm.detect_section_header(rows)


def labelled(spark, sf):
    rows = sectioned(spark, sf)
    return nm.label_rows(nm.forward_fill_group(rows, section=F.col("is_section")), ["utility name"], 0)


def blocks(spark, sf):
    return nm.segment_blocks_spanning(filled(spark, sf), F.get("cells", F.lit(0)) != "")


def marked(spark, sf):
    """The grids with a marker line in place of every 30th row."""
    line = F.array(F.concat(F.lit("हिन्दी / "), "report_id", F.lit(" Part "), (F.col("row_no") / 30).cast("int").cast("string"), F.lit(" 2024-25")), *[F.lit("")] * 4)
    return clean(spark, sf).withColumn("cells", F.when(F.col("row_no") % 30 == 0, line).otherwise(F.slice("cells", 1, 5)))


UTILITY_ALIASES = [("automob", "Auto Power"), ("00007", "Seven Power"), ("new zone", "Zone Power")]


def utility_names(spark, sf):
    """Every third customer of the catalog, and a few aliases."""
    catalog = table(spark, sf, "customer").where("c_custkey % 3 = 0").select("c_custkey", F.col("c_name").alias("canonical"), F.col("c_mktsegment").alias("state"))
    aliases = spark.createDataFrame([(n, c, i) for i, (n, c) in enumerate(UTILITY_ALIASES)], "name string, canonical string, priority int")
    return aliases, catalog.withColumnRenamed("c_custkey", "priority")


def utility_blocks(spark, sf):
    """A block for every run of a utility, with sections and unlisted utilities among its cells."""
    r = F.col("row_no")
    six = F.when(r % 11 == 0, "HT supply").when(r % 13 == 0, "LT-II").when(r % 17 == 0, "EHT")
    three = F.when(r % 7 == 0, F.concat(F.lit(" North DISCOM "), (r % 3).cast("string"))).when(r % 29 == 0, "in 2024-25")
    cell = {3: three, 6: six}
    rows = filled(spark, sf)
    cells = F.array(*[F.coalesce(cell[i], F.get("cells", F.lit(i))) if i in cell else F.get("cells", F.lit(i)) for i in range(8)])
    return nm.segment_blocks_spanning(rows.withColumn("cells", cells), F.get("cells", F.lit(1)) != "")


def e17_describe_blocks(spark, sf):
    aliases, catalog = utility_names(spark, sf)
    names = aliases.select("name", "canonical").unionByName(catalog.select(F.col("canonical").alias("name"), "canonical"))
    return nm.describe_blocks(written(utility_blocks(spark, sf), "blocks"), names)


def e19_utility_to_group(spark, sf):
    from gridloom.sources.catalogs import catalogs_of

    cat = catalogs_of(table(spark, sf, "nation"), table(spark, sf, "region"), table(spark, sf, "customer"))
    k = F.col("c_custkey") % 3
    values = table(spark, sf, "customer").select(F.when(k == 0, F.col("c_name")).when(k == 1, F.concat(F.lit("M/s "), "c_name", F.lit(" Ltd"))).otherwise(F.concat(F.lit("no"), F.col("c_custkey").cast("string"))).alias("value"))
    return nm.utility_to_group(values, cat["utilities"])


CLEAN = WITH_BODY + r""", cl AS (SELECT report_id, row_no, pdf_page, trim(regexp_replace(regexp_replace(c0, '\(cid:\d+\)', ''), '\*+$', '')) AS c0, c1, c2, c3, c4, c5, c6, c7 FROM body),
fl AS (SELECT *, coalesce(last_value(nullif(c0, '') IGNORE NULLS) OVER (PARTITION BY report_id ORDER BY row_no), '') AS state FROM cl),
bl AS (SELECT *, sum(CASE WHEN c0 <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY report_id ORDER BY row_no) AS block_no FROM fl)"""
UBLOCKS = CLEAN + """, ua AS (SELECT report_id, row_no, pdf_page, state, c0, c1, c2, CASE WHEN row_no % 7 = 0 THEN concat(' North DISCOM ', row_no % 3) WHEN row_no % 29 = 0 THEN 'in 2024-25'
      ELSE c3 END AS c3, c4, c5,
  CASE WHEN row_no % 11 = 0 THEN 'HT supply' WHEN row_no % 13 = 0 THEN 'LT-II' WHEN row_no % 17 = 0 THEN 'EHT' ELSE c6 END AS c6, c7,
  sum(CASE WHEN c1 <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY report_id ORDER BY row_no) AS block_no FROM fl),
ub AS (SELECT * FROM ua WHERE block_no > 0)"""
SECT = CLEAN + """, se AS (SELECT report_id, row_no, row_no % 50 = 0 AS is_section,
  CASE WHEN row_no % 50 = 0 THEN '' ELSE c0 END AS c0, CASE WHEN row_no % 100 = 0 THEN 'Low Recovery' WHEN row_no % 50 = 0 THEN 'Medium' ELSE c1 END AS c1,
  CASE WHEN row_no % 50 = 0 THEN '' ELSE concat(c2, c3, c4, c5, c6, c7) END AS rest FROM cl),
sg AS (SELECT *, sum(CASE WHEN is_section THEN 1 ELSE 0 END) OVER (PARTITION BY report_id ORDER BY row_no) AS s FROM se),
sf AS (SELECT *, coalesce(last_value(nullif(c0, '') IGNORE NULLS) OVER (PARTITION BY report_id, s ORDER BY row_no), '') AS state FROM sg)"""

QUERIES = {
    "d1_candidate_tables": lambda s, d: ex.candidate_tables(two_tables(s, d)),
    "d2_select_primary_table": lambda s, d: flat(ex.select_primary_table(written(two_tables(s, d), "tables")), "report_id", "pdf_page", "table_idx", "row_idx"),
    "d2_select_first_table": lambda s, d: flat(ex.select_primary_table(written(two_tables(s, d), "tables"), "first_table"), "report_id", "pdf_page", "table_idx", "row_idx"),
    "d2_select_table_by_index": lambda s, d: flat(ex.select_primary_table(written(two_tables(s, d), "tables"), "by_index", 1), "report_id", "pdf_page", "table_idx", "row_idx"),
    "d3_extract_in_range": lambda s, d: flat(ex.extract_in_range(grid_rows(s, d), grid_rows(s, d), ranges_of(s, d)), "report_id", "pdf_page", "row_idx", "warning"),
    "d4_range_id": lambda s, d: ex.range_id(ranges_of(s, d)),
    "d5_detect_header_height": lambda s, d: ex.detect_header_height(grid_rows(s, d)),
    "d6_merge_pages": lambda s, d: flat(merged(s, d), "report_id", "row_no", "pdf_page"),
    "d7_pad_rows": lambda s, d: flat(ex.pad_rows(ragged(s, d)), "report_id", "row_no"),
    "d8_merge_log": lambda s, d: ex.merge_log(grid_rows(s, d)),
    "d9_drop_keyword_headers": lambda s, d: flat(ex.drop_keyword_headers(grid_rows(s, d), ["state", "utility", "kv charge"]), "report_id", "pdf_page", "row_idx"),
    "d10_skip_header_rows": lambda s, d: flat(ex.skip_header_rows(grid_rows(s, d), 2), "report_id", "pdf_page", "row_idx"),
    "e1_align_headers": lambda s, d: flat(nm.align_headers(shifted(s, d), 1), "report_id", "row_no"),
    "e2_drop_empty_columns": lambda s, d: flat(nm.drop_empty_columns(grid_body(s, d)), "report_id", "row_no"),
    "e3_drop_empty_rows": lambda s, d: flat(nm.drop_empty_rows(grid_body(s, d).withColumn("cells", F.slice("cells", 1, 2))), "report_id", "row_no"),
    "e4_cleanup_stats": lambda s, d: nm.cleanup_stats(grid_body(s, d), nm.drop_empty_columns(grid_body(s, d))),
    "e5_clean_text": lambda s, d: flat(grid_body(s, d).withColumn("cells", F.transform("cells", tx.clean_text)), "report_id", "row_no"),
    "e6_extract_english": lambda s, d: marked(s, d).select("report_id", "row_no", tx.extract_english(F.get("cells", F.lit(0))).alias("english"), tx.latin_tokens(F.get("cells", F.lit(0))).alias("latin"), tx.after_last_slash(F.get("cells", F.lit(0))).alias("tail")),
    "e7_count_artifacts": lambda s, d: nm.artifact_counts(grid_body(s, d)),
    "e8_normalize_key": lambda s, d: grid_body(s, d).select("report_id", "row_no", tx.normalize_key(F.concat(F.get("cells", F.lit(0)), F.lit(" & /"), F.get("cells", F.lit(1)))).alias("key")),
    "e9_resolve_state": e9_resolve_state,
    "e10_detect_group_in_row": e10_detect_group_in_row,
    "e11_label_rows": lambda s, d: labelled(s, d).select("report_id", "row_no", "row_label"),
    "e12_forward_fill_group": lambda s, d: filled(s, d).select("report_id", "row_no", "state", "propagated"),
    "e13_detect_section_header": lambda s, d: sectioned(s, d).select("report_id", "row_no", "is_section"),
    "e14_segment_blocks_spanning": lambda s, d: nm.block_spans(blocks(s, d)),
    "e15_segment_blocks_column": lambda s, d: nm.block_spans(nm.segment_blocks_column(clean(s, d), F.when(F.get("cells", F.lit(2)) != "", F.substring(F.get("cells", F.lit(2)), 1, 4)))),
    "e16_segment_blocks_marker": lambda s, d: nm.segment_blocks_marker(marked(s, d)).select("report_id", "row_no", "block_no", "block_name"),
    "e17_describe_blocks": e17_describe_blocks,
    "e18_compress_row": lambda s, d: grid_body(s, d).select("report_id", "row_no", F.array_join(tx.compress_row(F.col("cells")), "|").alias("joined")),
    "e19_utility_to_group": e19_utility_to_group,
}

ORACLE_SQL = {
    "d1_candidate_tables": f"""{TWO} SELECT report_id, pdf_page, table_idx, count(*) AS row_count, max(w) AS column_count, min_by(spaced, row_idx) AS sample, count(*) * max(w) AS area,
      count(*) OVER (PARTITION BY report_id, pdf_page) AS tables_on_page FROM raw GROUP BY report_id, pdf_page, table_idx""",
    "d2_select_primary_table": f"""{TWO}, a AS (SELECT report_id, pdf_page, table_idx, row_number() OVER (PARTITION BY report_id, pdf_page ORDER BY count(*) * max(w) DESC, table_idx) AS k FROM raw GROUP BY 1, 2, 3)
      SELECT report_id, pdf_page, table_idx, row_idx, joined FROM raw JOIN a USING (report_id, pdf_page, table_idx) WHERE k = 1""",
    "d2_select_first_table": f"""{TWO}, a AS (SELECT report_id, pdf_page, min(table_idx) AS table_idx FROM raw GROUP BY 1, 2) SELECT report_id, pdf_page, table_idx, row_idx, joined FROM raw JOIN a USING (report_id, pdf_page, table_idx)""",
    "d2_select_table_by_index": f"""{TWO} SELECT report_id, pdf_page, table_idx, row_idx, joined FROM raw WHERE table_idx = 1""",
    "d3_extract_in_range": f"""{WITH_GRID} SELECT report_id, pdf_page, page_row AS row_idx, CAST(NULL AS VARCHAR) AS warning, {JOINED} AS joined FROM fx_grid WHERE pdf_page BETWEEN 2 AND 4 + report_id % 3""",
    "d4_range_id": f"{WITH_GRID} SELECT DISTINCT report_id, 2 AS start_page, 4 + report_id % 3 AS end_page, substr(sha256(concat('2-', 4 + report_id % 3)), 1, 16) AS range_id FROM fx_grid",
    "d5_detect_header_height": f"{WITH_GRID} SELECT report_id, CASE WHEN max(pdf_page) > 1 THEN 1 ELSE 0 END AS header_height FROM fx_grid GROUP BY 1",
    "d6_merge_pages": f"""{WITH_GRID} SELECT report_id, CAST(row_number() OVER (PARTITION BY report_id ORDER BY pdf_page, page_row) AS INT) AS row_no, pdf_page, {JOINED} AS joined
      FROM fx_grid WHERE NOT (page_row = 0 AND pdf_page > 1)""",
    "d7_pad_rows": f"{WITH_BODY} SELECT report_id, row_no, {JOINED} AS joined FROM body",
    "d8_merge_log": f"""{WITH_GRID} SELECT report_id, pdf_page, count(*) FILTER (NOT (page_row = 0 AND pdf_page > 1)) AS rows_added, count(*) FILTER (page_row = 0 AND pdf_page > 1) AS headers_removed,
      sha256(string_agg({JOINED}, chr(10) ORDER BY page_row) FILTER (NOT (page_row = 0 AND pdf_page > 1))) AS page_hash FROM fx_grid GROUP BY 1, 2""",
    "d9_drop_keyword_headers": f"{WITH_GRID} SELECT report_id, pdf_page, page_row AS row_idx, {JOINED} AS joined FROM fx_grid WHERE page_row > 0",
    "d10_skip_header_rows": f"{WITH_GRID} SELECT report_id, pdf_page, page_row AS row_idx, {JOINED} AS joined FROM fx_grid WHERE page_row > 1",
    "e1_align_headers": f"""{WITH_BODY} SELECT DISTINCT report_id, 1 AS row_no, 'State|Utility|Year||LT|11 kV|33 kV|132 kV' AS joined FROM body
      UNION ALL SELECT report_id, row_no + 1, {JOINED} FROM body""",
    "e2_drop_empty_columns": f"{WITH_BODY} SELECT report_id, row_no, concat_ws('|', c0, c1, c2, c4, c5, c6, c7) AS joined FROM body",
    "e3_drop_empty_rows": f"{WITH_BODY} SELECT report_id, row_no, concat_ws('|', c0, c1) AS joined FROM body WHERE c0 <> '' OR c1 <> ''",
    "e4_cleanup_stats": f"{WITH_BODY} SELECT report_id, 0 AS empty_rows_removed, 1 AS empty_cols_removed, count(*) FILTER (contains(c0, '(cid:')) AS cid_tokens_removed FROM body GROUP BY 1",
    "e5_clean_text": f"{CLEAN} SELECT report_id, row_no, {JOINED} AS joined FROM cl",
    "e6_extract_english": f"""{CLEAN}, t AS (SELECT report_id, row_no, row_no % 30 = 0 AS m, c0, concat(report_id, ' Part ', CAST(floor(row_no / 30) AS INT), ' 2024-25') AS name FROM cl)
      SELECT report_id, row_no, CASE WHEN m THEN name ELSE c0 END AS english, CASE WHEN m THEN 'Part' ELSE c0 END AS latin, CASE WHEN m THEN name ELSE c0 END AS tail FROM t""",
    "e7_count_artifacts": f"{WITH_BODY} SELECT report_id, count(*) FILTER (contains(c0, '(cid:')) AS cid_tokens FROM body GROUP BY 1",
    "e8_normalize_key": f"""{WITH_BODY} SELECT report_id, row_no, trim(regexp_replace(regexp_replace(replace(regexp_replace(lower(concat(c0, ' & /', c1)), '\\(cid:\\d+\\)', '', 'g'), '&', ' and '), '[/*]', '', 'g'), '\\s+', ' ', 'g')) AS key FROM body""",
    "e9_resolve_state": """WITH v AS (SELECT DISTINCT c_custkey % 5 AS k, c_mktsegment AS n FROM customer),
      x AS (SELECT DISTINCT CASE k WHEN 0 THEN concat(lower(n), '(cid:3) *') WHEN 1 THEN concat('the ', n, ' group') WHEN 2 THEN 'auto' WHEN 3 THEN 'new bldg zone'
        ELSE concat('x', n) END AS value,
        CASE k WHEN 0 THEN n WHEN 1 THEN n WHEN 2 THEN 'AUTOMOBILE' WHEN 3 THEN 'BUILDING' END AS canonical, CASE k WHEN 0 THEN 'exact' WHEN 1 THEN 'name_word'
          WHEN 2 THEN 'alias' WHEN 3 THEN 'alias_word' END AS method FROM v)
      SELECT * FROM x""",
    "e10_detect_group_in_row": f"{CLEAN} SELECT report_id, row_no, c0 AS state, 0 AS col_idx FROM cl WHERE c0 <> ''",
    "e11_label_rows": f"""{SECT} SELECT report_id, row_no, CASE WHEN is_section THEN 'section_header' WHEN c0 <> '' THEN 'master' WHEN c1 <> '' AND state <> '' THEN 'child' WHEN c1 = '' AND rest <> '' AND state <> '' THEN 'continuation' ELSE 'data' END AS row_label FROM sf""",
    "e12_forward_fill_group": f"{CLEAN} SELECT report_id, row_no, state, c0 = '' AND state <> '' AS propagated FROM fl",
    "e13_detect_section_header": f"{SECT} SELECT report_id, row_no, is_section FROM se",
    "e14_segment_blocks_spanning": f"{CLEAN} SELECT report_id, block_no, min(row_no) AS start_row, max(row_no) AS end_row, count(*) AS row_count FROM bl WHERE block_no > 0 GROUP BY 1, 2",
    "e15_segment_blocks_column": f"""{CLEAN}, g AS (SELECT *, lag(substr(c2, 1, 4)) OVER (PARTITION BY report_id ORDER BY row_no) AS b FROM cl),
      n AS (SELECT *, sum(CASE WHEN b IS NULL OR b <> substr(c2, 1, 4) THEN 1 ELSE 0 END) OVER (PARTITION BY report_id ORDER BY row_no) AS block_no FROM g)
      SELECT report_id, block_no, min(row_no) AS start_row, max(row_no) AS end_row, count(*) AS row_count FROM n GROUP BY 1, 2""",
    "e16_segment_blocks_marker": f"{CLEAN} SELECT report_id, row_no, CAST(floor(row_no / 30) AS INT) AS block_no, concat(report_id, ' Part ', CAST(floor(row_no / 30) AS INT)) AS block_name FROM cl WHERE row_no > 30 AND row_no % 30 <> 0",
    "e17_describe_blocks": rf"""{UBLOCKS}, x AS (SELECT report_id, block_no, row_no, state, unnest([c0, c1, c2, c3, c4, c5, c6, c7]) AS cell, unnest(range(0, 8)) AS i FROM ub),
      nm AS (SELECT lower(c_name) AS name, c_name AS canonical FROM customer WHERE c_custkey % 3 = 0
        UNION ALL VALUES ('automob', 'Auto Power'), ('00007', 'Seven Power'), ('new zone', 'Zone Power')),
      h AS (SELECT report_id, block_no, string_agg(DISTINCT canonical, ',' ORDER BY canonical) AS held FROM x JOIN nm ON contains(lower(cell), name) GROUP BY 1, 2),
      b AS (SELECT report_id, block_no, min_by(state, row_no) AS state, nullif(min_by(regexp_extract(cell, '\b20\d{{2}}-\d{{2}}\b'), row_no * 10 + i) FILTER (regexp_matches(cell, '\b20\d{{2}}-\d{{2}}\b')), '') AS year,
        coalesce(string_agg(DISTINCT trim(cell), ',' ORDER BY trim(cell)) FILTER (regexp_matches(lower(cell), 'discom|utility|licensee')), '') AS worded,
        concat_ws(',', CASE WHEN bool_or(contains(lower(cell), 'eht')) THEN 'EHT' END, CASE WHEN bool_or(contains(lower(cell), 'ht')) THEN 'HT' END, CASE
          WHEN bool_or(contains(lower(cell), 'lt')) THEN 'LT' END) AS sections,
        min(row_no) AS start_row, max(row_no) AS end_row, count(DISTINCT row_no) AS row_count FROM x GROUP BY 1, 2)
      SELECT report_id, block_no, state, year, coalesce(held, worded) AS utilities, sections, start_row, end_row, row_count, concat_ws('_', CAST(report_id AS VARCHAR),
        replace(lower(state), ' ', '_'), CAST(start_row AS VARCHAR), CAST(end_row AS VARCHAR)) AS block_id
      FROM b LEFT JOIN h USING (report_id, block_no)""",
    "e18_compress_row": f"{WITH_BODY} SELECT report_id, row_no, concat_ws('|', {', '.join(f'nullif(trim({c}), $$$$)' for c in CELLS)}) AS joined FROM body".replace("$$$$", "''"),
    "e19_utility_to_group": """SELECT DISTINCT CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN concat('M/s ', c_name, ' Ltd') ELSE concat('no', c_custkey) END AS value,
      CASE WHEN c_custkey % 3 < 2 THEN c_mktsegment END AS state, CASE c_custkey % 3 WHEN 0 THEN 'exact' WHEN 1 THEN 'word' END AS method FROM customer""",
}
