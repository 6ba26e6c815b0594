"""Queries of record builders (group I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.fixtures import CELLS, grid_body, grid_heads, grid_rows, table
from gridloom.functions import text as tx
from gridloom.operators import builders as bd
from gridloom.plans.normalize import CLEAN, SECT, blocks, clean, filled, labelled, sectioned, utility_names
from gridloom.sources.catalogs import ranked
from gridloom.sources.scratch import written

VALUE_COLUMNS = {"LT": 4, "11 kV": 5, "33 kV": 6, "132 kV": 7}


def header(spark, sf):
    return grid_heads(spark, sf).where("pdf_page = 1").select("report_id", F.lit(1).alias("row_no"), "cells")


def labels(spark, sf):
    return bd.header_labels(header(spark, sf))


def records(spark, sf):
    return bd.wide_to_long(clean(spark, sf), labels(spark, sf))


def i2_wide_to_long(spark, sf):
    """Records with the utility that their category names, out of words of the segments and their whole names."""
    segments = ranked(table(spark, sf, "customer"), "c_mktsegment")
    names = segments.select(F.col("c_mktsegment").alias("canonical"), (F.col("place") * 2).alias("priority"))
    names = names.unionByName(segments.where("place % 2 = 0").select(F.substring("c_mktsegment", 1, 3).alias("canonical"), (F.col("place") * 2 - 1).alias("priority")))
    return bd.wide_to_long(written(clean(spark, sf), "clean"), labels(spark, sf), names=names)


def num(c: str) -> str:
    return f"TRY_CAST(regexp_extract({c}, '[-+]?\\d+(?:\\.\\d+)?') AS DOUBLE)"


LABELS = ["State", "Utility", "Year", "Col 3", "LT Charge (Rs/kWh)", "11 kV Charge", "33 kV Charge", "132 kV Charge"]
VOLT = ["all", "all", "all", "all", "LT", "11 kV", "33 kV", "132 kV"]


def melted(first: int, source: str = "cl") -> str:
    return " UNION ALL ".join(f"SELECT *, {i} AS col_idx, '{LABELS[i]}' AS label, '{VOLT[i]}' AS volt, {CELLS[i]} AS cell, {num(CELLS[i])} AS value FROM {source}" for i in range(first, 8))


KEYED = CLEAN + f""", k1 AS (SELECT *, sum(CASE WHEN c0 <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY report_id
      ORDER BY row_no) AS seg, last_value(nullif(c0, '') IGNORE NULLS) OVER (PARTITION BY report_id ORDER BY row_no) AS st FROM cl),
k2 AS (SELECT *, coalesce(last_value(nullif(c1, '') IGNORE NULLS) OVER (PARTITION BY report_id, seg ORDER BY row_no), 'state_level') AS utility FROM k1),
k3 AS ({" UNION ALL ".join(f"SELECT report_id, row_no, pdf_page, st AS state, utility, c2 AS year, '{n}' AS label, {num(CELLS[i])} AS value FROM k2" for n,
  i in VALUE_COLUMNS.items())}),
keyed AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY report_id, state, utility, year, label ORDER BY row_no) AS k FROM k3) WHERE k = 1)"""


def shadowed(spark, sf):
    """Sums of every customer segment beside those of its nations: some segments have one nation only."""
    c = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("n"))
    n = table(spark, sf, "nation").join(c, F.expr("n_nationkey = s_nationkey")).select(F.col("n_regionkey").alias("report_id"), F.lit("2025-26").alias("year"), F.col("n_name").alias("utility"), "n")
    top = n.groupBy("report_id", "year").agg(F.max("n").alias("n")).withColumn("n", F.when(F.col("report_id") % 2 == 0, F.col("n")).otherwise(F.col("n") + 1)).withColumn("utility", F.lit("state_level"))
    return n.unionByName(top)


def i8_split_multi_value(spark, sf):
    line = table(spark, sf, "lineitem")
    text = F.concat(F.lit("Apr-Sep "), (F.col("l_quantity") / 10).cast("decimal(10,2)").cast("string"), F.lit(" (Partial OA)"), F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit(" "), (F.col("l_quantity") / 4).cast("decimal(10,2)").cast("string"), F.lit(" (Full OA)"))).otherwise(F.lit("")))
    return bd.split_multi_value(line.select("l_orderkey", "l_linenumber", text.alias("raw")), "raw")


def i9_parse_sentinel_number(spark, sf):
    line = table(spark, sf, "lineitem")
    k = F.col("l_linenumber")
    q = F.col("l_quantity").cast("int").cast("string")
    raw = F.when(k == 1, "Nil").when(k == 2, " N/A ").when(k == 3, F.concat(F.lit("Rs "), q, F.lit(".50 per unit"))).when(k == 4, F.concat(F.lit("Rs "), q)).when(k == 5, "--").otherwise("none")
    return line.select("l_orderkey", "l_linenumber", tx.parse_sentinel_number(raw).alias("value"))


COLUMN_ROLES = [
    (2, "Year", "category", None, None),
    (4, "LT side", "value", None, "Rs/kWh"),
    (5, "2024-25 - new zone", "value", "2024-25", None),
    (6, "", "value", None, "Rs/kW/month"),
    (7, "2025-26 - Customer#000000003 - x", "value", "2025-26", None),
]


def block_grid(spark, sf):
    """Blocks of a segment with voltage lines, categories that name a level, and in every second block a line of local headers."""
    r, own = F.col("row_no"), lambda i: F.get("cells", F.lit(i))
    body = own(0) == ""
    line = F.array(F.lit(""), F.lit(""), F.when(r % 40 == 0, "HT supply").when(r % 60 == 20, "33 kV side").otherwise("EHT"), *[F.lit("")] * 2, F.lit("-"), F.lit("nil"), F.lit(""))
    local = F.array(F.lit(""), F.lit("Category"), F.lit(""), F.lit("State"), F.lit("Automobiles"), F.lit(""), F.concat(F.lit("Customer#"), F.lpad((r % 90).cast("string"), 9, "0")), F.lit(""))
    named = F.array(*[F.when(r % 9 == 0, F.concat(F.lit("HT "), own(2))).when(r % 14 == 0, F.concat(F.lit("alt "), own(2))).otherwise(own(2)) if i == 2 else own(i) for i in range(8)])
    cells = F.when(body & (F.col("block_no") % 2 == 1) & (r % 30 == 15), local).when(body & (r % 20 == 0), line).otherwise(named)
    return blocks(spark, sf).withColumn("year", F.when(r > 0, "2023-24")).withColumn("cells", cells)


def i10_block_matrix(spark, sf):
    rows = block_grid(spark, sf)
    roles = spark.createDataFrame(COLUMN_ROLES, "col_idx int, display_name string, role string, year string, unit string")
    columns = labels(spark, sf).select("report_id", "col_idx").join(roles, "col_idx")
    records = written(bd.block_matrix(rows, columns), "matrix")
    values = written(records.select("state", "utility").distinct(), "matrix-names")
    return bd.with_canonical_utility(records, *utility_names(spark, sf), values)


def i11_nearest_header_column(spark, sf):
    cells = clean(spark, sf).select("report_id", "row_no", F.posexplode("cells").alias("col_idx", "cell")).where("col_idx >= 4")
    heads = labels(spark, sf).where("col_idx IN (3, 5, 7)")
    return bd.nearest_header_column(cells, heads)


def parents(spark, sf):
    """Rows that name a utility are parents; the payload is their first charge."""
    return clean(spark, sf).select("report_id", "row_no", (F.get("cells", F.lit(1)) != "").alias("is_parent"), F.get("cells", F.lit(1)).alias("owner"), F.get("cells", F.lit(4)).alias("charge"), F.get("cells", F.lit(2)).alias("year"))


def i16_append_continuations(spark, sf):
    rows = clean(spark, sf).select("report_id", "row_no", (F.get("cells", F.lit(1)) != "").alias("is_record"), F.when(F.get("cells", F.lit(6)) != "-", F.get("cells", F.lit(6))).otherwise("").alias("policy"))
    return bd.append_continuations(rows)


def i19_block_records_nested(spark, sf):
    out = bd.block_records_nested(blocks(spark, sf), labels(spark, sf))
    return out.select("report_id", "block_no", "row_no", "utility", F.explode("values").alias("label", "raw"))


def nested_grid(spark, sf):
    """Blocks of a run of rows of one utility's state: matrices with sections, simple matrices, and pairs of a metric and a value."""
    r, own, k = F.col("row_no"), lambda i: F.get("cells", F.lit(i)), F.col("block_no") % 3
    begins = own(0) != ""
    line = lambda *c: F.array(*[x if isinstance(x, F.Column) else F.lit(x) for x in c])
    matrix = F.when(begins | (r % 23 == 0), F.when(r % 2 == 0, line("Category", "LT", "", "HT", "LT")).otherwise(line("", "category", "LT", "HT"))).when(r % 10 == 0, line("", F.concat(F.lit("Section "), r.cast("string")))).otherwise(line(own(2), own(4), own(5), own(6)))
    simple = F.when(begins, line("Kind", own(0), "B")).otherwise(line(own(2), own(4), own(5), own(7)))
    pairs = F.when(begins | (r % 31 == 0), line("CATEGORY", F.concat(F.lit("U"), r.cast("string")))).otherwise(line(own(2), "", own(4)))
    return blocks(spark, sf).withColumn("cells", F.when(k == 1, matrix).when(k == 2, simple).otherwise(pairs))


def i19_nested_blocks(spark, sf):
    """The grid is written once; blocks are nested in parts, and cells taken from these."""
    rows = written(nested_grid(spark, sf).select("report_id", "block_no", "row_no", "cells"), "grid")
    k = F.col("block_no") % 3
    layouts = rows.select("report_id", "block_no").distinct().withColumn("layout", F.when(k == 1, "matrix").when(k == 2, "simple_matrix").otherwise("key_value"))
    return bd.flat_blocks(bd.nested_blocks(rows, written(layouts, "layouts"), count=rows.count()))


def i23_group_members(spark, sf):
    rows = filled(spark, sf).select("report_id", "row_no", "state", F.get("cells", F.lit(1)).alias("utility"), (F.get("cells", F.lit(0)) != "").alias("is_master"))
    return bd.group_members(rows)


QUERIES = {
    "i1_header_labels": labels,
    "i2_wide_to_long": i2_wide_to_long,
    "i3_wide_to_long_keyed": lambda s, d: bd.wide_to_long_keyed(written(clean(s, d), "clean"), VALUE_COLUMNS).drop("charge_unit"),
    "i4_numeric_matrix": lambda s, d: bd.numeric_matrix(clean(s, d), labels(s, d)),
    "i5_year_anchored_rows": lambda s, d: bd.year_anchored_rows(clean(s, d)),
    "i6_drop_shadowed_aggregate": lambda s, d: bd.drop_shadowed_aggregate(shadowed(s, d), ["report_id", "year"], ["n"]),
    "i7_sectioned_values": lambda s, d: bd.sectioned_values(filled_sections(s, d)),
    "i8_split_multi_value": i8_split_multi_value,
    "i9_parse_sentinel_number": i9_parse_sentinel_number,
    "i10_block_matrix": i10_block_matrix,
    "i11_nearest_header_column": i11_nearest_header_column,
    "i12_simple_matrix": lambda s, d: bd.simple_matrix(clean(s, d), labels(s, d)),
    "i13_key_value": lambda s, d: bd.key_value(clean(s, d), 1, 4),
    "i14_narrative_hierarchy": lambda s, d: bd.narrative_hierarchy(labelled(s, d)),
    "i15_narrative_fill": lambda s, d: bd.narrative_fill(clean(s, d)),
    "i16_append_continuations": i16_append_continuations,
    "i17_inherit_parent_payload": lambda s, d: bd.inherit_parent_payload(parents(s, d), ["owner", "charge"]),
    "i18_record_id": lambda s, d: bd.with_record_id(records(s, d), "wheeling", ["category", "year", "row_no", "col_idx"]).select("report_id", "row_no", "col_idx", "record_id"),
    "i19_block_records_nested": i19_block_records_nested,
    "i19_nested_blocks": i19_nested_blocks,
    "i20_parse_summary": lambda s, d: bd.parse_summary(records(s, d), clean(s, d)),
    "i21_source_pages": lambda s, d: bd.source_pages(records(s, d), ["report_id", "year"]),
    "i22_classify_record_rows": lambda s, d: bd.classify_record_rows(clean(s, d)),
    "i23_group_members": i23_group_members,
    "i24_parent_or_child_values": lambda s, d: bd.parent_or_child_values(clean(s, d)),
}


def filled_sections(spark, sf):
    from gridloom.operators.normalize import forward_fill_group

    return forward_fill_group(sectioned(spark, sf))


MELT4 = f"{CLEAN}, m AS ({melted(4)}), rec AS (SELECT report_id, row_no, pdf_page, col_idx, c0 AS category, '' AS subcategory, volt AS voltage_level, CASE WHEN regexp_matches(c2, '^\\d{{4}}-\\d{{2}}$') THEN c2 END AS year, 'Rs/kWh' AS charge_unit, label, value FROM m WHERE value IS NOT NULL)"
MELT1 = f"{CLEAN}, m AS ({melted(1)})"
ORACLE_SQL = {
    "i1_header_labels": f"{CLEAN}, l AS (SELECT DISTINCT report_id FROM cl) " + " UNION ALL ".join(f"SELECT report_id, {i} AS col_idx, '{n}' AS label FROM l" for i, n in enumerate(LABELS)),
    "i2_wide_to_long": f"""{MELT4}, sg AS (SELECT c_mktsegment AS canonical, row_number() OVER (ORDER BY c_mktsegment) AS place FROM (SELECT DISTINCT c_mktsegment FROM customer)),
      nm AS (SELECT canonical, place * 2 AS priority FROM sg UNION ALL SELECT substr(canonical, 1, 3), place * 2 - 1 FROM sg WHERE place % 2 = 0),
      u AS (SELECT category, min_by(canonical, priority) AS utility FROM (SELECT DISTINCT category FROM rec) JOIN nm ON contains(lower(category), lower(canonical)) GROUP BY 1)
      SELECT rec.*, coalesce(u.utility, 'state_level') AS utility FROM rec LEFT JOIN u USING (category)""",
    "i3_wide_to_long_keyed": f"{KEYED} SELECT * FROM keyed",
    "i4_numeric_matrix": f"{MELT1} SELECT report_id, row_no, pdf_page, c0 AS row_label, label AS column_label, value FROM m WHERE value IS NOT NULL",
    "i5_year_anchored_rows": f"""{CLEAN}, y AS (SELECT *, list_filter([c3, c4, c5, c6, c7], lambda c: trim(c) <> '') AS a, last_value(nullif(c0, '') IGNORE NULLS) OVER (PARTITION BY report_id
      ORDER BY row_no) AS state,
      last_value(nullif(c1, '') IGNORE NULLS) OVER (PARTITION BY report_id ORDER BY row_no) AS utility FROM cl)
      SELECT report_id, row_no, pdf_page, state, utility, c2 AS year, {num('a[1]')} AS charge_1, a[2] AS unit_1, {num('a[3]')} AS charge_2, a[4] AS unit_2 FROM y
        WHERE {num('a[1]')} IS NOT NULL AND {num('a[3]')} IS NOT NULL""",
    "i6_drop_shadowed_aggregate": """WITH n AS (SELECT n_regionkey AS report_id, '2025-26' AS year, n_name AS utility, count(*) AS n FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2, 3)
      SELECT * FROM n UNION ALL SELECT report_id, year, 'state_level', t FROM (SELECT report_id, year, max(n) + CASE WHEN report_id % 2 = 0 THEN 0 ELSE 1 END AS t FROM n
        GROUP BY 1, 2) x
      WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.report_id = x.report_id AND n.year = x.year AND n.n = x.t)""",
    "i7_sectioned_values": rf"""{SECT}, c AS (SELECT s.report_id, s.row_no, s.is_section, s.c0, s.c1, l.c2, l.c4, l.c5, l.c6, l.c7, coalesce(last_value(nullif(s.c0, '') IGNORE NULLS) OVER (PARTITION BY s.report_id ORDER BY s.row_no), '') AS state,
        last_value(CASE WHEN is_section THEN s.c1 END IGNORE NULLS) OVER (PARTITION BY s.report_id ORDER BY s.row_no) AS section FROM se s
          JOIN cl l ON l.report_id = s.report_id AND l.row_no = s.row_no),
      v AS (SELECT *, list_filter([c0, c1, c4, c5, c6, c7], lambda x: trim(x) <> '' AND trim(x) <> state)[-1] AS raw FROM c WHERE NOT is_section)
      SELECT report_id, row_no, state, section, c2 AS year, raw, CASE WHEN lower(raw) IN ('n/a', '--') THEN NULL
        ELSE TRY_CAST(regexp_replace(raw, '[^\d.]', '', 'g') AS DOUBLE) END AS value FROM v WHERE raw IS NOT NULL AND state <> ''""",
    "i8_split_multi_value": """WITH t AS (SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity / 10 AS DECIMAL(10,2)) AS VARCHAR) AS a, CAST(CAST(l_quantity / 4 AS DECIMAL(10,2)) AS VARCHAR) AS b
      FROM lineitem),
      r AS (SELECT *, concat('Apr-Sep ', a, ' (Partial OA)', CASE WHEN l_linenumber % 2 = 0 THEN concat(' ', b, ' (Full OA)') ELSE '' END) AS raw FROM t)
      SELECT l_orderkey, l_linenumber, raw, 0 AS part, CAST(a AS DOUBLE) AS value, CASE WHEN l_linenumber % 2 = 0 THEN 'Partial OA' END AS qualifier FROM r
      UNION ALL SELECT l_orderkey, l_linenumber, raw, 1, CAST(b AS DOUBLE), 'Full OA' FROM r WHERE l_linenumber % 2 = 0""",
    "i9_parse_sentinel_number": "SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 0.0 WHEN 3 THEN CAST(l_quantity AS INT) + 0.5 WHEN 4 THEN CAST(CAST(l_quantity AS INT) AS DOUBLE) END AS value FROM lineitem",
    "i10_block_matrix": rf"""{CLEAN}, g AS (SELECT *, c0 = '' AND block_no % 2 = 1 AND row_no % 30 = 15 AS head, c0 = '' AND row_no % 20 = 0 AND NOT (block_no % 2 = 1 AND row_no % 30 = 15) AS line
      FROM bl WHERE block_no > 0),
      h AS (SELECT *, CASE WHEN line THEN CASE WHEN row_no % 40 = 0 THEN 'HT supply' WHEN row_no % 60 = 20 THEN '33 kV side' ELSE 'EHT' END WHEN head THEN ''
        WHEN row_no % 9 = 0 THEN concat('HT ', c2) WHEN row_no % 14 = 0 THEN concat('alt ', c2) ELSE c2 END AS category,
        last_value(CASE WHEN line THEN CASE WHEN row_no % 40 = 0 THEN 'HT' WHEN row_no % 60 = 20 THEN '33 kV' ELSE 'EHT' END WHEN NOT head AND row_no % 9 = 0
          AND coalesce({num("c4")}, {num("c5")}, {num("c6")}, {num("c7")}) IS NULL THEN 'HT' END IGNORE NULLS) OVER (PARTITION BY report_id, block_no ORDER BY row_no) AS v,
        min(CASE WHEN head THEN row_no END) OVER (PARTITION BY report_id, block_no) AS first_head FROM g),
      m AS (SELECT *, unnest([4, 5, 6, 7]) AS col_idx, unnest([c4, c5, c6, c7]) AS cell FROM h WHERE NOT line AND NOT head AND category <> ''),
      k AS (SELECT report_id, block_no, row_no, col_idx, state, category, c3 AS subcategory, CASE WHEN v IS NOT NULL THEN v WHEN row_no % 9 = 0 THEN 'HT'
        WHEN row_no % 14 = 0 THEN 'LT' ELSE 'all' END AS voltage_level, {num("cell")} AS value,
        CASE WHEN first_head IS NOT NULL THEN CASE WHEN col_idx <= 5 THEN 'Automobiles' ELSE concat('Customer#', lpad(CAST(first_head % 90 AS VARCHAR), 9, '0')) END
          ELSE CASE col_idx WHEN 4 THEN 'LT side' WHEN 5 THEN '2024-25 - new zone' WHEN 6 THEN 'Col 6' ELSE '2025-26 - Customer#000000003 - x' END END AS raw,
        CASE col_idx WHEN 6 THEN 'Rs/kW/month' ELSE 'Rs/kWh' END AS charge_unit, CASE col_idx WHEN 5 THEN '2024-25' WHEN 7 THEN '2025-26' ELSE '2023-24' END AS year FROM m),
      nm AS (SELECT lower(c_name) AS name, c_name AS canonical, c_mktsegment AS own, 1 AS tier, c_custkey AS priority FROM customer WHERE c_custkey % 3 = 0
        UNION ALL VALUES ('automob', 'Auto Power', NULL, 0, 0), ('00007', 'Seven Power', NULL, 0, 1), ('new zone', 'Zone Power', NULL, 0, 2)),
      u AS (SELECT state, raw, min_by(canonical, CASE WHEN tier = 1 AND own <> state THEN 2 ELSE tier END * 1000000000 + priority) AS canonical FROM (SELECT DISTINCT state,
        raw FROM k) JOIN nm ON contains(lower(raw), name) GROUP BY 1, 2)
      SELECT report_id, block_no, row_no, col_idx, k.state, coalesce(canonical, k.raw) AS utility, category, subcategory, voltage_level, value, charge_unit, year FROM k LEFT
        JOIN u ON u.state = k.state AND u.raw = k.raw WHERE value IS NOT NULL""",
    "i11_nearest_header_column": f"""{CLEAN}, m AS ({melted(4)}) SELECT report_id, row_no, col_idx, cell, CASE col_idx WHEN 4 THEN 'Col 3' WHEN 7 THEN '132 kV Charge' ELSE '11 kV Charge' END AS nearest_label FROM m""",
    "i12_simple_matrix": f"{MELT1} SELECT report_id, row_no, c0 AS category, label AS utility, value, 'Rs/kWh' AS charge_unit FROM m WHERE value IS NOT NULL",
    "i13_key_value": f"{CLEAN} SELECT report_id, row_no, c1 AS metric, {num('c4')} AS value, 'Rs/kWh' AS charge_unit FROM cl WHERE c1 <> '' AND {num('c4')} IS NOT NULL",
    "i14_narrative_hierarchy": f"""{SECT}, lb AS (SELECT *, CASE WHEN is_section THEN 's' WHEN c0 <> '' THEN 'master' WHEN c1 <> '' AND state <> '' THEN 'child' ELSE '' END AS lab FROM sf),
      n AS (SELECT *, sum(CASE WHEN lab = 'master' THEN 1 ELSE 0 END) OVER (PARTITION BY report_id ORDER BY row_no) AS seg FROM lb),
      o AS (SELECT report_id, row_no, is_section, last_value(CASE WHEN lab = 'master' THEN c0 END IGNORE NULLS) OVER (PARTITION BY report_id, seg ORDER BY row_no) AS category,
        coalesce(last_value(CASE WHEN lab = 'child' THEN c1 END IGNORE NULLS) OVER (PARTITION BY report_id, seg ORDER BY row_no), '') AS subcategory FROM n)
      SELECT report_id, row_no, category, subcategory, coalesce({num('c7')}, {num('c6')}, {num('c5')}, {num('c4')}) AS value FROM o JOIN cl USING (report_id, row_no)
      WHERE NOT is_section AND coalesce({num('c7')}, {num('c6')}, {num('c5')}, {num('c4')}) IS NOT NULL""",
    "i15_narrative_fill": f"""{CLEAN}, s AS (SELECT *, last_value(nullif(c0, '') IGNORE NULLS) OVER w AS st FROM cl WINDOW w AS (PARTITION BY report_id ORDER BY row_no)),
      g AS (SELECT *, sum(CASE WHEN c0 <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY report_id ORDER BY row_no) AS seg FROM s)
      SELECT report_id, row_no, st AS state, utility, charge, period, CAST(NULL AS VARCHAR) AS policy
        FROM (SELECT report_id, row_no, st, last_value(nullif(c1, '') IGNORE NULLS) OVER w AS utility, last_value(nullif(c4, '') IGNORE NULLS) OVER w AS charge,
        last_value(nullif(c6, '') IGNORE NULLS) OVER w AS period FROM g WINDOW w AS (PARTITION BY report_id, seg ORDER BY row_no)) WHERE utility IS NOT NULL""",
    "i16_append_continuations": f"""{CLEAN}, o AS (SELECT *, sum(CASE WHEN c1 <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY report_id ORDER BY row_no) AS record_no FROM cl)
      SELECT report_id, record_no, min(row_no) AS row_no, coalesce(string_agg(c6, chr(10) ORDER BY row_no) FILTER (c6 NOT IN ('', '-')), '') AS policy, count(*) AS lines
        FROM o WHERE record_no > 0 GROUP BY 1, 2""",
    "i17_inherit_parent_payload": f"""{CLEAN}, o AS (SELECT *, sum(CASE WHEN c1 <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY report_id ORDER BY row_no) AS g FROM cl)
      SELECT a.report_id, a.row_no, false AS is_parent, p.c1 AS owner, p.c4 AS charge, a.c2 AS year FROM o a JOIN o p ON a.report_id = p.report_id AND a.g = p.g
        AND p.c1 <> '' WHERE a.c1 = ''""",
    "i18_record_id": f"{MELT4} SELECT report_id, row_no, col_idx, substr(sha256(lower(concat_ws(':', 'wheeling', category, coalesce(year, ''), CAST(row_no AS VARCHAR), CAST(col_idx AS VARCHAR)))), 1, 16) AS record_id FROM rec",
    "i19_block_records_nested": f"""{CLEAN}, u AS (SELECT *, last_value(nullif(c1, '') IGNORE NULLS) OVER (PARTITION BY report_id, block_no ORDER BY row_no) AS utility FROM bl
      WHERE block_no > 0), m AS ({melted(4, 'u')})
      SELECT report_id, block_no, row_no, utility, label, cell AS raw FROM m""",
    "i19_nested_blocks": f"""{CLEAN}, g AS (SELECT *, block_no % 3 AS k, c0 <> '' AS begins FROM bl WHERE block_no > 0),
      h AS (SELECT report_id, block_no, row_no, k, list_filter(CASE WHEN k = 1 THEN CASE WHEN begins OR row_no % 23 = 0 THEN CASE
        WHEN row_no % 2 = 0 THEN ['Category', 'LT', 'HT', 'LT'] ELSE ['category', 'LT', 'HT'] END WHEN row_no % 10 = 0 THEN [concat('Section ', row_no)] ELSE [c2, c4, c5, c6] END
        WHEN k = 2 THEN CASE WHEN begins THEN ['Kind', c0, 'B'] ELSE [c2, c4, c5, c7] END ELSE CASE WHEN begins OR row_no % 31 = 0 THEN ['CATEGORY', concat('U', row_no)]
          ELSE [c2, c4] END END, lambda x: x <> '') AS c FROM g),
      m AS (SELECT *, CASE WHEN k = 2 THEN c[1] = 'Kind' ELSE lower(c[1]) = 'category' END AS head FROM h WHERE len(c) > 0),
      n AS (SELECT *, last_value(CASE WHEN head THEN c[2:] END IGNORE NULLS) OVER w AS cols, last_value(CASE WHEN k = 1
        AND len(c) = 1 THEN c[1] END IGNORE NULLS) OVER w AS section, last_value(CASE WHEN k = 0 AND head THEN c[2] END IGNORE NULLS) OVER (PARTITION BY report_id,
        block_no ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS utility
        FROM m WINDOW w AS (PARTITION BY report_id, block_no ORDER BY row_no)),
      e AS (SELECT report_id, block_no, k, section, row_no, c[1] AS category, cols[i] AS label, c[i + 1] AS value, row_number() OVER (PARTITION BY report_id, block_no, row_no,
        cols[i] ORDER BY i DESC) AS last
        FROM (SELECT *, unnest(range(1, least(len(cols), len(c) - 1) + 1)) AS i FROM n WHERE NOT head AND k > 0 AND (k = 2 OR section IS NOT NULL AND len(c) > 1)))
      SELECT report_id, block_no, CASE k WHEN 1 THEN 'matrix' ELSE 'simple_matrix' END AS parser_type, section, row_no, category, label, value FROM e WHERE last = 1
      UNION ALL SELECT report_id, block_no, 'key_value', NULL, row_no, c[1], utility, c[2] FROM n WHERE k = 0 AND NOT head AND len(c) >= 2""",
    "i20_parse_summary": f"""{MELT4} SELECT report_id, (SELECT count(*) FROM cl WHERE cl.report_id = r.report_id) AS rows_processed, count(*) AS record_count, count(DISTINCT row_no) AS rows_used, 'success' AS status FROM rec r GROUP BY report_id""",
    "i21_source_pages": f"{MELT4} SELECT report_id, year, array_to_string(list_sort(list(DISTINCT pdf_page)), ',') AS pages, min(row_no) AS first_row, max(row_no) AS last_row FROM rec GROUP BY 1, 2",
    "i22_classify_record_rows": f"{CLEAN} SELECT report_id, row_no, CASE WHEN c1 <> '' THEN 'record' ELSE 'continuation' END AS row_type, c4 <> '' AS has_charge, c6 NOT IN ('', '-') AS has_period FROM cl",
    "i23_group_members": f"""{CLEAN}, g AS (SELECT *, block_no AS group_no FROM bl WHERE block_no > 0)
      SELECT report_id, group_no, min_by(state, row_no) AS state, min_by(c1, row_no) AS master, coalesce(string_agg(c1, ',' ORDER BY row_no) FILTER (c1 <> ''
        AND c0 = ''), '') AS members, count(*) FILTER (c1 <> '' AND c0 = '') AS member_count FROM g GROUP BY 1, 2""",
    "i24_parent_or_child_values": f"{CLEAN} SELECT report_id, row_no, state, CASE WHEN c0 = '' THEN nullif(c1, '') END AS utility, {num('c4')} AS value FROM fl WHERE c0 <> '' OR c1 <> ''",
}
