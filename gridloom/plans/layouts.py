"""Queries of layouts, entities and headers (groups F, G and H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.fixtures import CELLS, grid_body, grid_rows, table
from gridloom.functions import text as tx
from gridloom.operators import entities as en
from gridloom.operators import headers as hd
from gridloom.operators import layouts as ly
from gridloom.plans.normalize import CLEAN, SECT, blocks, clean, labelled, states
from gridloom.sources.scratch import written

VOLTAGES = {"low tension": "LT", "lt": "LT", "high tension": "HT", "ht": "HT", "extra high tension": "EHT", "eht": "EHT"}
UNITS = {"rs/kwh": "Rs/kWh", "rs. / kwh": "Rs/kWh", "rs./kwh": "Rs/kWh", "rs/kw/month": "Rs/kW/month"}
CATEGORIES = {"automobile": "Industrial", "building": "Commercial", "furniture": "Commercial", "household": "Domestic", "ind": "Industrial"}


def values(spark, sf, *exprs):
    """Distinct values made from all line items, a shape for each line number; the last one, for the lines left, names the part."""
    li = table(spark, sf, "lineitem").select(F.col("l_quantity").cast("int").alias("q"), F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("m"), F.col("l_partkey").alias("p"))
    shape = F.expr(exprs[-1])
    for i, e in enumerate(exprs[:-1], 1):
        shape = F.when(F.col("n") == i, F.expr(e)).otherwise(shape)
    return li.select(shape.alias("value")).distinct()


def vsql(*pairs):
    """The same values for the oracle, with the result of each: (value, canonical, confidence, method)."""
    lines = [f"n = {i}" for i in range(1, len(pairs))] + [f"n >= {len(pairs)}"]
    rows = " UNION ".join(f"SELECT {v} AS value, {c} AS canonical, CAST({k} AS DOUBLE) AS confidence, {m} AS method FROM l WHERE {i}" for i, (v, c, k, m) in zip(lines, pairs))
    return f"WITH l AS (SELECT DISTINCT CAST(l_quantity AS INT) AS q, l_linenumber AS n, l_returnflag AS m, l_partkey AS p FROM lineitem) {rows}"


def g1(spark, sf):
    names = F.col("c_mktsegment")
    k = F.col("c_custkey") % 5
    shape = F.when(k == 0, names).when(k == 1, F.concat(names, F.lit("S"))).when(k == 2, "auto").when(k == 3, F.concat(F.lit("the "), names, F.lit(" zone"))).otherwise(F.concat(F.lit(" "), F.lower(names), F.lit("* ")))
    return table(spark, sf, "customer").select(shape.alias("value")).distinct()


def g2(spark, sf):
    from gridloom.sources.catalogs import names

    cust = names(table(spark, sf, "customer"), "c_name", F.col("c_custkey"), "utility")
    k = F.col("c_custkey") % 4
    v = table(spark, sf, "customer").select(F.when(k == 0, F.col("c_name")).when(k == 1, F.concat(F.lit("M/s "), "c_name", F.lit(" Ltd"))).when(k == 2, F.concat(F.lit("XYZ"), F.col("c_custkey").cast("string"), F.lit(" DISCOM"))).otherwise(F.col("c_custkey").cast("string")).alias("value"))
    return en.match_utility(v, cust, [r"(?i)\bdiscom\b"])


def g3(spark, sf):
    return en.match_voltage(values(spark, sf, "concat(q, ' kV')", "concat(q, ' volts')", "'High Tension'", "concat('new ht line ', m)", "m", "concat('at ', q, '.5kV')", "concat('feeder ', p, ' of 66 kV')"), VOLTAGES)


def g4(spark, sf):
    p = "lpad(CAST(q AS STRING), 2, '0')"
    return en.match_year(values(spark, sf, f"concat('20', {p}, '-17')", f"concat('20', {p}, '/18 x')", f"concat('FY ', {p}, '-19')", f"concat('in 20', {p})", "m", f"concat('FY 20', {p}, '-20')", "concat('lot ', p, ' FY 2024-25')"))


def g5(spark, sf):
    return en.match_unit(values(spark, sf, "'Rs/kWh'", "concat(q, ' %')", "concat(q, ' paise / kWh')", "m", "'Rs./kWh'", "concat('lot ', p, ' in percent')"), UNITS)


def g6(spark, sf):
    return en.match_category(values(spark, sf, "'Household'", "concat('large ind unit ', q)", "m", "'FURNITURE'", "concat('find ', q)", "concat('household no ', p)"), CATEGORIES)


PATTERNS = [r"(?i)\bdiscom\b"]


def recognized(triples, spark, sf, listed=None):
    """All six matchers on (value, header, state), with the segments as states and all customers, or those that are ``listed``, as utilities."""
    c = table(spark, sf, "customer")
    c = c if listed is None else c.where(listed)
    utilities = c.select(F.col("c_name").alias("canonical"), F.col("c_custkey").alias("priority"), F.col("c_mktsegment").alias("state"))
    return en.recognize_in_context(triples, states(spark, sf), utilities, PATTERNS, VOLTAGES, UNITS, CATEGORIES)


def g7(spark, sf):
    """A shape of value and header for each line number; the fourth has one for each return flag."""
    li = table(spark, sf, "lineitem").select(F.col("l_quantity").cast("int").alias("q"), F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("m"), F.col("l_partkey").alias("p"))
    two = F.lpad(F.col("q").cast("string"), 2, "0")
    text = F.col("q").cast("string")
    flag = lambda a, n, r: F.when(F.col("m") == "A", a).when(F.col("m") == "N", n).otherwise(r)
    value = F.when(F.col("n") == 1, F.concat(F.lit("20"), two, F.lit("-17"))).when(F.col("n") == 2, F.concat(text, F.lit(" kV"))).when(F.col("n") == 3, F.concat(text, F.lit(" %")))
    value = value.when(F.col("n") == 4, flag(F.concat(F.lit("Plant x"), text), F.concat(F.lit("Tariff x"), text), F.concat(F.lit("Customer#"), F.lpad(text, 9, "0"), F.lit(" Ltd"))))
    value = value.when(F.col("n") == 5, "Household").when(F.col("n") == 6, F.concat(F.lit("q"), text)).otherwise(F.concat(F.lit("feeder "), F.col("p").cast("string"), F.lit(" of 66 kV")))
    header = F.when(F.col("n") == 4, flag(F.lit("Utility"), F.lit("Consumer Tariff"), F.lit("Utility"))).when(F.col("n") == 6, "11 kV Charge").otherwise("Charge")
    return recognized(written(li.select(value.alias("value"), header.alias("header"), F.lit("BUILDING").alias("state")).distinct(), "triples"), spark, sf)


def g10(spark, sf):
    c = table(spark, sf, "customer")
    rows = c.select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.concat("c_name", F.lit(" - 2024-25"))).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("old acme "), F.col("c_custkey").cast("string"))).when(F.col("c_custkey") % 4 == 2, F.lower("c_name")).otherwise(F.concat(F.lit("Plain St "), F.col("c_custkey").cast("string"))).alias("utility"),
                    F.when(F.col("c_custkey") % 8 < 4, F.col("c_mktsegment")).otherwise("NONE").alias("state"))
    return en.canonicalize_utility(rows, [("acme", "ACME Power"), ("old", "Old Power")], c.select(F.col("c_name").alias("canonical"), F.col("c_mktsegment").alias("state")))


def features(spark, sf):
    return ly.table_features(labelled(spark, sf).drop("propagated"))


def classes(spark, sf):
    return ly.classify(ly.score_patterns(features(spark, sf)))


def f4(spark, sf):
    c = classes(spark, sf)
    r = F.col("report_id") % 4
    forced = c.select("report_id", F.when(r == 0, "key_value").alias("preset"), F.when(r == 1, "wide_table").alias("config"), F.when(r == 2, "numeric_matrix").alias("confirmed"))
    return ly.apply_pattern_overrides(c, forced)


def f5(spark, sf):
    """Bindings of a family, a parser or a pattern, classified parsers, and names that tell a family."""
    r = F.col("report_id")
    reports = grid_rows(spark, sf).select("report_id").distinct()
    bound = reports.where("report_id % 3 = 0").select(
        "report_id", F.when(r % 2 == 0, "narrative").alias("family"), F.when(r % 4 == 1, "kv_v1").when(r % 4 == 3, "gone").alias("parser_id"), F.when(r % 5 == 0, "wide_table").alias("bound_pattern")
    )
    parsers = spark.createDataFrame([("kv_v1", "key_value"), ("wide_v2", "wide_to_long")], "parser_id string, family string")
    name = F.when(r % 7 == 0, "wheeling").when(r % 7 == 1, "cross_subsidy").when(r % 7 == 2, "additional")
    pattern = F.when(r % 2 == 1, "unheard").otherwise(F.col("pattern"))
    classed = f4(spark, sf).withColumns({"pattern": pattern, "parser_id": F.when(r % 11 == 4, "wide_v2"), "name": name})
    return ly.route_parser(classed, bound, parsers=parsers, name="name")


def two_headers(spark, sf, most=None):
    """Merged grids under a header of two rows with spans, of three in every third report, which differs from report to report.

    With ``most``, only so many first rows of a grid are cleaned and written.
    """
    r = F.col("report_id")
    even = r % 2 == 0
    top = [F.when(r % 5 == 0, "").otherwise("State"), "Utility", F.when(even, "2024-25").otherwise("2025-26"), "", F.when(r % 4 < 3, "Charge (Rs/kWh)").otherwise("Surcharge %"), "", "Charge Rs/kW/month", ""]
    low = [F.when(r % 5 == 0, "State/UT").otherwise(""), "Utility", "Year", "-", "LT", F.when(even, "11 kV").otherwise("66 kV Tension"), "33 kV", ""]
    last = ["", "", "", "/", "slab", "", "", "net"]
    depth = F.when(r % 3 == 0, 3).otherwise(2)
    line = lambda cells: F.array(*[c if isinstance(c, F.Column) else F.lit(c) for c in cells])
    charge = F.transform("cells", lambda c, i: F.when((i == 4) & (c == ""), "1").otherwise(c))
    body = clean(spark, sf).select("report_id", (F.col("row_no") + depth).alias("row_no"), charge.alias("cells"))
    if most:
        # the first row of every grid is among them, so no report is lost
        body = written(body.where(F.col("row_no") <= most), "top")
    ids = body.select("report_id").distinct()
    rows = F.filter(F.array(line(top), line(low), line(last)), lambda x, i: i < depth)
    head = ids.select("report_id", F.posexplode(rows).alias("row_no", "cells")).withColumn("row_no", F.col("row_no") + 1)
    return head.unionByName(body)


def filled_headers(spark, sf):
    """Rows without labels have a header of ``MOST_HEADER_ROWS`` at most, and rows are numbered from 1, so it is all in the first ones."""
    rows = two_headers(spark, sf, hd.MOST_HEADER_ROWS)
    return hd.fill_header_spans(rows, hd.header_depth(rows))


def paths(spark, sf):
    return hd.header_paths(filled_headers(spark, sf))


def h5(spark, sf):
    """The grid, its columns and what its values mean are written once each and joined.

    The customers beyond the first whose key three does not divide are in no catalog, so some utilities are known by their header alone.
    """
    rows = written(two_headers(spark, sf), "grid")
    depths = hd.header_depth(rows)
    columns = written(hd.describe_columns(hd.header_paths(hd.fill_header_spans(rows, depths))), "columns")
    named = lambda values: en.match_state(written(values, "state-cells"), *states(spark, sf))
    cells = written(hd.cells_in_context(rows, columns, depths, named), "cells")
    found = written(recognized(written(hd.triples_of(cells), "triples"), spark, sf, listed="c_custkey % 3 = 0 OR c_custkey < 60"), "entities")
    return hd.annotate_cells(cells, found)


def h6(spark, sf):
    cells = clean(spark, sf).select("report_id", "row_no", F.posexplode("cells").alias("col_idx", "value"))
    kind = F.when(F.col("col_idx") == 2, "year").when(F.col("col_idx") == 1, "utility")
    return hd.annotated_numbers(cells, F.col("value"), kind).where("number IS NOT NULL").drop("value")


def headed_blocks(spark, sf):
    """Blocks whose first row names a category, with or without a row of one cell."""
    rows = blocks(spark, sf)
    head = F.col("block_no") % 3 != 0
    first = (F.get("cells", F.lit(0)) != "") & head
    single = (F.col("block_no") % 3 == 1) & (F.col("row_no") % 10 == 0) & ~first
    cells = F.when(first, F.array(F.lit("Consumer Category"), F.lit("LT"))).when(single, F.array(F.lit("HT"), F.lit(""))).otherwise(F.when(head, F.slice("cells", 3, 4)).otherwise(F.col("cells")))
    return rows.withColumn("cells", cells)


G1_SAME = "CASE WHEN c_custkey % 5 = 0 OR c_custkey % 5 = 4 THEN c_mktsegment"
QUERIES = {
    "f1_table_features": features,
    "f2_score_patterns": lambda s, d: ly.score_patterns(features(s, d)).drop("order"),
    "f3_classify": classes,
    "f4_apply_pattern_overrides": f4,
    "f5_route_parser": f5,
    "f6_block_layout": lambda s, d: ly.block_layout(headed_blocks(s, d)),
    "g1_match_state": lambda s, d: en.match_state(g1(s, d), *states(s, d)),
    "g1_match_state_ratio": lambda s, d: en.match_state(g1(s, d), *states(s, d), ratio=en.similarity_ratio),
    "g2_match_utility": g2,
    "g3_match_voltage": g3,
    "g4_match_year": g4,
    "g5_match_unit": g5,
    "g6_match_category": g6,
    "g7_recognize": g7,
    "g8_extract_unit": lambda s, d: values(s, d, "concat(q, ' Rs/kWh')", "concat(q, ' p/kWh')", "concat(q, ' Rs/MW/day')", "m", "concat(q, ' percent')", "concat('lot ', p, ' in Rs/kWh')").select("value", tx.extract_unit(F.col("value"), "none").alias("unit")),
    "g9_extract_voltage": lambda s, d: values(s, d, "concat(q, ' kV')", "concat('HT ', q, ' kV')", "concat('EHT ', q)", "m", "concat('Low Tension ', q)", "concat('right ', q)", "concat('line ', p, ' at 66 kV')").select("value", tx.extract_voltage(F.col("value")).alias("voltage")),
    "g10_canonicalize_utility": g10,
    "h1_header_depth": lambda s, d: hd.header_depth(two_headers(s, d)),
    "h2_fill_header_spans": filled_headers,
    "h3_header_paths": lambda s, d: paths(s, d).withColumn("header_path", F.array_join("header_path", " > ")),
    "h3_header_tree": lambda s, d: hd.header_tree(paths(s, d)),
    "h4_describe_columns": lambda s, d: hd.describe_columns(paths(s, d)),
    "h5_annotate_cells": h5,
    "h6_parse_number": h6,
}

DIGIT = " + ".join(f"CAST(regexp_matches({c}, '[0-9]') AS INT)" for c in CELLS[4:])
P = "lpad(CAST(q AS VARCHAR), 2, '0')"
HEADERS = CLEAN + r""", hr AS (SELECT report_id, CASE WHEN report_id % 3 = 0 THEN 3 ELSE 2 END AS d FROM (SELECT DISTINCT report_id FROM cl)),
hl AS (SELECT report_id, unnest([1, 2, 3]) AS row_no, unnest([
  [CASE WHEN report_id % 5 = 0 THEN '' ELSE 'State' END, 'Utility', CASE WHEN report_id % 2 = 0 THEN '2024-25' ELSE '2025-26' END, '', CASE
    WHEN report_id % 4 < 3 THEN 'Charge (Rs/kWh)' ELSE 'Surcharge %' END, '', 'Charge Rs/kW/month', ''],
  [CASE WHEN report_id % 5 = 0 THEN 'State/UT' ELSE '' END, 'Utility', 'Year', '-', 'LT', CASE WHEN report_id % 2 = 0 THEN '11 kV' ELSE '66 kV Tension' END, '33 kV', ''],
  ['', '', '', '/', 'slab', '', '', 'net']]) AS cells FROM hr),
gr AS (SELECT hl.report_id, row_no, cells FROM hl JOIN hr ON hl.report_id = hr.report_id AND row_no <= d
  UNION ALL SELECT cl.report_id, row_no + d, [c0, c1, c2, c3, CASE WHEN c4 = '' THEN '1' ELSE c4 END, c5, c6, c7] FROM cl JOIN hr ON cl.report_id = hr.report_id),
dp AS (SELECT report_id, CAST(greatest(1, coalesce(min(CASE WHEN row_no <= 5
  AND len(list_filter(cells, lambda c: TRY_CAST(regexp_replace(trim(c), '[,%]', '', 'g') AS DOUBLE) IS NOT NULL
    AND NOT (TRY_CAST(regexp_replace(trim(c), '[,%]', '', 'g') AS DOUBLE) BETWEEN 1990 AND 2100 OR contains(c, '-') OR contains(c, '/')))) > 0 THEN row_no END) - 1, least(5,
      count(*)))) AS INT) AS depth FROM gr GROUP BY 1),
hx AS (SELECT gr.report_id, row_no, CAST(unnest(range(0, 8)) AS INT) AS col_idx, nullif(trim(unnest(cells)), '') AS cell FROM gr JOIN dp ON gr.report_id = dp.report_id
  AND row_no <= depth),
hy AS (SELECT *, last_value(cell IGNORE NULLS) OVER (PARTITION BY report_id, row_no ORDER BY col_idx) AS lf FROM hx),
hz AS (SELECT *, min(CASE WHEN lf IS NOT NULL THEN row_no END) OVER (PARTITION BY report_id, col_idx) AS b FROM hy),
hf AS (SELECT report_id, row_no, col_idx, coalesce(last_value(CASE WHEN row_no = b THEN lf ELSE cell END IGNORE NULLS) OVER (PARTITION BY report_id, col_idx
  ORDER BY row_no), '') AS cell FROM hz),
hq AS (SELECT *, lag(cell) OVER (PARTITION BY report_id, col_idx ORDER BY row_no) AS p FROM hf WHERE cell NOT IN ('', '/', '\', '-')),
pt AS (SELECT k.report_id, k.col_idx, coalesce(list(cell ORDER BY row_no) FILTER (cell IS NOT NULL AND (p IS NULL OR p <> cell)), []) AS path FROM (SELECT DISTINCT report_id,
  col_idx FROM hf) k LEFT JOIN hq ON hq.report_id = k.report_id AND hq.col_idx = k.col_idx GROUP BY 1, 2),
ca AS (SELECT *, array_to_string(list_filter(list_transform(path, lambda x: regexp_replace(x, '^[\s/*+-]+|[\s/*+-]+$', '', 'g')), lambda x: x <> ''), ' - ') AS shown,
  array_to_string(path, ' ') AS t FROM pt),
cb AS (SELECT report_id, col_idx, path, CASE WHEN shown = '' THEN concat('Column ', col_idx)
  ELSE shown END AS display_name, nullif(regexp_extract(t, '\b20\d{2}-\d{2}\b'), '') AS year,
  CASE WHEN contains(lower(t), 'rs/kw/month') THEN 'Rs/kW/month' WHEN contains(t, '%') THEN '%' WHEN contains(lower(t), 'rs/kwh') THEN 'Rs/kWh' END AS unit FROM ca),
co AS (SELECT *, CASE WHEN col_idx = 0 AND regexp_matches(lower(display_name), '\bstate\b|union territory|\but\b') THEN 'state'
  WHEN regexp_matches(lower(display_name), 'utility|discom|licensee') THEN 'utility' WHEN regexp_matches(lower(display_name), 'voltage|kv|tension') THEN 'voltage'
  WHEN regexp_matches(lower(display_name), 'category|consumer') THEN 'category'
    WHEN unit IS NOT NULL OR year IS NOT NULL OR regexp_matches(lower(display_name), 'charge|value') THEN 'value' ELSE 'unknown' END AS role FROM cb)"""
LAB = SECT + """, ft AS (SELECT s.report_id, s.row_no, s.c0, s.c1, CASE WHEN is_section THEN '' ELSE l.c2 END AS c2, CASE WHEN is_section THEN '' ELSE l.c4 END AS c4, CASE
      WHEN is_section THEN '' ELSE l.c5 END AS c5,
  CASE WHEN is_section THEN '' ELSE l.c6 END AS c6, CASE WHEN is_section THEN '' ELSE l.c7 END AS c7,
  CASE WHEN is_section THEN 's' WHEN s.c0 <> '' THEN 'master' WHEN s.c1 <> '' AND state <> '' THEN 'child' WHEN s.c1 = '' AND rest <> '' AND state <> '' THEN 'continuation'
    ELSE 'data' END AS lab FROM sf s JOIN cl l ON l.report_id = s.report_id AND l.row_no = s.row_no)"""
F7 = ["c0", "c1", "c2", "c4", "c5", "c6", "c7"]


def total(test):
    return "sum(" + " + ".join(f"CAST({test.format(c=c)} AS INT)" for c in F7) + ")"


FEATURES = LAB + f""", fe AS (SELECT report_id, CAST(count(*) AS DOUBLE) AS row_count, 8.0 AS column_count, avg(CASE WHEN concat(c0, c1, c2, c4, c5, c6, c7) = '' THEN 1.0
      ELSE 0 END) AS empty_row_ratio,
  {total("regexp_matches({c}, '[0-9]')")} / (count(*) * 8.0) AS numeric_density, {total("regexp_matches({c}, '[a-zA-Z]')")} / (count(*) * 8.0) AS text_density, 8.0 AS average_cells_per_row,
  var_pop({" + ".join(f"CAST({c} <> '' AS INT)" for c in F7)}) AS row_length_variance, CAST(count(*) FILTER (lab = 'master') AS DOUBLE) AS state_name_occurrence,
  {total("regexp_matches(lower({c}), 'discom|utility|licensee| torrent|msedcl|guvnl|ugvcl|pgvcl|dgvcl|mgvcl|bescom|cesc|tpl')")} * 1.0 AS utility_name_occurrence,
  {total("regexp_matches(lower({c}), 'ht|lt|high tension|low tension|domestic|commercial|agriculture|industrial')")} * 1.0 AS section_keyword_occurrence,
  {total("regexp_matches({c}, '(?i)[0-9]+ *kv|voltage|volt')")} * 1.0 AS voltage_keyword_occurrence, {total("regexp_matches(lower({c}), 'tariff|charge|rate|cost|price|fee')")} * 1.0 AS tariff_keyword_occurrence,
  sum(CAST(c2 LIKE '20%' AS INT)) * 1.0 AS year_occurrence, CAST(count(*) FILTER (lab = 'continuation') AS DOUBLE) AS continuation_row_indicators, CAST(count(*) FILTER (c0 = ''
    AND c1 <> '') AS DOUBLE) AS indentation_indicators,
  CAST(count(*) FILTER (lab IN ('master', 'child')) AS DOUBLE) AS hierarchy_indicators, 0.125 AS empty_column_ratio, 0.0 AS repeated_header_indicators, 0.0 AS header_repetition_frequency,
  min_by((CAST(c0 = '' AS INT) + CAST(c1 = '' OR c1 = c0 AS INT) + CAST(c2 = '' OR c2 = c1 AS INT) + 1 + CAST(c4 = '' AS INT) + CAST(c5 = '' OR c5 = c4 AS INT) + CAST(c6 = '' OR c6 = c5 AS INT) + CAST(c7 = '' OR c7 = c6 AS INT)) / 8.0, row_no) AS merged_header_indicators
  FROM ft GROUP BY report_id)"""


def score_sql():
    parts = []
    for p, weights in ly.WEIGHTS.items():
        s = " + ".join(f"{f} * {w}" for f, w in weights.items())
        for q, f, sign, limit, points in ly.RULES:
            if q == p:
                s += f" + CASE WHEN {'abs(' + f + ' - ' + str(limit) + ') < 1e-6' if sign == '=' else f + ' ' + sign + ' ' + str(limit)} THEN {points} ELSE 0 END"
        parts.append(f"SELECT report_id, '{p}' AS pattern, {list(ly.WEIGHTS).index(p)} AS o, {s} AS score FROM fe")
    return " UNION ALL ".join(parts)


SCORES = f"{FEATURES}, sc AS ({score_sql()})"
CLASSES = SCORES + """, ce AS (SELECT *, exp(score - max(score) OVER (PARTITION BY report_id)) AS e FROM sc), cf AS (SELECT *, e / sum(e) OVER (PARTITION BY report_id) AS c FROM ce),
ck AS (SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY c DESC, o) AS k FROM cf),
cls AS (SELECT report_id, CASE WHEN max(c) FILTER (k = 1) < 0.3 THEN 'unknown' ELSE max(pattern) FILTER (k = 1) END AS pattern, max(c) FILTER (k = 1) AS confidence,
  max(pattern) FILTER (k = 2) AS runner_up, max(c) FILTER (k = 2) AS runner_up_confidence, max(c) FILTER (k = 1) < 0.6 AS needs_confirmation FROM ck GROUP BY 1),
fo AS (SELECT report_id, CASE report_id % 4 WHEN 0 THEN 'key_value' WHEN 1 THEN 'wide_table' WHEN 2 THEN 'numeric_matrix' ELSE pattern END AS pattern, CASE
  WHEN report_id % 4 < 3 THEN 1.0 ELSE confidence END AS confidence,
  CASE report_id % 4 WHEN 0 THEN 'config_override' WHEN 1 THEN 'config_override' WHEN 2 THEN 'user_confirmed' ELSE 'classifier' END AS routing_source FROM cls)"""
BAND = "CASE WHEN {q} < 11 THEN 'LT' WHEN {q} <= 33 THEN 'HT' ELSE 'EHT' END"
ORACLE_SQL = {
    "f1_table_features": f"{FEATURES} SELECT * FROM fe",
    "f2_score_patterns": f"{SCORES} SELECT report_id, pattern, score FROM sc",
    "f3_classify": f"{CLASSES} SELECT * FROM cls",
    "f4_apply_pattern_overrides": f"{CLASSES} SELECT * FROM fo",
    "f5_route_parser": f"""{CLASSES}, r AS (SELECT report_id AS r, CASE WHEN report_id % 2 = 1 THEN 'unheard' ELSE pattern END AS p FROM fo),
      s AS (SELECT r, p, [CASE WHEN r % 3 = 0 AND r % 2 = 0 THEN 'narrative' END, CASE WHEN r % 3 = 0 AND r % 4 = 1 THEN 'key_value' END, CASE WHEN r % 3 = 0
        AND r % 5 = 0 THEN 'wide_to_long' END, CASE WHEN r % 11 = 4 THEN 'wide_to_long' END,
        CASE p WHEN 'wide_table' THEN 'wide_to_long' WHEN 'hierarchical_parent_child' THEN 'narrative' WHEN 'unheard' THEN NULL WHEN 'unknown' THEN NULL ELSE p END, CASE r % 7
          WHEN 0 THEN 'wide_to_long' WHEN 1 THEN 'state_block_matrix' END, 'simple_matrix'] AS f FROM r)
      SELECT r AS report_id, p AS pattern, list_filter(f, lambda x: x IS NOT NULL)[1] AS family, list_filter(list_transform(['binding', 'bound_parser', 'bound_pattern', 'classified_parser', 'pattern', 'name', 'default'], lambda n, i: CASE WHEN f[i] IS NOT NULL THEN n END), lambda x: x IS NOT NULL)[1] AS step FROM s""",
    "f6_block_layout": f"""{CLEAN} SELECT report_id, block_no, CASE block_no % 3 WHEN 0 THEN 'key_value' WHEN 1 THEN CASE WHEN bool_or(c0 = '' AND (row_no % 10 = 0 OR len(list_filter([c2, c3, c4, c5],
      lambda x: x <> '')) = 1)) THEN 'matrix' ELSE 'simple_matrix' END
      ELSE CASE WHEN bool_or(c0 = '' AND len(list_filter([c2, c3, c4, c5], lambda x: x <> '')) = 1) THEN 'matrix' ELSE 'simple_matrix' END END AS layout FROM bl
        WHERE block_no > 0 GROUP BY 1, 2""",
    "g1_match_state": """WITH v AS (SELECT DISTINCT c_custkey % 5 AS k, c_mktsegment AS n FROM customer) SELECT DISTINCT CASE k WHEN 0 THEN n WHEN 1 THEN concat(n, 'S') WHEN 2 THEN 'auto'
      WHEN 3 THEN concat('the ', n, ' zone') ELSE concat(' ', lower(n), '* ') END AS value,
      CASE k WHEN 3 THEN NULL WHEN 2 THEN 'AUTOMOBILE' ELSE n END AS canonical, CASE k WHEN 1 THEN round_even((1 - 1.0 / (length(n) + 1)) * 0.9, 2) WHEN 3 THEN 0.0
        ELSE 1.0 END AS confidence,
      CASE k WHEN 1 THEN 'fuzzy' WHEN 2 THEN 'alias' WHEN 3 THEN NULL ELSE 'exact' END AS method FROM v""",
    "g2_match_utility": """WITH v AS (SELECT DISTINCT c_custkey % 4 AS k, c_name, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN concat('M/s ', c_name, ' Ltd')
      WHEN 2 THEN concat('XYZ', c_custkey, ' DISCOM') ELSE CAST(c_custkey AS VARCHAR) END AS value FROM customer),
      p AS (SELECT value, min_by(n.c_name, n.c_custkey) AS name FROM v JOIN customer n ON k = 3 AND length(value) >= 4 AND contains(lower(n.c_name), value) GROUP BY value)
      SELECT value, CASE k WHEN 2 THEN value WHEN 3 THEN name ELSE c_name END AS canonical, CAST(CASE k WHEN 0 THEN 1.0 WHEN 1 THEN 0.9 WHEN 2 THEN 0.6 ELSE CASE
        WHEN name IS NULL THEN 0.0 ELSE 0.9 END END AS DOUBLE) AS confidence,
      CASE k WHEN 0 THEN 'exact' WHEN 1 THEN 'substring' WHEN 2 THEN 'regex' ELSE CASE WHEN name IS NOT NULL THEN 'substring' END END AS method FROM v LEFT JOIN p USING (value)""",
    "g3_match_voltage": "SELECT value, canonical, confidence, method, CASE WHEN canonical LIKE '% kV' THEN " + BAND.format(q="TRY_CAST(regexp_extract(canonical, '^[0-9.]+') AS DOUBLE)") + " WHEN canonical LIKE '% V' THEN 'LT' ELSE canonical END AS band FROM (" + vsql(("concat(q, ' kV')", "concat(q, ' kV')", 0.95, "'kv'"), ("concat(q, ' volts')", "concat(q, ' V')", 0.9, "'volt'"), ("'High Tension'", "'HT'", 1.0, "'alias'"), ("concat('new ht line ', m)", "'HT'", 0.8, "'word'"), ("m", "NULL", 0.0, "NULL"), ("concat('at ', q, '.5kV')", "concat(q, '.5 kV')", 0.95, "'kv'"), ("concat('feeder ', p, ' of 66 kV')", "'66 kV'", 0.95, "'kv'")) + ")",
    "g4_match_year": vsql((f"concat('20', {P}, '-17')", f"concat('20', {P}, '-17')", 1.0, "'fy_dash'"), (f"concat('20', {P}, '/18 x')", f"concat('20', {P}, '-18')", 0.95, "'fy_slash'"), (f"concat('FY ', {P}, '-19')", f"concat('20', {P}, '-19')", 0.9, "'fy_short'"), (f"concat('in 20', {P})", f"concat('20', {P})", 0.85, "'calendar'"), ("m", "NULL", 0.0, "NULL"), (f"concat('FY 20', {P}, '-20')", f"concat('20', {P}, '-20')", 1.0, "'fy_dash'"), ("concat('lot ', p, ' FY 2024-25')", "'2024-25'", 1.0, "'fy_dash'")),
    "g5_match_unit": vsql(("'Rs/kWh'", "'Rs/kWh'", 1.0, "'alias'"), ("concat(q, ' %')", "'%'", 0.95, "'percent'"), ("concat(q, ' paise / kWh')", "'paise/kWh'", 0.85, "'regex'"), ("m", "NULL", 0.0, "NULL"), ("'Rs./kWh'", "'Rs/kWh'", 1.0, "'alias'"), ("concat('lot ', p, ' in percent')", "'%'", 0.95, "'percent'")),
    "g6_match_category": vsql(("'Household'", "'Domestic'", 1.0, "'alias'"), ("concat('large ind unit ', q)", "'Industrial'", 0.9, "'word'"), ("m", "NULL", 0.0, "NULL"), ("'FURNITURE'", "'Commercial'", 1.0, "'alias'"), ("concat('find ', q)", "NULL", 0.0, "NULL"), ("concat('household no ', p)", "'Domestic'", 0.9, "'word'")),
    "g7_recognize": f"""WITH l AS (SELECT DISTINCT CAST(l_quantity AS INT) AS q, l_linenumber AS n, l_returnflag AS m, l_partkey AS p FROM lineitem),
      v AS (SELECT DISTINCT CASE n WHEN 1 THEN concat('20', {P}, '-17') WHEN 2 THEN concat(q, ' kV') WHEN 3 THEN concat(q, ' %') WHEN 4 THEN CASE m
        WHEN 'A' THEN concat('Plant x', q) WHEN 'N' THEN concat('Tariff x', q) ELSE concat('Customer#', lpad(CAST(q AS VARCHAR), 9, '0'), ' Ltd') END
        WHEN 5 THEN 'Household' WHEN 6 THEN concat('q', q) ELSE concat('feeder ', p, ' of 66 kV') END AS value, CASE WHEN n = 4 THEN CASE WHEN m = 'N' THEN 'Consumer Tariff'
          ELSE 'Utility' END WHEN n = 6 THEN '11 kV Charge' ELSE 'Charge' END AS header, q, n, m FROM l)
      SELECT DISTINCT value, header, 'BUILDING' AS state, CASE n WHEN 1 THEN 'year' WHEN 3 THEN 'unit' WHEN 4 THEN CASE m WHEN 'N' THEN 'category' ELSE 'utility' END
        WHEN 5 THEN 'state' ELSE 'voltage' END AS entity_type,
      CASE n WHEN 1 THEN value WHEN 2 THEN value WHEN 3 THEN '%' WHEN 4 THEN CASE m WHEN 'R' THEN left(value, 18) ELSE value END WHEN 5 THEN 'HOUSEHOLD' WHEN 6 THEN '11 kV'
        ELSE '66 kV' END AS canonical,
      CAST(CASE n WHEN 1 THEN 1 WHEN 4 THEN CASE m WHEN 'A' THEN 0.5 WHEN 'N' THEN 0.75 ELSE 0.9 END WHEN 5 THEN 1 WHEN 6 THEN 0.7 ELSE 0.95 END AS DOUBLE) AS confidence,
      CASE n WHEN 1 THEN 'fy_dash' WHEN 3 THEN 'percent' WHEN 4 THEN CASE m WHEN 'R' THEN 'substring' ELSE 'header' END WHEN 5 THEN 'exact' WHEN 6 THEN 'header'
        ELSE 'kv' END AS method FROM v""",
    "g8_extract_unit": "SELECT value, canonical AS unit FROM (" + vsql(("concat(q, ' Rs/kWh')", "'Rs/kWh'", 0, "''"), ("concat(q, ' p/kWh')", "'paise/kWh'", 0, "''"), ("concat(q, ' Rs/MW/day')", "'Rs/MW/day'", 0, "''"), ("m", "'none'", 0, "''"), ("concat(q, ' percent')", "'%'", 0, "''"), ("concat('lot ', p, ' in Rs/kWh')", "'Rs/kWh'", 0, "''")) + ")",
    "g9_extract_voltage": "SELECT value, canonical AS voltage FROM (" + vsql(("concat(q, ' kV')", "concat(q, ' kV')", 0, "''"), ("concat('HT ', q, ' kV')", "concat('HT - ', q, ' kV')", 0, "''"), ("concat('EHT ', q)", "'EHT'", 0, "''"), ("m", "'all'", 0, "''"), ("concat('Low Tension ', q)", "'LT'", 0, "''"), ("concat('right ', q)", "'all'", 0, "''"), ("concat('line ', p, ' at 66 kV')", "'66 kV'", 0, "''")) + ")",
    "g10_canonicalize_utility": """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN concat('old acme ', c_custkey) WHEN 2 THEN lower(c_name) ELSE concat('Plain St ',
      c_custkey) END AS utility, CASE WHEN c_custkey % 8 < 4 THEN c_mktsegment ELSE 'NONE' END AS state,
      CASE c_custkey % 4 WHEN 1 THEN 'ACME Power' WHEN 3 THEN concat('Plain St ', c_custkey) ELSE c_name END AS canonical,
      CASE WHEN c_custkey % 4 = 1 THEN 'alias' WHEN c_custkey % 4 = 3 THEN 'as_is' WHEN c_custkey % 8 < 4 THEN 'state' ELSE 'catalog' END AS step FROM customer""",
    "h1_header_depth": f"{HEADERS} SELECT report_id, depth FROM dp",
    "h2_fill_header_spans": f"{HEADERS} SELECT report_id, row_no, col_idx, cell FROM hf",
    "h3_header_paths": f"{HEADERS} SELECT report_id, col_idx, array_to_string(path, ' > ') AS header_path FROM pt",
    "h3_header_tree": f"""{HEADERS}, pf AS (SELECT report_id, col_idx, array_to_string(path[1:k], ' > ') AS prefix FROM (SELECT *, unnest(range(1, len(path) + 1)) AS k FROM pt))
      SELECT report_id, prefix, string_agg(DISTINCT CAST(col_idx AS VARCHAR), ',' ORDER BY CAST(col_idx AS VARCHAR)) AS columns FROM pf GROUP BY 1, 2""",
    "h4_describe_columns": f"""{HEADERS} SELECT report_id, col_idx, display_name, year, unit, CASE WHEN len(path) > 1 THEN regexp_replace(path[1], '^[\\s/*+-]+|[\\s/*+-]+$', '', 'g') END AS "group", role,
      CASE WHEN role = 'value' THEN CASE WHEN unit = '%' THEN 'percentage' ELSE 'charge' END ELSE role END AS entity_type FROM co""",
    "h5_annotate_cells": f"""{HEADERS}, x AS (SELECT gr.report_id, row_no, row_no <= depth AS head, cells[1] AS own, CAST(unnest(range(0, 8)) AS INT) AS col_idx, trim(unnest(cells)) AS v FROM gr
      JOIN dp ON gr.report_id = dp.report_id),
      sg AS (SELECT DISTINCT c_mktsegment AS g FROM customer), ul AS (SELECT * FROM customer WHERE c_custkey % 3 = 0 OR c_custkey < 60),
      ne AS (SELECT nv, nown, min_by(c_name, c_custkey) AS near FROM (SELECT DISTINCT v AS nv, own AS nown FROM x WHERE NOT head AND length(v) BETWEEN 1 AND 3)
        JOIN ul ON c_mktsegment = nown AND contains(lower(c_name), lower(nv)) GROUP BY 1, 2),
      y AS (SELECT x.*, near, role, co.unit AS cu, display_name, TRY_CAST(regexp_extract(v, '[-+]?\\d+(?:\\.\\d+)?') AS DOUBLE) AS n, nullif(regexp_extract(lower(display_name), '\\b(\\d+)\\s*kv\\b', 1), '') AS kv, v IN (SELECT c_name FROM ul) AS listed, regexp_matches(v, '^20\\d{{2}}-\\d{{2}}$') AS fy FROM x JOIN co ON co.report_id = x.report_id AND co.col_idx = x.col_idx LEFT JOIN ne ON nv = v AND nown = own),
      z AS (SELECT *, CASE WHEN head THEN 'header' WHEN v IN ('', 'N/A', '-') THEN 'empty' WHEN v IN (SELECT g FROM sg) THEN 'state' WHEN fy THEN 'year'
        WHEN v LIKE 'Customer#%' OR near IS NOT NULL THEN 'utility' WHEN contains(v, 'Rs/kWh') THEN 'unit' WHEN kv IS NOT NULL AND length(v) < 5 THEN 'voltage'
        WHEN n IS NULL THEN 'unknown' WHEN role = 'voltage' THEN 'voltage' WHEN role = 'value' AND cu = '%' THEN 'percentage' ELSE 'charge' END AS a FROM y)
      SELECT report_id, row_no, col_idx, a AS annotation, CASE WHEN a = 'empty' THEN NULL WHEN a = 'unit' THEN 'Rs/kWh' WHEN a = 'utility' THEN coalesce(near, v)
        WHEN a = 'voltage' THEN CASE WHEN length(v) < 5 THEN concat(kv, ' kV') ELSE concat(CAST(n AS BIGINT), ' kV') END ELSE v END AS canonical,
      CAST(CASE WHEN a IN ('header', 'empty', 'state', 'year') THEN 1 WHEN a = 'utility' THEN CASE WHEN near IS NOT NULL THEN 0.85 WHEN listed THEN 1 ELSE 0.5 END
        WHEN a = 'unit' THEN 0.85 WHEN a = 'voltage' AND length(v) < 5 THEN 0.7 WHEN a = 'unknown' THEN 0 ELSE 0.95 END AS DOUBLE) AS confidence,
      CASE WHEN a IN ('unit', 'charge', 'percentage', 'unknown') THEN n END AS number, CASE WHEN a = 'percentage' THEN '%'
        WHEN a = 'charge' THEN coalesce(cu, 'Rs/kWh') END AS unit, display_name AS context, CASE WHEN NOT head AND own <> '' THEN own END AS state FROM z""",
    "h6_parse_number": f"""{CLEAN}, x AS (SELECT report_id, row_no, unnest([c0, c3, c4, c5, c6, c7]) AS v, unnest([0, 3, 4, 5, 6, 7]) AS col_idx FROM cl) SELECT report_id, row_no, col_idx, TRY_CAST(regexp_extract(v, '[-+]?\\d+(?:\\.\\d+)?') AS DOUBLE) AS number FROM x WHERE TRY_CAST(regexp_extract(v, '[-+]?\\d+(?:\\.\\d+)?') AS DOUBLE) IS NOT NULL""",
}
