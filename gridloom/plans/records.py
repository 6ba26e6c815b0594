"""Queries of checks, export, search, incremental runs and stored records (groups J, K, L, M and A4-A7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.fixtures import WITH_PAGES, dealt, report_pages, table
from gridloom.operators import export as kx
from gridloom.operators import incremental as inc
from gridloom.operators import quality as ql
from gridloom.operators import search as sr
from gridloom.plans.index import WITH_INDEX, WITH_TITLES
from gridloom.plans.normalize import CLEAN, blocks, clean
from gridloom.sources import writers
from gridloom.sources.scratch import new_path, written

FIELDS = ["state", "utility", "year", "unit"]


def facts(spark, sf):
    """Line items as charge records: parameter = flag and status, state = segment, utility = customer."""
    li, o, c = (table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    state = F.when(k % 31 == 0, "").when(k % 37 == 0, F.concat("c_mktsegment", F.lit("X"))).otherwise(F.col("c_mktsegment"))
    utility = F.when(k % 41 == 0, "state_level").when(k % 53 == 0, "Col 3").when(k % 59 == 0, "N/A").otherwise(F.col("c_name"))
    n = o.count()
    ordered = dealt(dealt(li, n, "l_orderkey").join(o, F.expr("l_orderkey = o_orderkey")), n, "o_custkey")
    return ordered.join(c, F.expr("o_custkey = c_custkey")).select(
        F.concat("l_returnflag", "l_linestatus").alias("parameter_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), (F.col("l_linenumber") % 5).cast("string")).alias("record_id"),
        state.alias("state"), utility.alias("utility"),
        F.concat(F.lit("20"), F.lpad((F.col("l_orderkey") % 20 + 10).cast("string"), 2, "0")).alias("year"),
        F.when(F.col("l_linenumber") < 6, "Rs/kWh").alias("unit"),
        F.when(k % 43 != 0, F.col("l_quantity").cast("double") * 25).alias("value"),
        F.array((F.col("l_linenumber") * 2).cast("int"), (F.col("l_linenumber") * 2 + 1).cast("int")).alias("pages"),
        ((F.col("l_quantity").cast("double") % 10) / 10).alias("confidence"),
    )


FACTS = """WITH f0 AS (SELECT *, l_orderkey * 7 + l_linenumber AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
facts AS (SELECT concat(l_returnflag, l_linestatus) AS parameter_id, concat(l_orderkey, '-', l_linenumber % 5) AS record_id,
  CASE WHEN k % 31 = 0 THEN '' WHEN k % 37 = 0 THEN concat(c_mktsegment, 'X') ELSE c_mktsegment END AS state,
  CASE WHEN k % 41 = 0 THEN 'state_level' WHEN k % 53 = 0 THEN 'Col 3' WHEN k % 59 = 0 THEN 'N/A' ELSE c_name END AS utility,
  concat('20', lpad(CAST(l_orderkey % 20 + 10 AS VARCHAR), 2, '0')) AS year, CASE WHEN l_linenumber < 6 THEN 'Rs/kWh' END AS unit,
  CASE WHEN k % 43 <> 0 THEN CAST(l_quantity AS DOUBLE) * 25 END AS value, concat(l_linenumber * 2, ',', l_linenumber * 2 + 1) AS pages,
    (CAST(l_quantity AS DOUBLE) % 10) / 10 AS confidence FROM f0),
seg AS (SELECT DISTINCT c_mktsegment AS canonical, lower(c_mktsegment) AS alias FROM customer)"""


def placed_facts(spark, sf):
    """The records with their place in the order of orders and lines."""
    order, line = (F.split("record_id", "-")[i].cast("long") for i in (0, 1))
    return facts(spark, sf).withColumn("position", order * 8 + line)


def segments(spark, sf):
    return table(spark, sf, "customer").select(F.lower("c_mktsegment").alias("alias"), F.col("c_mktsegment").alias("canonical")).distinct()


def sixth(spark, sf):
    """A sixth of all line items: some of the six parameters have fewer."""
    return table(spark, sf, "lineitem").count() // 6


def checks(spark, sf):
    f = facts(spark, sf)
    return ql.union([ql.check_required(f, ["state", "unit"]), ql.check_duplicate_ids(f), ql.check_range(f, "value"), ql.check_min_records(f, sixth(spark, sf))])


CHECKS = FACTS + """, checks AS (SELECT parameter_id, 'required.state' AS rule_id, 'error' AS severity, count(*) FILTER (state = '') = 0 AS passed, CAST(count(*) FILTER (state = '') AS DOUBLE) AS metric FROM facts GROUP BY 1
UNION ALL SELECT parameter_id, 'required.unit', 'error', count(*) FILTER (unit IS NULL) = 0, CAST(count(*) FILTER (unit IS NULL) AS DOUBLE) FROM facts GROUP BY 1
UNION ALL SELECT parameter_id, 'duplicate_id', 'error', sum(n) = 0, CAST(sum(n) AS DOUBLE) FROM (SELECT parameter_id, record_id, count(*) - 1 AS n FROM facts
  GROUP BY 1, 2) GROUP BY 1
UNION ALL SELECT parameter_id, 'range.value', 'warning', count(*) FILTER (value NOT BETWEEN 0 AND 1000) = 0, CAST(count(*) FILTER (value NOT BETWEEN 0 AND 1000) AS DOUBLE)
  FROM facts GROUP BY 1
UNION ALL SELECT parameter_id, 'min_records', 'error', count(*) >= (SELECT count(*) FROM lineitem) // 6, CAST(count(*) AS DOUBLE) FROM facts GROUP BY 1),
reports AS (SELECT parameter_id, count(*) FILTER (NOT passed AND severity = 'error') AS errors, count(*) FILTER (NOT passed AND severity = 'warning') AS warnings,
  count(*) AS checks,
  count(*) FILTER (NOT passed AND severity = 'error') = 0 AS passed, count(*) FILTER (NOT passed AND severity = 'error') <= 3 AND count(*) FILTER (NOT passed
    AND severity = 'warning') <= 5 AS export_allowed FROM checks GROUP BY 1),
lp AS (SELECT parameter_id, record_id, CAST(split_part(record_id, '-', 1) AS BIGINT) * 8 + CAST(split_part(record_id, '-', 2) AS BIGINT) AS n FROM facts),
la AS (SELECT parameter_id, n // 1024 AS n, sha256(string_agg(record_id, '' ORDER BY n, record_id)) AS part FROM lp GROUP BY parameter_id, lp.n // 1024),
lb AS (SELECT parameter_id, n // 1024 AS n, sha256(string_agg(part, '' ORDER BY n)) AS part FROM la GROUP BY parameter_id, la.n // 1024),
lc AS (SELECT parameter_id, n // 1024 AS n, sha256(string_agg(part, '' ORDER BY n)) AS part FROM lb GROUP BY parameter_id, lb.n // 1024),
lineage AS (SELECT parameter_id, sha256(string_agg(part, '' ORDER BY n)) AS lineage_hash FROM lc GROUP BY 1)"""


def reports(spark, sf):
    """Reports that allow export with at most three errors."""
    return ql.validation_report(checks(spark, sf), max_errors=3)


def one(rule, severity, n, passed=None):
    passed = passed or f"{n} = 0"
    return f"{FACTS} SELECT parameter_id, '{rule}' AS rule_id, '{severity}' AS severity, {passed} AS passed, CAST({n} AS DOUBLE) AS metric FROM facts GROUP BY 1"


def queries_table(spark, sf):
    """Requests that name a nation of a benchmark-like word list."""
    n = table(spark, sf, "nation")
    text = F.concat(F.lit("show me the charges of "), F.when(F.col("n_nationkey") % 5 == 0, "nobody").otherwise(F.col("n_name")), F.lit(" for supplier "), F.col("n_regionkey").cast("string"))
    return n.select(F.col("n_nationkey").alias("query_id"), text.alias("query"))


def supplier_records(spark, sf):
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.expr("s_nationkey = n_nationkey"))
    return s.select(F.col("n_name").alias("group"), F.col("s_suppkey").alias("position"), F.concat_ws(" ", "s_name", "n_name").alias("search_text"))


def grouped(spark, sf):
    return sr.detect_query_group(queries_table(spark, sf), table(spark, sf, "nation").select(F.col("n_name").alias("group")))


def keyed(spark, sf):
    return sr.query_keywords(grouped(spark, sf))


QWORDS = r"""WITH q0 AS (SELECT n_nationkey AS query_id, CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS "group", concat('show me the charges of ', CASE
      WHEN n_nationkey % 5 = 0 THEN 'nobody' ELSE n_name END, ' for supplier ', n_regionkey) AS query FROM nation),
qb AS (SELECT q0.query_id, q0.query, max_by(n_name, length(n_name)) AS g FROM q0 LEFT JOIN nation ON contains(lower(query), lower(n_name)) GROUP BY 1, 2),
qk AS (SELECT query_id, query, g AS "group", list_filter(regexp_extract_all(CASE WHEN g IS NULL THEN lower(query) ELSE replace(lower(query), lower(g), ' ') END, '[a-z0-9]+'),
  lambda w: NOT list_contains(['extract','show','find','get','what','is','the','charges','charge','open','access','for','of','in'], w)) AS kw FROM qb),
rs AS (SELECT n_name AS "group", s_suppkey AS position, lower(regexp_replace(concat_ws(' ', s_name, n_name), '[^A-Za-z0-9]+', ' ', 'g')) AS t FROM supplier
  JOIN nation ON s_nationkey = n_nationkey),
sc AS (SELECT query_id, position, len(list_filter(kw, lambda w: contains(t, w))) AS score FROM qk JOIN rs USING ("group"))"""


def stored(spark, sf, name, write):
    """A new path in the folder that driver and executors share, written."""
    path = new_path(spark, name)
    write(path)
    return path


def a4_records_round_trip(spark, sf):
    from gridloom.sources.readers import read_records

    f = facts(spark, sf).drop("pages")
    path = stored(spark, sf, "records", lambda p: writers.write_records(f, p))
    return read_records(spark, path, f.schema)


def a6_write_warehouse(spark, sf):
    f = facts(spark, sf).select("parameter_id", "record_id", "state", "value")
    path = stored(spark, sf, "warehouse", lambda p: writers.write_warehouse(f, p))
    return spark.read.parquet(path).select("parameter_id", "record_id", "state", "value")


def a7_write_by_group(spark, sf):
    """Written twice, the second time with a part of the groups only, and read back."""
    f = facts(spark, sf).withColumn("name", F.concat(F.lit("State: "), "state", F.lit(" [all of it, and some more]")))
    path = new_path(spark, "groups")
    for part in (f, f.where(F.col("state").startswith("B"))):
        writers.write_by_group(part, path, "name", ["state", "utility", "value"], rows_per_file=1000)
    return spark.read.option("recursiveFileLookup", False).parquet(path).select("sheet", "state", "utility", "value")


def m1_changed_inputs(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("content_hash"))
    known = d.where("doc_id % 2 = 0").withColumn("content_hash", F.when(F.col("doc_id") % 10 == 0, F.lit("old")).otherwise(F.col("content_hash")))
    return inc.changed_inputs(d, known, ["doc_id"]).select("doc_id")


def m2_invalidate_downstream(spark, sf):
    o = table(spark, sf, "orders")
    status = o.select(F.col("o_orderkey").alias("report_id"), F.explode(F.sequence(F.lit(1), F.lit(8))).alias("stage_no")).withColumn("status", F.lit("complete"))
    changed = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("report_id"), (F.col("o_custkey") % 8 + 1).cast("int").alias("stage_no"))
    return inc.invalidate_downstream(status, changed)


def stage_hash(changed):
    n = F.col("report_id") + F.col("stage_no") * 7 + F.coalesce("parameter_id", F.lit(0))
    return F.when(F.lit(changed) & (n % 11 == 0), F.concat(F.lit("new"), n.cast("string"))).otherwise(n.cast("string"))


def stages(spark, sf):
    """Three stages of every order and three of each of its lines, with the day they ended."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("report_id"), F.lit(None).cast("int").alias("parameter_id"), F.col("o_orderdate").alias("day"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("stage_no"))
    li = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_shipdate").alias("day"))
    li = li.select(F.col("l_orderkey").alias("report_id"), F.col("l_linenumber").cast("int").alias("parameter_id"), "day", F.explode(F.sequence(F.lit(4), F.lit(6))).alias("stage_no"))
    ended = F.date_add(F.col("day").cast("date"), (F.col("stage_no") * 5 + F.col("report_id") % 9).cast("int"))
    return o.unionByName(li).select("report_id", "parameter_id", "stage_no", ended.alias("completed_at"))


def m1_stale_stages(spark, sf):
    s = stages(spark, sf)
    current = s.select("report_id", "parameter_id", "stage_no").withColumn("input_hash", stage_hash(True))
    ran = s.where("(report_id + stage_no) % 13 <> 0").withColumn("input_hash", stage_hash(False))
    return inc.stale_stages(current, ran)


def m2_invalidate_scoped(spark, sf):
    s = stages(spark, sf).select("report_id", "parameter_id", "stage_no").withColumn("status", F.lit("complete"))
    return inc.invalidate_downstream(s, s.where("(report_id * 3 + stage_no * 5 + coalesce(parameter_id, 0)) % 17 = 0"))


def m3_stream_whole_index(spark, sf):
    """Three deliveries that overlap, tables before and after their pages, then a row that only tells the time; equals the batch index."""
    from gridloom.streaming.pages import whole_index_available

    at = lambda minutes: F.timestamp_seconds(F.lit(1_700_000_000 + 60 * minutes)).alias("arrived")
    # numbering the pages takes a window over a source, so they are written before they are delivered
    pages = written(report_pages(spark, sf).select("report_id", "pdf_page", "page_text"), "pages")
    tables = pages.where("pdf_page % 3 = 0").select("report_id", "pdf_page", F.lit(1).alias("table_idx"))
    pause = pages.select(F.lit(None).cast("string").alias("report_id"), F.lit(0).alias("pdf_page"), F.lit("").alias("page_text"), at(3000)).limit(1)
    root = new_path(spark, "stream")
    for k, minutes in enumerate((0, 25, 50)):
        late = F.col("pdf_page") % 3 == k
        pages.where(late | (F.col("pdf_page") % 4 == k)).select("*", at(minutes)).write.parquet(f"{root}/pages/{k}")
        tables.where((F.col("pdf_page") % 9 == 3 * k) | (F.col("pdf_page") % 2 == k % 2)).select("*", at(minutes)).write.parquet(f"{root}/tables/{k}")
        whole_index_available(spark, f"{root}/pages/*", f"{root}/tables/*", f"{root}/out", f"{root}/state")
    pause.write.parquet(f"{root}/pages/end")
    pause.select("report_id", "pdf_page", F.lit(0).alias("table_idx"), "arrived").write.parquet(f"{root}/tables/end")
    whole_index_available(spark, f"{root}/pages/*", f"{root}/tables/*", f"{root}/out", f"{root}/state")
    return spark.read.parquet(f"{root}/out").withColumn("titles", F.array_join("titles", "; "))


def m3_stream_page_index(spark, sf):
    """Pages land in two deliveries that overlap; the streamed index equals the batch one."""
    from gridloom.streaming.pages import index_available

    pages = report_pages(spark, sf).select("report_id", "pdf_page", "page_text", F.timestamp_seconds(F.lit(1_700_000_000)).alias("arrived"))
    root = stored(spark, sf, "stream", lambda p: pages.where("pdf_page % 3 <> 2").write.parquet(f"{p}/in/a"))
    index_available(spark, f"{root}/in/*", f"{root}/out", f"{root}/state")
    pages.where("pdf_page % 3 <> 1").write.parquet(f"{root}/in/b")
    index_available(spark, f"{root}/in/*", f"{root}/out", f"{root}/state")
    return spark.read.parquet(f"{root}/out")


def contract_rows(spark, sf):
    """Grids of which every fifth has a short row, and ranges of which some are turned round."""
    short = (F.col("report_id") % 5 == 0) & (F.col("row_no") == 3)
    return clean(spark, sf).withColumn("cells", F.when(short, F.slice("cells", 1, 7)).otherwise(F.col("cells"))).where("NOT (report_id % 7 = 0 AND row_no = 4)")


def j15_check_contracts(spark, sf):
    rows = written(contract_rows(spark, sf), "grid")
    pages = report_pages(spark, sf).where("NOT (report_id IN ('src3', 'src9') AND pdf_page = 5)")
    ranges = rows.select("report_id").distinct().select("report_id", F.lit(5).alias("start_page"), (F.col("report_id") % 9).alias("end_page"))
    ranges = ranges.withColumn("length", F.col("end_page") - 4 + F.when(F.col("report_id") % 4 == 0, 1).otherwise(0))
    found = facts(spark, sf).select("record_id", (F.col("confidence") * 1.2).alias("confidence"))
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("position"), F.col("n_name").alias("name"))
    return ql.check_contracts(pages, rows, ranges, found, names, r"^\d+-[0-3]$")


def j16_check_bindings(spark, sf):
    """Suppliers as parsers, parts as parameters, with bindings that are missing, wrong or of another family."""
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    name = lambda n: F.concat(F.lit("parser"), n.cast("string"))
    parsers = table(spark, sf, "supplier").where("s_suppkey % 7 <> 3").select(name(F.col("s_suppkey")).alias("parser_id"), F.concat(F.lit("family"), (F.col("s_suppkey") % 4).cast("string")).alias("family"), F.array(F.lit("wide"), F.when(F.col("s_suppkey") % 2 == 0, "block").otherwise("pairs")).alias("patterns"))
    own = k % 10 + 1
    parameters = p.select(k.cast("string").alias("parameter_id"), name(own).alias("parser_id"), F.concat(F.lit("family"), F.when(k % 13 == 0, 9).otherwise(own % 4).cast("string")).alias("family"), F.when(k % 3 == 0, "block").when(k % 3 == 1, "wide").alias("pattern"))
    registry = p.where("p_partkey % 17 <> 0").select(k.cast("string").alias("parameter_id"), name(F.when(k % 19 == 0, own + 1).otherwise(own)).alias("parser_id"))
    return ql.check_bindings(parameters, registry, parsers)


def j16_check_catalog_refs(spark, sf):
    r, n, s = (table(spark, sf, t) for t in ("region", "nation", "supplier"))
    aliases = n.select(F.col("n_name").alias("alias"), F.when(F.col("n_nationkey") % 6 == 0, "NOWHERE").otherwise(F.col("n_regionkey").cast("string")).alias("canonical"))
    names = r.select(F.col("r_regionkey").cast("string").alias("canonical")).union(r.where("r_regionkey = 2").select(F.col("r_regionkey").cast("string")))
    return ql.check_catalog_refs(aliases, names, s.select(F.col("s_name").alias("child"), F.col("s_nationkey").alias("parent")), n.where("n_nationkey < 20").select(F.col("n_nationkey").alias("parent")))


def l6_retrieve_block(spark, sf):
    terms = table(spark, sf, "customer").select(F.substring("c_mktsegment", 1, 5).alias("term")).distinct()
    b = blocks(spark, sf)
    return sr.retrieve_block(terms, sr.block_catalog(b), b)


K8 = {"State": ["State", "state"], "Utility": ["DISCOM", "utility"], "Year": ["year"], "Charge": ["value"]}
STAGES = """WITH st AS (SELECT o_orderkey AS report_id, CAST(NULL AS INT) AS parameter_id, s AS stage_no, CAST(o_orderdate AS DATE) + CAST(s * 5 + o_orderkey % 9 AS INT) AS completed_at
      FROM orders, (SELECT unnest([1, 2, 3]) AS s)
UNION ALL SELECT l_orderkey, CAST(l_linenumber AS INT), s, CAST(max(l_shipdate) AS DATE) + CAST(s * 5 + l_orderkey % 9 AS INT) FROM lineitem,
  (SELECT unnest([4, 5, 6]) AS s) GROUP BY 1, 2, 3)"""

QUERIES = {
    "a4_records_round_trip": a4_records_round_trip,
    "a6_write_warehouse": a6_write_warehouse,
    "a7_write_by_group": a7_write_by_group,
    "j1_check_required": lambda s, d: ql.check_required(facts(s, d), ["state", "utility", "unit"]),
    "j2_check_duplicate_ids": lambda s, d: ql.check_duplicate_ids(facts(s, d)),
    "j3_check_composite_duplicates": lambda s, d: ql.check_composite_duplicates(facts(s, d), ["state", "utility", "discom", "year", "voltage"]),
    "j4_check_catalog_membership": lambda s, d: ql.check_catalog_membership(facts(s, d), segments(s, d)),
    "j5_check_range": lambda s, d: ql.check_range(facts(s, d), "value"),
    "j6_check_null_rates": lambda s, d: ql.check_null_rates(facts(s, d), {"state": 0.05, "utility": 0.1, "discom": 0.1, "unit": 0.2}, ["charge_value", "value", "confidence"]),
    "j7_check_min_records": lambda s, d: ql.check_min_records(facts(s, d), sixth(s, d)),
    "j8_check_coverage": lambda s, d: ql.check_coverage(facts(s, d), segments(s, d), 5),
    "j9_recalibrate_confidence": lambda s, d: ql.recalibrate_confidence(facts(s, d), segments(s, d), FIELDS).groupBy("parameter_id", "confidence").agg(F.count("*").alias("n")),
    "j10_validation_report": lambda s, d: ql.validation_report(checks(s, d), max_errors=3, records=placed_facts(s, d)),
    "j11_coverage_summary": lambda s, d: ql.coverage_summary(facts(s, d)),
    "j12_export_gate": lambda s, d: ql.export_gate(facts(s, d), reports(s, d)).groupBy("parameter_id").agg(F.count("*").alias("n")),
    "j13_profile_records": lambda s, d: ql.profile_records(facts(s, d), FIELDS),
    "j14_audit_hierarchy": lambda s, d: ql.audit_hierarchy(facts(s, d)),
    "j15_check_contracts": j15_check_contracts,
    "j16_check_bindings": j16_check_bindings,
    "j16_check_catalog_refs": j16_check_catalog_refs,
    "k1_flatten_records": lambda s, d: kx.flatten_records(facts(s, d), ["state", "utility", "value"]),
    "k2_order_columns": lambda s, d: kx.order_columns(facts(s, d).drop("pages"), ["state", "utility", "discom", "year"], ("unit",)),
    "k3_sort_output": lambda s, d: kx.sort_output(facts(s, d).select("state", "utility", "record_id")),
    "k4_rename_display": lambda s, d: kx.rename_display(facts(s, d).select("state", "utility", "value"), {"state": "State Name", "value": "Charge"}),
    "k5_summary_dashboard": lambda s, d: kx.summary_dashboard(facts(s, d), reports(s, d)),
    "k6_confidence_band": lambda s, d: kx.confidence_band(facts(s, d).select("record_id", "confidence", (F.col("value") / 8).alias("value")), ["value"]),
    "k7_column_profile": lambda s, d: kx.column_profile(clean(s, d)),
    "k8_by_group_view": lambda s, d: kx.by_group_view(facts(s, d), "BUILDING", K8),
    "l1_detect_query_group": grouped,
    "l2_query_keywords": lambda s, d: keyed(s, d).withColumn("keywords", F.array_join("keywords", ",")),
    "l3_score_rows": lambda s, d: sr.score_rows(keyed(s, d), supplier_records(s, d)).select("query_id", "position", "score"),
    "l4_ranked_search": lambda s, d: sr.ranked_search(keyed(s, d), supplier_records(s, d), 3),
    "l5_block_catalog": lambda s, d: sr.block_catalog(blocks(s, d)),
    "l6_retrieve_block": l6_retrieve_block,
    "m1_changed_inputs": m1_changed_inputs,
    "m2_invalidate_downstream": m2_invalidate_downstream,
    "m1_stale_stages": m1_stale_stages,
    "m2_invalidate_scoped": m2_invalidate_scoped,
    "m3_stream_page_index": m3_stream_page_index,
    "m3_stream_whole_index": m3_stream_whole_index,
}

SHEET = r"substr(regexp_replace(concat('State: ', state, ' [all of it, and some more]'), '[\\/*?:\[\]]', '_', 'g'), 1, 31)"
ORACLE_SQL = {
    "a4_records_round_trip": f"{FACTS} SELECT * EXCLUDE (pages) FROM facts",
    "a6_write_warehouse": f"{FACTS} SELECT parameter_id, record_id, state, value FROM facts",
    "a7_write_by_group": f"{FACTS} SELECT {SHEET} AS sheet, state, utility, value FROM facts",
    "j1_check_required": f"""{FACTS} {" UNION ALL ".join(f"SELECT parameter_id, 'required.{c}' AS rule_id, 'error' AS severity, count(*) FILTER (coalesce({c}, '') = '') = 0 AS passed, CAST(count(*) FILTER (coalesce({c}, '') = '') AS DOUBLE) AS metric FROM facts GROUP BY 1" for c in ("state", "utility", "unit"))}""",
    "j2_check_duplicate_ids": one("duplicate_id", "error", "(count(*) - count(DISTINCT record_id))"),
    "j3_check_composite_duplicates": one("composite_duplicate", "warning", "(count(*) - count(DISTINCT (lower(state), lower(utility), year)))"),
    "j4_check_catalog_membership": one("catalog.state", "error", "count(*) FILTER (state <> '' AND lower(state) NOT IN (SELECT alias FROM seg))"),
    "j5_check_range": one("range.value", "warning", "count(*) FILTER (value NOT BETWEEN 0 AND 1000)"),
    "j6_check_null_rates": f"""{FACTS}, r AS (SELECT parameter_id, avg(CASE WHEN state = '' THEN 1.0 ELSE 0 END) AS a, avg(CASE WHEN utility = 'N/A' THEN 1.0 ELSE 0 END) AS b, avg(CASE
      WHEN unit IS NULL THEN 1.0 ELSE 0 END) AS c, (count(*) FILTER (value IS NULL) + count(*) FILTER (confidence IS NULL)) / (2 * count(*)) AS d FROM facts GROUP BY 1)
      SELECT parameter_id, 'null_rate.state' AS rule_id, 'warning' AS severity, a <= 0.05 AS passed, a AS metric FROM r
        UNION ALL SELECT parameter_id, 'null_rate.utility', 'warning', b <= 0.1, b FROM r UNION ALL SELECT parameter_id, 'null_rate.unit', 'warning', c <= 0.2, c FROM r
        UNION ALL SELECT parameter_id, 'null_rate.values', 'warning', d <= 0.2, d FROM r""",
    "j7_check_min_records": one("min_records", "error", "count(*)", "count(*) >= (SELECT count(*) FROM lineitem) // 6"),
    "j8_check_coverage": one("coverage", "warning", "count(DISTINCT CASE WHEN lower(state) IN (SELECT alias FROM seg) THEN state END)", "count(DISTINCT CASE WHEN lower(state) IN (SELECT alias FROM seg) THEN state END) >= 5"),
    "j9_recalibrate_confidence": f"""{FACTS}, c AS (SELECT parameter_id, CASE WHEN utility = 'Col 3' THEN 0.3 WHEN lower(state) NOT IN (SELECT alias FROM seg) THEN 0.5 WHEN unit IS NULL THEN 0.8 ELSE 0.95 END AS confidence FROM facts) SELECT parameter_id, CAST(confidence AS DOUBLE) AS confidence, count(*) AS n FROM c GROUP BY 1, 2""",
    "j10_validation_report": f"{CHECKS} SELECT * FROM reports JOIN lineage USING (parameter_id)",
    "j11_coverage_summary": f"{FACTS} SELECT parameter_id, count(*) AS record_count, string_agg(DISTINCT nullif(state, ''), ',' ORDER BY nullif(state, '')) AS states, string_agg(DISTINCT nullif(utility, ''), ',' ORDER BY nullif(utility, '')) AS utilities, count(DISTINCT utility) AS utility_count, avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0 END) AS null_rate FROM facts GROUP BY 1",
    "j12_export_gate": f"{CHECKS} SELECT parameter_id, count(*) AS n FROM facts WHERE parameter_id IN (SELECT parameter_id FROM reports WHERE export_allowed) GROUP BY 1",
    "j13_profile_records": f"""{FACTS} {" UNION ALL ".join(f"SELECT parameter_id, '{c}' AS field, count(DISTINCT {c}) AS distinct_values, count(*) FILTER (coalesce({c}, '') = '') AS empty_values, count(*) FILTER (coalesce({c}, '') = '') * 100.0 / count(*) AS empty_percent FROM facts GROUP BY 1" for c in FIELDS)}""",
    "j14_audit_hierarchy": f"""{FACTS} SELECT parameter_id, state, count(*) AS rows, count(*) FILTER (length(utility) < 3 OR regexp_matches(upper(utility), 'STATE|UTILITY')) AS suspicious,
      count(*) FILTER ((parameter_id, utility) IN (SELECT (parameter_id, state) FROM facts)) AS leaks, count(*) FILTER (value IS NULL) AS empty_values FROM facts GROUP BY 1, 2""",
    "j15_check_contracts": f"{WITH_PAGES}, {FACTS.removeprefix('WITH ')}" + """ SELECT report_id, 'pages_contiguous' AS rule_id FROM fx_pages WHERE NOT (report_id IN ('src3', 'src9') AND pdf_page = 5)
      GROUP BY 1 HAVING min(pdf_page) <> 1 OR max(pdf_page) <> count(DISTINCT pdf_page) UNION ALL SELECT CAST(n_nationkey AS VARCHAR), 'equal_widths' FROM nation
      WHERE n_nationkey % 5 = 0
      UNION ALL SELECT CAST(n_nationkey AS VARCHAR), 'rows_numbered' FROM nation WHERE n_nationkey % 7 = 0 UNION ALL SELECT CAST(n_nationkey AS VARCHAR), 'range_ordered'
        FROM nation WHERE n_nationkey % 9 < 5
      UNION ALL SELECT CAST(n_nationkey AS VARCHAR), 'range_length' FROM nation WHERE n_nationkey % 4 = 0 UNION ALL SELECT record_id, 'id_pattern' FROM facts
        WHERE NOT regexp_matches(record_id, '^\\d+-[0-3]$')
      UNION ALL SELECT record_id, 'confidence_range' FROM facts WHERE confidence * 1.2 NOT BETWEEN 0 AND 1 UNION ALL SELECT n_name, 'catalog_sorted' FROM (SELECT n_name,
        lag(n_name) OVER (ORDER BY n_nationkey) AS b FROM nation) WHERE b > n_name""",
    "j16_check_bindings": """WITH q AS (SELECT s_suppkey AS s FROM supplier WHERE s_suppkey % 7 <> 3), p AS (SELECT p_partkey AS k, p_partkey % 10 + 1 AS own, CASE WHEN p_partkey % 17 <> 0 THEN CASE
      WHEN p_partkey % 19 = 0 THEN p_partkey % 10 + 2 ELSE p_partkey % 10 + 1 END END AS bound FROM part),
      r AS (SELECT k, CASE WHEN bound IS NULL THEN 'unregistered' WHEN bound <> own THEN 'binding' WHEN own NOT IN (SELECT s FROM q) THEN 'unknown_parser'
        WHEN k % 13 = 0 THEN 'family' WHEN k % 3 = 0 AND own % 2 = 1 THEN 'pattern' END AS rule_id FROM p)
      SELECT rule_id, CAST(k AS VARCHAR) AS item FROM r WHERE rule_id IS NOT NULL UNION ALL SELECT 'bound_parser', CAST(k AS VARCHAR) FROM p WHERE bound IS NOT NULL
        AND bound NOT IN (SELECT s FROM q)""",
    "j16_check_catalog_refs": "SELECT 'alias_target' AS rule_id, n_name AS item FROM nation WHERE n_nationkey % 6 = 0 UNION ALL SELECT 'parent', s_name FROM supplier WHERE s_nationkey >= 20 UNION ALL SELECT 'duplicate_name', '2'",
    "k1_flatten_records": f"{FACTS} SELECT record_id, parameter_id, confidence, pages AS source_pages, state, CASE WHEN utility = 'state_level' THEN '' ELSE utility END AS utility, CASE WHEN value IS NOT NULL THEN concat(CAST(CAST(value AS INT) AS VARCHAR), '.0') END AS value FROM facts",
    "k2_order_columns": f"{FACTS} SELECT state, utility, CAST(NULL AS VARCHAR) AS discom, year, confidence, record_id, parameter_id, value FROM facts",
    "k3_sort_output": f"{FACTS} SELECT state, utility, record_id FROM facts",
    "k4_rename_display": f"""{FACTS} SELECT state AS "State Name", utility, value AS "Charge" FROM facts""",
    "k5_summary_dashboard": f"{CHECKS} SELECT parameter_id, count(*) AS record_count, count(DISTINCT state) AS state_count, CASE WHEN any_value(passed) THEN 'PASSED' ELSE 'FAILED' END AS status, any_value(export_allowed) AS export_allowed FROM facts JOIN reports USING (parameter_id) GROUP BY 1",
    "k6_confidence_band": f"{FACTS} SELECT record_id, confidence, CASE WHEN confidence >= 0.9 THEN 'green' WHEN confidence >= 0.7 THEN 'yellow' ELSE 'red' END AS band, floor(value / 8 * 100 + 0.5) / 100 AS value FROM facts",
    "k7_column_profile": f"""{CLEAN}, u AS ({" UNION ALL ".join(f"SELECT report_id, {i} AS col_idx, c{i} AS cell FROM cl" for i in range(8))})
      SELECT report_id, col_idx, count(*) FILTER (trim(cell) <> '') AS non_blank, bool_or(trim(cell) <> '') AS active, max(length(cell)) AS max_length,
        least(greatest(max(length(cell)) + 3, 10), 50) AS display_width FROM u GROUP BY 1, 2""",
    "k8_by_group_view": f"""{FACTS} SELECT state AS "State", utility AS "Utility", year AS "Year", CASE WHEN value IS NOT NULL THEN concat(CAST(CAST(value AS INT) AS VARCHAR), '.0') END AS "Charge" FROM facts WHERE state = 'BUILDING'""",
    "l1_detect_query_group": f"""{QWORDS} SELECT query_id, query, g AS "group" FROM qb""",
    "l2_query_keywords": f"""{QWORDS} SELECT query_id, query, "group", array_to_string(kw, ',') AS keywords FROM qk""",
    "l3_score_rows": f"{QWORDS} SELECT * FROM sc",
    "l4_ranked_search": f"""{QWORDS}, t AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, position) AS INT) AS place FROM sc WHERE score > 0)
      SELECT query_id, place, position, score, 'ok' AS status FROM t WHERE place <= 3 UNION ALL SELECT query_id, NULL, NULL, 0, 'no group' FROM qk WHERE "group" IS NULL""",
    "l5_block_catalog": f"""{CLEAN} SELECT report_id, block_no, min_by(state, row_no) AS state, min(pdf_page) AS start_page, count(*) AS row_count,
      string_agg(concat_ws(' ', {", ".join(f"nullif(c{i}, '')" for i in range(8))}), ' ' ORDER BY row_no) AS search_text FROM bl WHERE block_no > 0 GROUP BY 1, 2""",
    "l6_retrieve_block": f"""{CLEAN}, t AS (SELECT DISTINCT substr(c_mktsegment, 1, 5) AS term FROM customer), h AS (SELECT term, report_id, min(block_no) AS block_no FROM bl JOIN t ON contains(lower(state),
      lower(term)) WHERE block_no > 0 GROUP BY 1, 2)
      SELECT term, report_id, block_no, row_no FROM bl JOIN h USING (report_id, block_no)""",
    "m1_changed_inputs": "SELECT doc_id FROM documents WHERE doc_id % 2 = 1 OR doc_id % 10 = 0",
    "m2_invalidate_downstream": "SELECT o_orderkey AS report_id, s.stage_no, CASE WHEN o_orderkey % 3 = 0 AND s.stage_no > o_custkey % 8 + 1 THEN 'stale' ELSE 'complete' END AS status FROM orders, (SELECT unnest(range(1, 9)) AS stage_no) s",
    "m1_stale_stages": f"""{STAGES}, c AS (SELECT *, report_id + stage_no * 7 + coalesce(parameter_id, 0) AS k, (report_id + stage_no) % 13 <> 0 AS ran FROM st),
      u AS (SELECT a.report_id, a.parameter_id, a.stage_no, max(CASE WHEN b.ran THEN b.completed_at END) AS newest FROM c a LEFT JOIN c b ON a.report_id = b.report_id
        AND b.stage_no < a.stage_no AND (b.parameter_id IS NULL OR b.parameter_id = a.parameter_id) GROUP BY ALL),
      r AS (SELECT c.report_id, c.parameter_id, c.stage_no, CASE WHEN NOT ran THEN 'new' WHEN k % 11 = 0 THEN 'input'
        WHEN newest > completed_at THEN 'upstream newer' END AS reason FROM c JOIN u ON u.report_id = c.report_id AND u.stage_no = c.stage_no
        AND u.parameter_id IS NOT DISTINCT FROM c.parameter_id),
      d AS (SELECT a.report_id, a.parameter_id, a.stage_no, any_value(a.reason) AS reason, bool_or(b.reason IS NOT NULL) AS behind FROM r a LEFT
        JOIN r b ON a.report_id = b.report_id AND b.stage_no < a.stage_no AND (b.parameter_id IS NULL OR b.parameter_id = a.parameter_id) GROUP BY 1, 2, 3)
      SELECT report_id, parameter_id, stage_no, coalesce(reason, 'upstream stale') AS reason FROM d WHERE reason IS NOT NULL OR behind""",
    "m2_invalidate_scoped": f"""{STAGES}, ch AS (SELECT * FROM st WHERE (report_id * 3 + stage_no * 5 + coalesce(parameter_id, 0)) % 17 = 0)
      SELECT s.report_id, s.parameter_id, s.stage_no, CASE WHEN EXISTS (SELECT 1 FROM ch WHERE ch.report_id = s.report_id AND ch.stage_no < s.stage_no
        AND (ch.parameter_id IS NULL OR s.parameter_id IS NULL OR ch.parameter_id = s.parameter_id)) THEN 'stale' ELSE 'complete' END AS status FROM st s""",
    "m3_stream_page_index": f"{WITH_TITLES} SELECT * FROM titles",
    "m3_stream_whole_index": f"{WITH_INDEX} SELECT * FROM idx",
}
