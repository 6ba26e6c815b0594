"""Work that must not grow faster than the tables: partitions, and what is read how often."""

from gridloom import fixtures
from gridloom.operators import builders as bd
from gridloom.operators import extraction as ex
from gridloom.operators import quality as ql
from gridloom.plans import layouts, records

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_grids_and_facts_are_dealt_by_their_rows(spark, monkeypatch):
    small = [sorted(map(str, t.collect())) for t in (fixtures.grid_body(spark, SF), records.facts(spark, SF))]
    monkeypatch.setattr(fixtures, "TASK_ROWS", 100)
    parts = -(-fixtures.table(spark, SF, "orders").count() // 100)
    body, facts = fixtures.grid_body(spark, SF), records.facts(spark, SF)
    for key in ("o_custkey", "o_orderkey", "l_orderkey"):
        assert [n for n in plan(body).split(f"hashpartitioning({key}#")[1:] if f", {parts})" in n.split("\n")[0]]
    assert body.rdd.getNumPartitions() == parts
    assert f", {parts})" in plan(facts)
    assert [sorted(map(str, t.collect())) for t in (body, facts)] == small


def test_no_task_sorts_the_tables_of_pages(spark):
    df = spark.createDataFrame([(None, 1, t, i, ["a"] * w) for t, n, w in ((0, 2, 3), (1, 3, 1)) for i in range(n)], "report_id string, pdf_page int, table_idx int, row_idx int, cells array<string>")
    found = ex.select_primary_table(df)
    assert "Window" not in plan(found) and "SortMergeJoin" not in plan(found) and "ShuffledHashJoin" in plan(found)
    assert sorted((r.table_idx, r.row_idx) for r in found.collect()) == [(0, 0), (0, 1)]


def test_only_the_first_rows_are_read_for_headers(spark):
    rows = layouts.two_headers(spark, SF, 5)
    assert max(r.row_no for r in rows.collect()) == 5
    whole = layouts.hd.header_depth(layouts.two_headers(spark, SF))
    assert sorted(map(tuple, layouts.hd.header_depth(rows).collect())) == sorted(map(tuple, whole.collect()))


def test_what_belongs_to_a_row_is_found_before_the_melt(spark):
    df = spark.createDataFrame([(1, 1, 2, ["Goa", "", "2024-25", "", "7", "x", "8"])], "report_id int, row_no int, pdf_page int, cells array<string>")
    labels = spark.createDataFrame([(1, i, f"L{i}") for i in range(7)], "report_id int, col_idx int, label string")
    out = bd.wide_to_long(df, labels)
    text = out._jdf.queryExecution().optimizedPlan().toString()
    above = text[: text.index("Generate posexplode")]
    assert r"\d{4}-\d{2}" in text and r"\d{4}-\d{2}" not in above
    assert [(r.col_idx, r.category, r.year, r.value) for r in sorted(out.collect(), key=lambda r: r.col_idx)] == [(4, "Goa", "2024-25", 7.0), (6, "Goa", "2024-25", 8.0)]


def test_blank_categories_meet_in_no_join(spark):
    df = spark.createDataFrame([(i, "" if i else "GoaX") for i in range(9)] + [(9, None)], "i int, category string")
    names = spark.createDataFrame([("goa", 1)], "canonical string, priority int")
    out = bd.with_utility(df, names)
    top = out._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Union" in top
    assert sorted((r.i, r.utility) for r in out.collect()) == [(0, "goa"), *[(i, "state_level") for i in range(1, 10)]]


def test_contracts_read_every_table_once(spark, tmp_path):
    make = lambda name, rows, schema: (spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name)), spark.read.parquet(str(tmp_path / name)))[1]
    pages = make("pages", [("r", 1), ("r", 3)], "report_id string, pdf_page int")
    rows = make("rows", [("r", 1, ["a"]), ("r", 3, ["a", "b"])], "report_id string, row_no int, cells array<string>")
    ranges = make("ranges", [("r", 5, 4, 9), ("s", 1, None, None)], "report_id string, start_page int, end_page int, length int")
    facts = make("facts", [("x", 2.0), ("1-1", None)], "record_id string, confidence double")
    names = make("names", [(1, "b"), (2, "a")], "position int, name string")
    out = ql.check_contracts(pages, rows, ranges, facts, names, r"^\d+-[0-3]$")
    assert plan(out).count("FileScan") == 5
    rules = {("r", x) for x in ("pages_contiguous", "equal_widths", "rows_numbered", "range_ordered", "range_length")} | {("x", "id_pattern"), ("x", "confidence_range"), ("a", "catalog_sorted")}
    assert sorted(map(tuple, out.collect())) == sorted(rules)


def test_no_nested_row_grows_with_its_block(spark):
    n = bd.NESTED_ROWS
    line = lambda i: ["Category", "LT", "HT"] if i == 1 else ["S1"] if i == 2 else [f"r{i}", str(i), "x"]
    pair = lambda i: ["category", f"U{i}"] if i in (1, n + 9) else [f"m{i}", str(i)]
    simple = lambda i: ["Kind", "A", "B"] if i == 1 else [f"r{i}", str(i), "y"]
    rows = [(1, b, b * 10 * n + i, of(i)) for b, of in ((1, line), (2, simple), (3, pair)) for i in range(1, 2 * n + 11)]
    df = spark.createDataFrame(rows, "report_id int, block_no int, row_no int, cells array<string>").repartition(4)
    layouts = spark.createDataFrame([(1, 1, "matrix"), (1, 2, "simple_matrix"), (1, 3, "key_value")], "report_id int, block_no int, layout string")
    nested = bd.nested_blocks(df, layouts).cache()
    got = {(r.block_no, r.part): r for r in nested.collect()}
    assert sorted(got) == [(b, p) for b in (1, 2, 3) for p in (0, 1, 2)]
    held = lambda r: sum(len(s.rows) for s in r.sections) + len(r.rows or ()) + len(r.metrics or ())
    assert max(map(held, got.values())) <= n
    assert [[(s.name, s.columns) for s in got[1, p].sections] for p in (0, 1, 2)] == [[("S1", ["LT", "HT"])], [("S1", None)], [("S1", None)]]
    assert {got[3, p].utility for p in (0, 1, 2)} == {f"U{n + 9}"} and {tuple(got[2, p].columns) for p in (0, 1, 2)} == {("A", "B")}
    want = [("matrix", "S1", 10 * n + i, f"r{i}", c, v) for i in range(3, 2 * n + 11) for c, v in (("LT", str(i)), ("HT", "x"))]
    want += [("simple_matrix", None, 20 * n + i, f"r{i}", c, v) for i in range(2, 2 * n + 11) for c, v in (("A", str(i)), ("B", "y"))]
    want += [("key_value", None, 30 * n + i, f"m{i}", f"U{n + 9}", str(i)) for i in range(2, 2 * n + 11) if i != n + 9]
    flat = bd.flat_blocks(nested).select("parser_type", "section", "row_no", "category", "label", "value")
    assert sorted(map(str, map(tuple, flat.collect()))) == sorted(map(str, want))
