"""Sinks that may run again, catalogs from files, lineage, bindings, routing and nested blocks."""

import json

from gridloom.operators import builders as bd
from gridloom.operators import layouts as ly
from gridloom.operators import quality as ql
from gridloom.sources import catalogs, writers


def test_groups_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [("a/b", i) for i in range(40)] + [("c", 1), (None, 2)]
    df = spark.createDataFrame(rows, "state string, value int")
    writers.write_by_group(df, path, "state", ["value"], rows_per_file=10)
    writers.write_by_group(df.where("state = 'c'").withColumn("value", df["value"] + 5), path, "state", ["value"])
    got = sorted((r.sheet, r.value) for r in spark.read.parquet(path).where("sheet <> ''").collect() if r.sheet != "__HIVE_DEFAULT_PARTITION__")
    assert got == [("a_b", i) for i in range(40)] + [("c", 6)]


def test_index_csv_with_quotes_and_line_ends(spark, tmp_path):
    index = spark.createDataFrame([("r", 1, 5, 1, True, ['a "b"', "c\nd, e"]), ("r", 2, 0, 0, False, [])], "report_id string, pdf_page int, text_length long, table_count long, contains_table boolean, titles array<string>")
    for _ in range(2):
        writers.write_page_index_csv(index, str(tmp_path / "csv"))
    got = sorted(tuple(r) for r in writers.read_page_index_csv(spark, str(tmp_path / "csv")).collect())
    assert got == [("r", 1, 5, 1, True, 'a "b"; c\nd, e'), ("r", 2, 0, 0, False, "")]


def test_catalog_files_become_dimensions(spark, tmp_path):
    files = {
        "states": {"states": ["Goa", " Delhi ", ""]},
        "state_aliases": {"state_aliases": {" New Delhi": "Delhi"}},
        "utilities": {"utilities": {"Delhi": ["BRPL", " "], "Goa": []}},
        "voltages": {"voltages": {"HT": {"aliases": ["High Tension"]}, "LT": {}}},
        "units": {"units": {"Rs/kWh": ["Rs./kWh"]}},
        "categories": {"categories": {"Industrial": {"aliases": None, "subcategories": ["Steel"]}}},
    }
    for name, content in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(content, indent=2))
    got = catalogs.load_catalogs(spark, str(tmp_path))
    rows = lambda name, *cols: sorted(tuple(r) for r in got[name].select(*cols).collect())
    assert rows("states", "canonical", "priority") == [("Delhi", 1), ("Goa", 0)] and rows("utilities", "state", "canonical") == [("Delhi", "BRPL")]
    assert rows("state_aliases", "alias", "canonical") == [("new delhi", "Delhi")]
    assert rows("voltages", "alias", "canonical") == [("high tension", "HT"), ("ht", "HT"), ("lt", "LT")]
    assert rows("units", "alias", "canonical") == [("rs./kwh", "Rs/kWh"), ("rs/kwh", "Rs/kWh")] and rows("categories", "alias") == [("industrial",)]
    assert rows("subcategories", "category", "subcategory") == [("Industrial", "steel")]


def test_lineage_depends_on_order(spark):
    def root(ids):
        df = spark.createDataFrame([("p", i, r) for i, r in enumerate(ids)], "parameter_id string, position long, record_id string").repartition(3)
        return ql.lineage(df, block=2).first().lineage_hash

    a = root(["a", "b", "c", "d", "e"])
    assert a == root(["a", "b", "c", "d", "e"]) and len({a, root(["b", "a", "c", "d", "e"]), root(["a", "b", "c", "d"]), root(["a", "d", "c", "b", "e"])}) == 4


def test_bindings_that_do_not_resolve(spark):
    parameters = spark.createDataFrame([("ok", "p1", "f", None), ("none", "p1", "f", None), ("other", "p2", "f", None), ("gone", "p9", "f", None), ("fam", "p1", "g", None), ("pat", "p1", "f", "z")], "parameter_id string, parser_id string, family string, pattern string")
    registry = spark.createDataFrame([("ok", "p1"), ("other", "p1"), ("gone", "p9"), ("fam", "p1"), ("pat", "p1"), ("twice", "p1"), ("twice", "p1")], "parameter_id string, parser_id string")
    parsers = spark.createDataFrame([("p1", "f", ["x", "y"])], "parser_id string, family string, patterns array<string>")
    got = sorted(tuple(r) for r in ql.check_bindings(parameters, registry, parsers).collect())
    assert got == [("binding", "other"), ("bound_parser", "gone"), ("bound_twice", "twice"), ("family", "fam"), ("pattern", "pat"), ("unknown_parser", "gone"), ("unregistered", "none")]


def test_routing_steps_in_order(spark):
    classes = spark.createDataFrame([(1, "wide_table", None, "x"), (2, None, "kv", "x"), (3, "odd", "lost", "open_banking"), (4, None, None, "x"), (5, "key_value", None, "x"), (6, "key_value", None, "x")], "report_id int, pattern string, parser_id string, name string")
    bindings = spark.createDataFrame([(5, "narrative", "kv"), (6, None, "kv"), (1, None, None)], "report_id int, family string, parser_id string")
    parsers = spark.createDataFrame([("kv", "numeric_matrix")], "parser_id string, family string")
    got = {r.report_id: (r.family, r.step) for r in ly.route_parser(classes, bindings, parsers=parsers, name="name").collect()}
    assert got == {1: ("wide_to_long", "pattern"), 2: ("numeric_matrix", "classified_parser"), 3: ("narrative", "name"), 4: ("simple_matrix", "default"), 5: ("narrative", "binding"), 6: ("numeric_matrix", "bound_parser")}
    assert {r.report_id: r.family for r in ly.route_parser(classes.drop("parser_id"), bindings.drop("parser_id")).collect()}[5] == "narrative"


def test_blocks_are_nested_by_their_layout(spark):
    lines = {
        1: [["x", "lost"], ["Category", "LT", "", "HT", "LT"], ["early", "1"], ["S1"], ["a", "1", "", "2", "3", "9"], ["b"], ["c", None, "4"], ["category", "EHT"], ["d", "5", "6"]],
        2: [["Kind", "A", "B"], [" ", ""], ["a", "1", "2", "3"], ["b"]],
        3: [["only", "one"]],
        4: [["CATEGORY", "U1"], ["m", "1", "x"], ["skipped"], ["Category", "U2"]],
    }
    rows = [(1, b, b * 100 + i, cells) for b, of in lines.items() for i, cells in enumerate(of)]
    df = spark.createDataFrame(rows, "report_id int, block_no int, row_no int, cells array<string>").repartition(3)
    layouts = spark.createDataFrame([(1, 1, "matrix"), (1, 2, "simple_matrix"), (1, 3, "simple_matrix"), (1, 4, "key_value")], "report_id int, block_no int, layout string")
    got = {r.block_no: r for r in bd.nested_blocks(df, layouts).collect()}
    sections = [(s.name, s.columns, [(e.category, e["values"]) for e in s.rows]) for s in got[1].sections]
    assert sections == [("S1", ["LT", "HT", "LT"], [("a", {"LT": "3", "HT": "2"})]), ("b", ["LT", "HT", "LT"], [("c", {"LT": "4"}), ("d", {"EHT": "5"})])]
    assert got[2].columns == ["A", "B"] and [(e.category, e["values"]) for e in got[2].rows] == [("a", {"A": "1", "B": "2"}), ("b", {})]
    assert got[3].columns is None and got[3].rows is None
    assert got[4].utility == "U2" and [(m.metric, m.value) for m in got[4].metrics] == [("m", "1")]
