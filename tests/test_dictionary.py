"""Names held by texts, next anchors, blocks and their matrices against plain rules."""

import random

import pytest
from gridloom.operators import builders as bd
from gridloom.operators import dictionary as dy
from gridloom.operators import discovery as dc
from gridloom.operators import normalize as nm


def made(seed, n, letters="ab c"):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(n)}


@pytest.mark.parametrize("letters", ["ab c", "abé\t xyz", "ab"])
def test_held_names_equals_containment(spark, letters):
    texts, names = made(1, 60, letters) | {"the north power company ltd", ""}, made(2, 60, letters) | {"north power", "th", "r co", "", "pany ltd"}
    t = spark.createDataFrame([(x,) for x in texts] + [(None,)], "text string")
    n = spark.createDataFrame([(x,) for x in names] + [(None,)], "name string")
    got = {tuple(r) for r in dy.held_names(t, n).collect()}
    assert got == {(x, y) for x in texts for y in names if y.strip() and y in x}


def test_held_names_by_key(spark):
    t = spark.createDataFrame([("r", 1, "a charge here"), ("r", 2, "a charge\nhere"), ("s", 1, None)], "report_id string, pdf_page int, text string")
    n = spark.createDataFrame([("charge here",), ("harge",)], "name string")
    got = sorted(tuple(r) for r in dy.held_names(t, n, ["report_id", "pdf_page"]).collect())
    assert got == [("r", 1, "charge here"), ("r", 1, "harge"), ("r", 2, "harge")]


def test_held_words_need_whole_words(spark):
    t = spark.createDataFrame([("the new-delhi zone",), ("newdelhi",), ("delhi new",), ("up",)], "text string")
    n = spark.createDataFrame([("new delhi",), ("delhi",), ("u.p",), ("up",), ("--",)], "name string")
    got = sorted(tuple(r) for r in dy.held_words(t, n).collect())
    assert got == [("delhi new", "delhi"), ("the new-delhi zone", "delhi"), ("the new-delhi zone", "new delhi"), ("up", "up")]


def test_no_join_is_a_nested_loop(spark):
    t, n = spark.range(1000).selectExpr("cast(id as string) text"), spark.range(1000).selectExpr("cast(id * 7 as string) name")
    plan = dy.held_names(t, n)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("seed", range(3))
def test_next_anchor_equals_a_scan(spark, seed):
    rng = random.Random(seed)
    rows = [("r", rng.randint(1, 30), rng.choice("1223")) for _ in range(25)] + [("s", 4, "1"), ("s", 4, "1"), ("s", 9, "1")]
    titles = spark.createDataFrame(rows, "report_id string, pdf_page int, table_number string")
    counts = spark.createDataFrame([("r", 33), ("s", 12)], "report_id string, page_count int")
    got = sorted(tuple(r) for r in dc.page_range_next_anchor(titles, counts).collect())
    want = []
    for report, page, number in rows:
        later = [p for r, p, n in rows if r == report and p > page and n != number]
        want.append((report, number, page, max(page, min(later) - 1) if later else {"r": 33, "s": 12}[report]))
    assert got == sorted(want)


def test_values_take_the_nearest_local_header(spark):
    rows = [
        (1, 1, 1, "Goa", ["Goa", "", "", "", ""]),
        (1, 1, 2, "Goa", ["", "Category", "North", "", "BRPL zone"]),
        (1, 1, 3, "Goa", ["", "HT line", "", "-", "nil"]),
        (1, 1, 4, "Goa", ["", "Domestic", "1.5", "2,000", "33 kV"]),
        (1, 1, 5, "Goa", ["", "utility", "9", "9", "9"]),
        (1, 1, 6, "Goa", ["", "", "9", "9", "9"]),
        (1, 2, 7, None, ["", "Low tension", "7", "2024", "8"]),
        (1, 2, 8, None, ["", "Right", "5"]),
    ]
    df = spark.createDataFrame(rows, "report_id int, block_no int, row_no int, state string, cells array<string>")
    none = spark.createDataFrame([], "report_id int, col_idx int, display_name string, role string, year string, unit string")
    aliases = spark.createDataFrame([("brpl", "BRPL", 1)], "name string, canonical string, priority int")
    catalog = spark.createDataFrame([("North", "Goa", 2), ("nor", "Bihar", 1)], "canonical string, state string, priority int")
    got = sorted((r.row_no, r.col_idx, r.utility, r.voltage_level, r.value) for r in bd.block_matrix(df, none, aliases, catalog).collect())
    assert got == [(4, 2, "North", "HT", 1.5), (4, 3, "North", "HT", 2000.0), (7, 2, "Col 2", "LT", 7.0), (7, 4, "Col 4", "LT", 8.0), (8, 2, "Col 2", "HT", 5.0)]


def test_blocks_without_a_known_name_take_worded_cells(spark):
    rows = [(1, 1, 1, "New Goa", ["x brpl y", "North Discom"]), (1, 1, 2, "New Goa", ["BRPL TPL in 2024-25", "2025-26"]), (1, 2, 3, "", ["right", " Old Utility "]), (1, 3, 4, None, [None, ""]), (1, 3, 5, None, [])]
    df = spark.createDataFrame(rows, "report_id int, block_no int, row_no int, state string, cells array<string>")
    names = spark.createDataFrame([("brpl", "BRPL"), ("TPL", "Torrent"), ("TPL", "TPL"), ("", "none"), (None, "none")], "name string, canonical string")
    got = {r.block_no: r for r in nm.describe_blocks(df, names).collect()}
    assert (got[1].utilities, got[1].year, got[1].block_id, got[1].row_count) == ("BRPL,TPL,Torrent", "2024-25", "1_new_goa_1_2", 2)
    assert (got[2].utilities, got[2].sections, got[2].year) == ("Old Utility", "HT", None)
    assert (got[3].utilities, got[3].sections, got[3].row_count) == ("", "", 2)


def test_names_are_not_sent_through_the_driver(spark):
    t, n = spark.range(1000).selectExpr("cast(id as string) text"), spark.range(1000).selectExpr("cast(id * 7 as string) name")
    plan = dy.held_names(t, n)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    # the few lengths of the names' words are broadcast, no name or word is
    assert "SortMergeJoin" in plan and len(joins) == 1 and "BroadcastHashJoin [n#" in joins[0]


def test_a_piece_meets_only_words_that_hold_it(spark):
    t, n = spark.range(400).selectExpr("concat('customer#', lpad(cast(id as string), 9, '0')) text"), spark.range(400).selectExpr("concat('customer#', lpad(cast(id as string), 9, '0')) name")
    assert dy._holding_words(t.withColumnRenamed("text", "word"), n).count() == 400
    plan = dy._holding_words(t.withColumnRenamed("text", "word"), n)._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains" not in plan
