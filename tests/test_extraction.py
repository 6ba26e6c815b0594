"""Headers repeated on later pages, tables of a page and ranges against plain rules."""

import random

import pytest
from gridloom.operators import extraction as ex

SCHEMA = "report_id string, pdf_page int, table_idx int, row_idx int, cells array<string>"


def pages(seed):
    rng = random.Random(seed)
    line = lambda: [rng.choice("ab"), rng.choice(["", "x", None])]
    out = {}
    for report in "rst":
        head = [line() for _ in range(rng.randint(0, 7))]
        numbers = sorted(rng.sample(range(1, 20), rng.randint(1, 5)))
        out[report] = {p: head[: rng.randint(0, len(head))] + [line() for _ in range(rng.randint(1, 4))] for p in numbers}
    return out


def plain(report):
    first, *rest = sorted(report)
    height = 0
    for p in rest:
        same = 0
        while same < min(5, len(report[p]), len(report[first])) and report[p][same] == report[first][same]:
            same += 1
        height = max(height, same)
    kept = {p: rows[height:] if height and p != first and rows[:height] == report[first][:height] else rows for p, rows in report.items()}
    return height, kept


@pytest.mark.parametrize("seed", range(6))
def test_headers_repeated_on_later_pages(spark, seed):
    made = pages(seed)
    rows = [(r, p, i // 3, i % 3, cells) for r, of in made.items() for p, lines in of.items() for i, cells in enumerate(lines)]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    want = {r: plain(of) for r, of in made.items()}
    assert {x.report_id: x.header_height for x in ex.detect_header_height(df).collect()} == {r: h for r, (h, _) in want.items()}
    merged = sorted((x.report_id, x.row_no, x.pdf_page, x.cells) for x in ex.merge_pages(df).collect())
    assert [(r, n, p, c) for r, n, p, c in merged] == [(r, n + 1, p, c) for r, (_, kept) in sorted(want.items()) for n, (p, c) in enumerate((p, c) for p in sorted(kept) for c in kept[p])]
    log = {(x.report_id, x.pdf_page): (x.rows_added, x.headers_removed) for x in ex.merge_log(df).collect()}
    assert log == {(r, p): (len(kept[p]), len(made[r][p]) - len(kept[p])) for r, (_, kept) in want.items() for p in kept}


def test_the_rows_are_read_and_dealt_once(spark, tmp_path):
    spark.createDataFrame([("r", 1, 0, i, [str(i)]) for i in range(9)], SCHEMA).write.parquet(str(tmp_path / "rows"))
    plan = ex.merge_pages(spark.read.parquet(str(tmp_path / "rows")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_one_table_of_a_page(spark):
    rows = [("r", 1, t, i, ["a"] * w) for t, n, w in ((2, 2, 3), (5, 3, 2), (7, 1, 9)) for i in range(n)] + [("r", 2, 4, 0, []), ("r", 2, 4, 1, [])]
    df = spark.createDataFrame(rows, SCHEMA)
    chosen = lambda *a: sorted({(r.pdf_page, r.table_idx) for r in ex.select_primary_table(df, *a).collect()})
    assert chosen() == [(1, 7), (2, 4)] and chosen("first_table") == [(1, 2), (2, 4)]
    assert chosen("by_index", 1) == [(1, 5), (2, 4)] and chosen("by_index", 9) == [(1, 2), (2, 4)]
    tie = spark.createDataFrame([("r", 1, 3, 0, ["a", "b"]), ("r", 1, 1, 0, ["a", "b"])], SCHEMA)
    assert [r.table_idx for r in ex.select_primary_table(tie).collect()] == [1]


def test_a_range_turned_round_holds_no_page(spark):
    rows = spark.createDataFrame([("r", p, 0, 0, ["a"]) for p in (2, 3, 4)], SCHEMA)
    ranges = spark.createDataFrame([("r", 4, 2)], "report_id string, start_page int, end_page int")
    assert ex.extract_in_range(rows, rows, ranges).count() == 0
