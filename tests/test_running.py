"""Values carried over runs of rows, and grids numbered without a window over a report."""

import random
import re

import pytest
from gridloom.fixtures import grid_rows
from gridloom.operators import builders as bd
from gridloom.operators import normalize as nm
from gridloom.operators.running import running
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("run", [1, 3, 1000])
def test_running_equals_a_scan(spark, run):
    rng = random.Random(run)
    rows = [(k, i, rng.choice([None, None, "a", "b"]), rng.choice([0, 1, None])) for k in (1, 2, None) for i in range(1, 20)]
    df = spark.createDataFrame(rows, "report_id int, row_no int, v string, n int")
    got = {(r.report_id, r.row_no): (r.last, r.total) for r in running(df, {"last": F.col("v")}, {"total": F.col("n")}, run=run).collect()}
    last, total, want = {}, {}, {}
    for k, i, v, n in rows:
        last[k], total[k] = v or last.get(k), total.get(k, 0) + (n or 0)
        want[k, i] = (last[k], total[k])
    assert got == want and len(got) == len(rows)


def test_no_window_goes_over_a_report(spark):
    rows = spark.createDataFrame([(1, 1, 1, ["A", "u", "2024-25", "1"])], "report_id int, row_no int, pdf_page int, cells array<string>")
    filled = nm.forward_fill_group(rows, section=F.lit(False))
    frames = [grid_rows(spark, SF), filled, nm.segment_blocks_spanning(rows, F.lit(True)), bd.wide_to_long_keyed(rows, {"x": 3})]
    for df in frames:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search(r"windowspecdefinition\(report_id#\d+, (row_no|pdf_page)#", plan)
        assert not re.search(r"row_number\(\) windowspecdefinition\(report_id#\d+, \w+#\d+ ASC[^)]*, \w+#\d+ ASC", plan)


def test_a_section_ends_the_carried_state(spark):
    rows = [(1, i, [c]) for i, c in enumerate(["", "A", "", "s", "", "B", ""], 1)]
    df = spark.createDataFrame(rows, "report_id int, row_no int, cells array<string>").withColumn("cells", F.transform("cells", lambda c: F.when(c == "s", "").otherwise(c)))
    got = [(r.state, r.propagated) for r in nm.forward_fill_group(df, section=F.col("row_no") == 4).orderBy("row_no").collect()]
    assert got == [("", False), ("A", False), ("A", True), ("", False), ("", False), ("B", False), ("B", True)]


def test_nearest_header_joins_no_cell_twice(spark):
    cells = spark.createDataFrame([(1, 1, c, str(c)) for c in range(4, 8)], "report_id int, row_no int, col_idx int, cell string")
    heads = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (1, 7, "c")], "report_id int, col_idx int, label string")
    frame = bd.nearest_header_column(cells, heads)
    assert [r.nearest_label for r in frame.orderBy("col_idx").collect()] == ["a", "b", "b", "c"]
    # cells meet one row a report and are not grouped again
    assert "Aggregate [report_id#" in frame._jdf.queryExecution().optimizedPlan().toString() and "cell#" not in "".join(x for x in frame._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in x)
