"""Cells in context: blank state cells and large tables of entities in the joins of H5."""

from gridloom.operators import headers as hd
from gridloom.sources.scratch import written
from pyspark.sql import functions as F

COLUMNS = "report_id int, col_idx int, display_name string, role string, unit string"


def cells_of(spark):
    rows = spark.createDataFrame([(1, 1, ["State", "Charge"]), (1, 2, ["GOA", "5"]), (1, 3, ["", "7"]), (1, 4, [None, "-"]), (1, 5, ["zz", "Acme"])], "report_id int, row_no int, cells array<string>")
    columns = spark.createDataFrame([(1, 0, "State", "state", None), (1, 1, "Charge", "value", "Rs/kWh")], COLUMNS)
    states = lambda values: values.withColumn("canonical", F.when(F.col("value") == "GOA", "Goa"))
    return hd.cells_in_context(rows, columns, spark.createDataFrame([(1, 1)], "report_id int, depth int"), states)


def test_blank_state_cells_are_joined_with_nothing(spark):
    cells = cells_of(spark)
    assert {(r.row_no, r.col_idx): r.state for r in cells.collect() if r.state} == {(2, 0): "Goa", (2, 1): "Goa"}
    assert cells.count() == 10
    assert "Union" in cells._jdf.queryExecution().optimizedPlan().toString()


def test_entities_are_not_sent_whole_through_the_driver(spark):
    entities = spark.createDataFrame([("Acme", "Charge", "", "utility", "ACME", 0.9), ("5", "Charge", "Goa", "unknown", None, 0.0)], "value string, header string, state string, entity_type string, canonical string, confidence double")
    out = hd.annotate_cells(cells_of(spark), written(entities, "entities"))
    got = {(r.row_no, r.col_idx): (r.annotation, r.canonical) for r in out.collect()}
    assert got[5, 1] == ("utility", "ACME") and got[2, 1] == ("charge", "5") and got[4, 1] == ("empty", None) and got[1, 1] == ("header", "Charge") and len(got) == 10
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert [j for j in plan.splitlines() if "Join" in j and "_value" in j and "Broadcast" in j] == [] and "SortMergeJoin" in plan
