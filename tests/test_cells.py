"""Cells that skip the cleaning rules, and texts that hold several values."""

import random

from gridloom.functions import text as tx
from gridloom.operators import builders as bd
from pyspark.sql import functions as F

PIECES = ["a", "b1", "/", " ", "  ", "*", "-", "\t", "\n", " ", " ", "(cid:12)", "(cid:", "ह", "–", "“", "\x00", "\x7f", "é", "%"]


def test_plain_cells_skip_the_rules_and_others_do_not(spark):
    rng = random.Random(3)
    texts = [None, "", "*", "/"] + ["".join(rng.choices(PIECES, k=rng.randint(1, 6))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(~tx.clean_cell(F.col("t")).eqNullSafe(tx.extract_english(tx.clean_text(F.col("t"))))).count() == 0
    space = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    assert df.where(~tx.strip(F.col("t")).eqNullSafe(space(F.col("t")))).count() == 0
    assert df.where(~tx.is_blank(F.col("t")).eqNullSafe(space(F.col("t")) == "")).count() == 0


def test_a_text_is_searched_once_for_its_values(spark):
    texts = ["1.13 (Partial OA) 1.53 (Full OA)", "2 (a) 3(b) x 4.5 ()", "7.25 (one)", "nil", None, "(a) (b)"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, raw string")
    out = bd.split_multi_value(df, "raw")
    got = sorted((r.id, r.part, r.value, r.qualifier) for r in out.collect())
    assert got == [(0, 0, 1.13, "Partial OA"), (0, 1, 1.53, "Full OA"), (1, 0, 2.0, "a"), (1, 1, 3.0, "b"), (1, 2, 4.5, ""), (2, 0, 7.25, None), (3, 0, 0.0, None), (4, 0, None, None), (5, 0, None, None)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
