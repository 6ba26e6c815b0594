"""Hard negatives against all pairs in plain Python."""

import math
import random

import duckdb
import numpy as np
import pytest
from gridloom.llm import hard_negatives as hn
from gridloom.llm.queries import ORACLE_SQL, op12_hard_negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label int, row int, score int, anchor string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every, positives=5, negatives=3):
    held = []
    for vec_id, e, label, *_ in rows:
        if vec_id is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        held.append((vec_id, label, [max(-(2**63), min(2**63 - 1, math.floor(256 * x))) for x in e]))
    out = []
    for a_id, a_label, a in held:
        if a_id % every:
            continue
        scored = [(max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, q)))), i, label) for i, label, q in held if i != a_id]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for p, p_id, _ in [s for s in scored if s[2] == a_label][:positives]:
            band = [s for s in scored if s[2] != a_label and 50 * p <= 100 * s[0] <= 95 * p]
            out += [(a_id, p_id, k + 1, i, p, s) for k, (s, i, _) in enumerate(band[:negatives])]
    return sorted(out)


def mined(spark, rows, every, **settings):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r[c] for c in COLUMNS) for r in hn.mine_hard_negatives(df, F.col("vec_id") % every == 0, **settings).collect())


def clustered(n, dims, seed, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    e = centres[rng.integers(0, 6, n)] + rng.normal(scale=0.6, size=(n, dims))
    e[rng.random((n, dims)) < 0.2] = 0
    return [(i, v.tolist(), int(rng.integers(0, labels)), 1, 2, "x") for i, v in enumerate(e)]


@pytest.mark.parametrize("settings", [{}, {"block_rows": 64, "sample_rows": 16}])
def test_equals_all_pairs(spark, settings):
    rows = clustered(700, 24, 5)
    assert mined(spark, rows, 20, **settings) == brute(rows, 20)


def test_nulls_ties_repeats_and_ragged_vectors(spark):
    random.seed(3)
    rows = [
        (0, [1.0, 0.5], 1, 1, 1, "x"),
        (0, [1.0, 0.5], 1, 1, 1, "x"),
        (1, [1.0, 0.5], 1, 1, 1, None),
        (2, [1.0, 0.5], 1, 1, 1, None),
        (3, [0.9, 0.5], 2, 1, 1, None),
        (4, [0.9, 0.5], 2, 1, 1, None),
        (4, [0.9, 0.5], 2, 1, 1, None),
        (6, [0.7], 3, 1, 1, None),
        (7, [], 3, 1, 1, None),
        (8, None, 3, 1, 1, None),
        (9, [None, 1.0], 3, 1, 1, None),
        (11, [float("nan"), 1.0], 3, 1, 1, None),
        (12, [float("inf"), 1.0], 3, 1, 1, None),
        (13, [0.8, 0.1, 5.0], None, 1, 1, None),
        (14, [0.8, 0.1, 5.0], 4, 1, 1, None),
        (None, [0.8, 0.1, 5.0], 4, 1, 1, None),
        (15, [0.0, 0.0], 4, 1, 1, None),
        (20, [-1.0, -0.5], 1, 1, 1, None),
        (25, [], 5, 1, 1, None),
        (26, [1.0], 5, 1, 1, None),
    ]
    assert mined(spark, rows, 5) == brute(rows, 5)


def test_numbers_beyond_doubles(spark):
    rows = [(i, [float(7 * i % 5 - 1) * 2.0**k, 1.0 + i, 0.3], i % 2, 1, 1, None) for i, k in enumerate([0, 20, 30, 40, 45, 54, 70, 20, 30, 40, 45, 54])]
    assert mined(spark, rows, 2) == brute(rows, 2)


def test_empty_table(spark):
    assert mined(spark, [], 5) == []


def test_index_omits_and_prunes():
    rng = np.random.default_rng(2)
    x, a = rng.integers(-60, 60, (400, 64)), rng.integers(-60, 60, (30, 64))
    exact = a @ x.T
    threshold = int(np.quantile(exact, 0.999))
    index = hn._Index(x, hn._rest_norms(a, range(0, 64, 8)), threshold)
    assert index.cut.max() < 8
    i, j, score = index.search(a, hn._rest_norms(a, range(0, 64, 8)), np.full(30, threshold))
    got = {(p, index.rows[q]): s for p, q, s in zip(i.tolist(), j.tolist(), score.tolist())}
    assert {k: v for k, v in got.items() if v >= threshold} == {(p, q): exact[p, q] for p, q in zip(*np.nonzero(exact >= threshold))}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/{sf}/embeddings.parquet'")
    want = con.execute(ORACLE_SQL["op12_hard_negatives"])
    names = [d[0] for d in want.description]
    assert names == COLUMNS
    got = op12_hard_negatives(spark, f"/root/testdata/{sf}")
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
