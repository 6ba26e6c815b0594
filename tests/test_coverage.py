"""Coverage of records: names in order over several ranges, against plain rules."""

import random

from gridloom.operators import quality as ql


def test_names_of_a_parameter_are_joined_over_ranges(spark):
    rng = random.Random(7)
    name = lambda n: rng.choice([None, "", " ", *[f"N{i}" for i in range(n)]])
    rows = [(rng.choice(["a", "b", None]), name(5), name(200), rng.choice([None, 1.0])) for _ in range(2000)] + [("c", None, "", None), ("d", "x", None, 2.0)]
    out = ql.coverage_summary(spark.createDataFrame(rows, "parameter_id string, state string, utility string, value double"))
    want = {}
    for p in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == p]
        lists = [",".join(sorted({r[i] for r in own if r[i] and r[i].strip()})) for i in (1, 2)]
        want[p] = (len(own), *lists, len({r[2] for r in own if r[2] is not None}), sum(r[3] is None for r in own) / len(own))
    assert {r.parameter_id: (r.record_count, r.states, r.utilities, r.utility_count, r.null_rate) for r in out.collect()} == want
    # names are collected by range, and no set of all names of a parameter is built
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "RepartitionByExpression" in plan
