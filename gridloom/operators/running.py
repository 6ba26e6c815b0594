"""Values carried and counted down the rows of a table of any length.

A table is cut in runs of rows.  What a row takes from its own run comes from a window over
the run, what it takes from the runs before from one row a run, so no task sorts or holds
a whole table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUN = 10_000


def running(
    rows: DataFrame, last: dict[str, Column] | None = None, sums: dict[str, Column] | None = None, key: str | list[str] = "report_id", run: int | str = RUN
) -> DataFrame:
    """``rows`` with the last non-null value so far (``last``) and the sum so far (``sums``) of each column, by ``row_no``; reads them twice.

    ``run`` rows make a run, or a column of that name numbers the runs in order.
    """
    last, sums = last or {}, sums or {}
    keys, at = [key] if isinstance(key, str) else key, run if isinstance(run, str) else "_run"
    cut = rows if isinstance(run, str) else rows.withColumn("_run", F.floor(F.col("row_no") / run))
    values = cut.withColumns({f"_v_{c}": v for c, v in last.items()} | {f"_n_{c}": v for c, v in sums.items()})
    own = Window.partitionBy(*keys, at).orderBy("row_no")
    inside = values.withColumns({f"_v_{c}": F.last(f"_v_{c}", ignorenulls=True).over(own) for c in last} | {f"_n_{c}": F.sum(f"_n_{c}").over(own) for c in sums})
    ends = [F.max_by(f"_v_{c}", F.when(F.col(f"_v_{c}").isNotNull(), F.col("row_no"))).alias(f"_v_{c}") for c in last] + [F.sum(f"_n_{c}").alias(f"_n_{c}") for c in sums]
    of = [f"_key_{k}" for k in keys]
    before = Window.partitionBy(*of).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    runs = values.groupBy(*[F.col(k).alias(o) for k, o in zip(keys, of)], F.col(at).alias("_of")).agg(*ends)
    earlier = [F.last(f"_v_{c}", ignorenulls=True).over(before).alias(f"_e_{c}") for c in last] + [F.sum(f"_n_{c}").over(before).alias(f"_e_{c}") for c in sums]
    runs = runs.select(*of, "_of", *earlier)
    # one row for each run of rows, small beside them
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, of)], F.col(at) == F.col("_of"))
    joined = inside.join(F.broadcast(runs), same, "left")
    out = {c: F.coalesce(f"_v_{c}", f"_e_{c}") for c in last}
    out |= {c: F.coalesce(f"_n_{c}", F.lit(0)) + F.coalesce(f"_e_{c}", F.lit(0)) for c in sums}
    drop = ["_run", *of, "_of", *[f"{p}{c}" for c in last for p in ("_v_", "_e_")], *[f"{p}{c}" for c in sums for p in ("_n_", "_e_")]]
    return joined.withColumns(out).drop(*drop)
