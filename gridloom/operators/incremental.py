"""What has to run again (group M).

A report has stages of its own (``parameter_id`` is null) and stages of each of its
parameters; a report's stage stands before the later stages of every parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCOPE = ["report_id", "parameter_id"]


def changed_inputs(current: DataFrame, state: DataFrame, key: list[str], hash_col: str = "content_hash") -> DataFrame:
    """M1: keys that are new or whose stored hash is another one."""
    return current.join(state.select(*key, hash_col), [*key, hash_col], "left_anti")


def _upstream(value: Column) -> Column:
    """The largest value of all earlier stages of the report and of the same parameter.

    Two running maxima over one deal of the rows by report; stages of equal number
    do not see each other.
    """
    before = (Window.unboundedPreceding, -1)
    own = Window.partitionBy("report_id", "parameter_id").orderBy("stage_no").rangeBetween(*before)
    report = Window.partitionBy("report_id").orderBy("stage_no").rangeBetween(*before)
    return F.greatest(F.max(value).over(own), F.max(F.when(F.col("parameter_id").isNull(), value)).over(report))


def stale_stages(current: DataFrame, state: DataFrame) -> DataFrame:
    """M1, by stage: the stages that have to run again, and the first reason for it.

    ``current`` has report_id, parameter_id, stage_no and input_hash, ``state`` the
    same of what has run, with completed_at.  A stage is ``new``, has another ``input``, is
    older than an ``upstream newer`` stage, or stands behind an ``upstream stale`` one.
    """
    key = [F.col("report_id"), F.coalesce(F.col("parameter_id").cast("string"), F.lit("")).alias("_p"), F.col("stage_no")]
    ran = state.select(*key, F.col("input_hash").alias("_hash"), "completed_at")
    rows = current.withColumn("_p", key[1]).join(ran, ["report_id", "_p", "stage_no"], "left").drop("_p")
    rows = rows.withColumn("_newest", _upstream(F.col("completed_at")))
    reason = (
        F.when(F.col("completed_at").isNull(), "new").when(~F.col("_hash").eqNullSafe(F.col("input_hash")), "input")
        .when(F.col("_newest") > F.col("completed_at"), "upstream newer")
    )
    rows = rows.withColumn("reason", reason)
    behind = _upstream(F.col("reason").isNotNull().cast("int")) == 1
    rows = rows.withColumn("reason", F.coalesce("reason", F.when(behind, "upstream stale")))
    return rows.where("reason IS NOT NULL").select(*SCOPE, "stage_no", "reason")


def invalidate_downstream(status: DataFrame, changed: DataFrame) -> DataFrame:
    """M2: a stage goes stale when an earlier stage that it depends on has changed.

    A changed stage of a report makes all its later stages stale, those of every parameter
    too.  A changed stage of a parameter does so for the parameter's later stages and for
    the report's own record of them.  Tables without ``parameter_id`` have report stages only.
    """
    if "parameter_id" not in status.columns:
        first = changed.groupBy("report_id").agg(F.min("stage_no").alias("_first"))
        joined = status.join(first, "report_id", "left")
        stale = F.coalesce(F.col("stage_no") > F.col("_first"), F.lit(False))
        return joined.withColumn("status", F.when(stale, "stale").otherwise(F.col("status"))).drop("_first")
    of_report = changed.groupBy("report_id").agg(F.min("stage_no").alias("_any"), F.min(F.when(F.col("parameter_id").isNull(), F.col("stage_no"))).alias("_report"))
    own = changed.where("parameter_id IS NOT NULL").groupBy(*SCOPE).agg(F.min("stage_no").alias("_own"))
    joined = status.join(of_report, "report_id", "left").join(own, SCOPE, "left")
    first = F.when(F.col("parameter_id").isNull(), F.col("_any")).otherwise(F.least("_report", "_own"))
    stale = F.coalesce(F.col("stage_no") > first, F.lit(False))
    return joined.withColumn("status", F.when(stale, "stale").otherwise(F.col("status"))).select(status.columns)
