"""Shaping of records for output (group K)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.text import is_blank


def flatten_records(records: DataFrame, fields: list[str]) -> DataFrame:
    """K1: fields with identity, confidence and joined pages; ``state_level`` is blank."""
    plain = [F.when(F.col(f).cast("string") == "state_level", F.lit("")).otherwise(F.col(f).cast("string")).alias(f) for f in fields]
    return records.select("record_id", "parameter_id", "confidence", F.array_join("pages", ",").alias("source_pages"), *plain)


def order_columns(df: DataFrame, schema: list[str], exclude: tuple[str, ...] = ()) -> DataFrame:
    """K2: schema columns (null where missing), then confidence and pages, identities, and the rest."""
    tail = [c for c in ("confidence", "source_pages", "record_id", "parameter_id") if c in df.columns]
    rest = [c for c in df.columns if c not in schema and c not in tail]
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in [*schema, *tail, *rest] if c not in exclude])


def sort_output(df: DataFrame) -> DataFrame:
    """K3: by the naming columns that are present, nulls last."""
    keys = [c for c in ("state", "utility", "discom", "consumer_category", "consumer_subcategory") if c in df.columns]
    return df.orderBy(*[F.asc_nulls_last(k) for k in keys])


def rename_display(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """K4: display names."""
    return df.withColumnsRenamed(names)


def summary_dashboard(records: DataFrame, reports: DataFrame) -> DataFrame:
    """K5: records, states, status and export flag of every parameter."""
    per = records.groupBy("parameter_id").agg(F.count("*").alias("record_count"), F.count_distinct("state").alias("state_count"))
    status = F.when(F.col("passed"), "PASSED").otherwise("FAILED")
    return per.join(reports, "parameter_id", "left").select("parameter_id", "record_count", "state_count", status.alias("status"), F.coalesce("export_allowed", F.lit(False)).alias("export_allowed"))


def confidence_band(df: DataFrame, charges: list[str]) -> DataFrame:
    """K6: green, yellow or red, and charges with two decimals."""
    band = F.when(F.col("confidence") >= 0.9, "green").when(F.col("confidence") >= 0.7, "yellow").otherwise("red")
    return df.withColumn("band", band).withColumns({c: F.round(c, 2) for c in charges})


def column_profile(rows: DataFrame, key: str = "report_id") -> DataFrame:
    """K7: filled cells, longest text and display width of every column position."""
    cells = rows.select(key, F.posexplode("cells").alias("col_idx", "cell"))
    filled = ~is_blank(F.col("cell"))
    longest = F.max(F.length("cell"))
    return cells.groupBy(key, "col_idx").agg(F.count_if(filled).alias("non_blank"), F.max(filled).alias("active"), longest.alias("max_length"), F.least(F.greatest(longest + 3, F.lit(10)), F.lit(50)).alias("display_width"))


def by_group_view(df: DataFrame, group: str, columns: dict[str, list[str]], group_col: str = "state") -> DataFrame:
    """K8: the rows of one group, each column from the first of its names that is present."""

    def pick(names: list[str]) -> Column:
        found = [F.col(n).cast("string") for n in names if n in df.columns]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    return df.where(F.col(group_col) == group).select(*[pick(n).alias(c) for c, n in columns.items()]).orderBy(*[F.asc_nulls_last(c) for c in list(columns)[:2]])


def ranked(df: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("place") <= n)
