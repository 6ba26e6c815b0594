"""Writers of records and of the page index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FLAT_INDEX = "report_id string, pdf_page int, text_length long, table_count long, contains_table boolean, table_titles string"


def write_records(records: DataFrame, path: str) -> None:
    """A4: records as JSON lines."""
    records.write.json(path)


def flat_page_index(index: DataFrame) -> DataFrame:
    """A5: the page index with its headings in one column."""
    return index.select("report_id", "pdf_page", "text_length", "table_count", "contains_table", F.array_join("titles", "; ").alias("table_titles"))


def write_page_index_csv(index: DataFrame, path: str) -> None:
    """A5, written: one folder of CSV parts, each with the header; running it again leaves the same rows."""
    flat_page_index(index).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def read_page_index_csv(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_page_index_csv`` wrote; headings may hold quotes and line ends."""
    reader = spark.read.schema(FLAT_INDEX).option("header", True).option("multiLine", True).option("escape", '"')
    return reader.csv(path).na.fill("", ["table_titles"])


def write_warehouse(records: DataFrame, path: str, key: str = "parameter_id") -> None:
    """One folder per parameter; rows are dealt by key and a hash, so a hot parameter has many writers."""
    records.repartition(F.col(key), F.pmod(F.xxhash64(*records.columns), F.lit(16))).write.partitionBy(key).parquet(path)


def sheet_name(c: Column) -> Column:
    """A name without the signs that sheets forbid, at most 31 characters long."""
    return F.substring(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\\/*?:\[\]]", "_"), 1, 31)


def by_group(records: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """The rows as written, with the name of their output."""
    return records.select(sheet_name(F.col(group)).alias("sheet"), *columns)


def write_by_group(records: DataFrame, path: str, group: str, columns: list[str], rows_per_file: int = 1_000_000) -> None:
    """A7, written: a folder of sorted files for every group.

    A group has a writer for every ``rows_per_file`` of its rows, chosen by a hash of the
    row, so that a hot group has many and a small one a single file.  Only the folders
    of groups at hand are replaced: a second run leaves the same rows, and groups that
    other runs wrote stay.
    """
    named = by_group(records, group, columns)
    sizes = named.groupBy("sheet").agg(F.ceil(F.count("*") / rows_per_file).cast("int").alias("_writers"))
    dealt = named.join(sizes, "sheet").withColumn("_writer", F.pmod(F.xxhash64(*columns), F.col("_writers")))
    dealt = dealt.repartition("sheet", "_writer").sortWithinPartitions("sheet", *columns).drop("_writers", "_writer")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sheet").parquet(path)
