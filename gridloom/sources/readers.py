"""Readers of page text, raw grids and stored records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PAGES = "report_id string, pdf_page int, page_text string"
ROWS = "report_id string, pdf_page int, table_idx int, row_idx int, cells array<string>"


def clean_pages(pages: DataFrame) -> DataFrame:
    """Null page text is empty; pages below 1 are dropped."""
    return pages.where("pdf_page >= 1").withColumn("page_text", F.coalesce("page_text", F.lit("")))


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A1: page text from Parquet or JSON with a declared schema, so no scan is spent on inference."""
    reader = spark.read if fmt == "parquet" else spark.read.schema(PAGES)
    return clean_pages(reader.format(fmt).load(path).select("report_id", F.col("pdf_page").cast("int"), F.col("page_text").cast("string")))


def string_cells(rows: DataFrame) -> DataFrame:
    """Every cell a string; null cells, and null rows of cells, are empty."""
    cells = F.coalesce(F.col("cells"), F.array().cast("array<string>"))
    return rows.withColumn("cells", F.transform(cells, lambda c: F.coalesce(c.cast("string"), F.lit(""))))


def read_raw_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A2: ragged grids."""
    reader = spark.read if fmt == "parquet" else spark.read.schema(ROWS)
    return string_cells(reader.format(fmt).load(path))


def read_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A4: records stored as JSON, read with their schema."""
    return spark.read.schema(schema).json(path)


def content_identity(pages: DataFrame, block: int = 1024) -> DataFrame:
    """SHA-256 of a report; the identity is its first 16 digits.

    It is the hash of the hashes of blocks of ``block`` page numbers, each the hash of its
    pages' hashes, in page order, so no row ever holds more than one page of text.
    """

    def combined(place: str, digest: str) -> Column:
        parts = F.sort_array(F.collect_list(F.struct(place, digest)))
        return F.sha2(F.array_join(F.transform(parts, lambda p: p[digest]), ""), 256)

    hashed = pages.select("report_id", "pdf_page", F.floor(F.col("pdf_page") / block).alias("block_no"), F.sha2("page_text", 256).alias("page_hash"))
    blocks = hashed.groupBy("report_id", "block_no").agg(combined("pdf_page", "page_hash").alias("block_hash"), F.count("*").alias("n"))
    whole = blocks.groupBy("report_id").agg(combined("block_no", "block_hash").alias("content_hash"), F.sum("n").alias("page_count"))
    return whole.select("report_id", "content_hash", F.substring("content_hash", 1, 16).alias("content_id"), "page_count")
