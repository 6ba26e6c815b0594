"""Page index that grows as pages and their tables land (M3).

Repeated deliveries are dropped by content within the watermark, and a page meets its
tables within a bounded time, so Spark bounds the state of every step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.index import detect_titles, drop_toc_pages, page_titles

ARRIVALS = "report_id string, pdf_page int, page_text string, arrived timestamp"
TABLE_ARRIVALS = "report_id string, pdf_page int, table_idx int, arrived timestamp"


def page_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(ARRIVALS).parquet(path)


def table_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(TABLE_ARRIVALS).parquet(path)


def stream_titles(pages: DataFrame, late: str = "1 hour") -> DataFrame:
    """Headings of new pages; works on a stream and on a batch alike."""
    named = pages.withColumn("content", F.sha2(F.concat_ws("\f", "report_id", F.col("pdf_page").cast("string"), "page_text"), 256))
    if pages.isStreaming:
        named = named.withWatermark("arrived", late).dropDuplicatesWithinWatermark(["content"])
    else:
        named = named.dropDuplicates(["content"])
    return detect_titles(drop_toc_pages(named))


def _first_arrivals(rows: DataFrame, keys: list[str], late: str) -> DataFrame:
    """Each key once; rows without a report only tell the time."""
    # the condition names the time, so that it stays behind the watermark
    timed = rows.withWatermark("arrived", late).where(F.col("report_id").isNotNull() | F.col("arrived").isNull())
    return timed.dropDuplicatesWithinWatermark(keys)


def stream_page_index(pages: DataFrame, tables: DataFrame, late: str = "1 hour") -> DataFrame:
    """Every page once, with text length, number of tables and headings, when its time is over.

    ``pages`` and ``tables`` are streams of pages and of the tables found on them, in any
    order and repeatedly.  A page waits ``late`` for its tables; rows with a null
    report_id move the time on where no more pages come.
    """
    # read before pages are told apart, so that no text is shuffled
    read = pages.select("report_id", "pdf_page", "arrived", F.length("page_text").cast("long").alias("text_length"), page_titles(F.col("page_text")).alias("titles"))
    first = _first_arrivals(read, ["report_id", "pdf_page"], late)
    page = first.select("report_id", "pdf_page", F.col("arrived").alias("seen"), "text_length", "titles")
    found = _first_arrivals(tables, ["report_id", "pdf_page", "table_idx"], late)
    found = found.select(F.col("report_id").alias("_r"), F.col("pdf_page").alias("_p"), "table_idx", F.col("arrived").alias("found"))
    near = F.expr(f"found >= seen - interval {late} AND found <= seen + interval {late}")
    joined = page.join(found, (F.col("report_id") == F.col("_r")) & (F.col("pdf_page") == F.col("_p")) & near, "left_outer")
    counted = joined.groupBy("report_id", "pdf_page", "seen").agg(F.first("text_length").alias("text_length"), F.count("table_idx").alias("table_count"), F.first("titles").alias("titles"))
    return counted.select("report_id", "pdf_page", "text_length", "table_count", (F.col("table_count") > 0).alias("contains_table"), "titles")


def _run(frame: DataFrame, target: str, checkpoint: str) -> None:
    query = frame.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def index_available(spark: SparkSession, source: str, target: str, checkpoint: str) -> None:
    """Index the headings of all pages that have landed since the last call, and stop."""
    _run(stream_titles(page_stream(spark, source)), target, checkpoint)


def whole_index_available(spark: SparkSession, pages: str, tables: str, target: str, checkpoint: str, late: str = "1 hour") -> None:
    """Index all pages whose time is over, with their tables, and stop."""
    _run(stream_page_index(page_stream(spark, pages), table_stream(spark, tables), late), target, checkpoint)
