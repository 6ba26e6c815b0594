"""Raw grids of many pages to one grid per table (group D)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.text import is_blank

PAGE = ["report_id", "pdf_page"]


def candidate_tables(rows: DataFrame) -> DataFrame:
    """Shape of every table of every page, and how many tables the page has."""
    shape = rows.groupBy(*PAGE, "table_idx").agg(
        F.count("*").alias("row_count"),
        F.max(F.size("cells")).alias("column_count"),
        F.min_by(F.array_join("cells", " "), "row_idx").alias("sample"),
    )
    per_page = F.count("*").over(Window.partitionBy(*PAGE))
    return shape.withColumn("area", F.col("row_count") * F.col("column_count")).withColumn("tables_on_page", per_page)


def select_primary_table(rows: DataFrame, heuristic: str = "largest_area", index: int = 0) -> DataFrame:
    """The rows of one table a page: the largest (first of equals), the first, or by index.

    Tables are counted first, and one a page is joined back by hashing, so no task sorts
    or keeps rows; ``rows`` are read twice and should be written.
    """
    tables = rows.groupBy(*PAGE, "table_idx").agg((F.count("*") * F.max(F.size("cells"))).alias("_area"))
    if heuristic == "largest_area":
        best = F.max(F.struct("_area", (-F.col("table_idx")).alias("_first")))
        chosen = tables.groupBy(*PAGE).agg((-best["_first"]).alias("_best"))
    else:
        page = Window.partitionBy(*PAGE)
        wanted = 0 if heuristic == "first_table" else index
        placed = tables.withColumn("_place", F.dense_rank().over(page.orderBy("table_idx")) - 1).withColumn("_last", F.max("_place").over(page))
        chosen = placed.where(F.col("_place") == F.when(F.col("_last") >= wanted, F.lit(wanted)).otherwise(0)).select(*PAGE, F.col("table_idx").alias("_best"))
    chosen = chosen.select(*[F.col(c).alias(f"_{c}") for c in PAGE], "_best").hint("shuffle_hash")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PAGE]
    return rows.join(chosen, [*same, F.col("table_idx") == F.col("_best")], "left_semi")


def extract_in_range(rows: DataFrame, pages: DataFrame, ranges: DataFrame) -> DataFrame:
    """D3: pages of a confirmed range that exist, with their rows, or a warning where there are none; a range turned round holds no page."""
    wanted = ranges.where("start_page <= end_page").select("report_id", F.explode(F.sequence("start_page", "end_page")).alias("pdf_page")).distinct()
    inside = wanted.join(pages.select(*PAGE).distinct(), PAGE, "left_semi")
    joined = inside.join(rows, PAGE, "left")
    return joined.withColumn("warning", F.when(F.col("cells").isNull(), "no table on page").when(~F.exists("cells", lambda c: ~is_blank(c)), "empty row"))


def range_id(ranges: DataFrame) -> DataFrame:
    """First 16 hex digits of the SHA-256 of ``start-end``."""
    return ranges.withColumn("range_id", F.substring(F.sha2(F.concat(F.col("start_page").cast("string"), F.lit("-"), F.col("end_page").cast("string")), 256), 1, 16))


def with_repeats(rows: DataFrame, key: str = "report_id", most: int = 5) -> DataFrame:
    """Rows with their place on the page, the header height of their table, and whether they repeat its header.

    Each of the first ``most`` rows of a page has a digest of all rows of the page so far.
    Pages begin alike down to the last row whose digest is that of the first page, which
    is one comparison of equals; the header is as high as the longest such start.  All
    windows lie over the same rows in the same order, so the rows are dealt and sorted once.
    """
    report = Window.partitionBy(key).orderBy("pdf_page", "table_idx", "row_idx")
    whole, page = Window.partitionBy(key), Window.partitionBy(key, "pdf_page")
    in_page = page.orderBy("table_idx", "row_idx")
    start = F.array(*[F.lag("cells", k).over(in_page) for k in range(most - 1, 0, -1)], F.col("cells"))
    out = rows.withColumns({"first_page": F.first("pdf_page").over(report), "page_row": F.row_number().over(in_page), "_start": start})
    out = out.withColumn("_digest", F.when(F.col("page_row") <= most, F.sha2(F.to_json("_start"), 256))).drop("_start")
    own = F.col("pdf_page") == F.col("first_page")
    out = out.withColumn("_first", F.array(*[F.max(F.when(own & (F.col("page_row") == k), F.col("_digest"))).over(whole) for k in range(1, most + 1)]))
    out = out.withColumn("_same", F.when(~own & (F.get("_first", F.col("page_row") - 1) == F.col("_digest")), F.col("page_row")))
    out = out.withColumn("header_height", F.coalesce(F.max("_same").over(whole), F.lit(0)))
    whole_header = (F.max("_same").over(page) >= F.col("header_height")) & (F.col("header_height") > 0)
    repeated = F.coalesce(whole_header, F.lit(False)) & (F.col("page_row") <= F.col("header_height"))
    return out.withColumn("repeated", repeated).drop("_digest", "_first", "_same")


def detect_header_height(rows: DataFrame, key: str = "report_id", most: int = 5) -> DataFrame:
    """How many first rows of the first page any later page starts with, ``most`` at most."""
    return with_repeats(rows, key, most).groupBy(key).agg(F.max("header_height").alias("header_height"))


def merge_pages(rows: DataFrame, key: str = "report_id", most: int = 5) -> DataFrame:
    """All pages in order, the header of later pages stripped where it is repeated exactly."""
    order = Window.partitionBy(key).orderBy("pdf_page", "table_idx", "row_idx")
    kept = with_repeats(rows, key, most).where("NOT repeated")
    return kept.select(key, F.row_number().over(order).alias("row_no"), "pdf_page", "cells")


def pad_rows(rows: DataFrame, key: str = "report_id") -> DataFrame:
    """Rows padded on the right to the widest of their table."""
    widest = F.max(F.size("cells")).over(Window.partitionBy(key))
    return rows.withColumn("width", widest).withColumn("cells", F.concat("cells", F.array_repeat(F.lit(""), F.col("width") - F.size("cells")))).drop("width")


def merge_log(rows: DataFrame, key: str = "report_id", most: int = 5) -> DataFrame:
    """Rows added and header rows removed on every page, with a hash of the page's kept rows in order."""
    kept = F.when(~F.col("repeated"), F.struct("page_row", "cells"))
    lines = F.transform(F.sort_array(F.collect_list(kept)), lambda r: F.array_join(r["cells"], "|"))
    log = with_repeats(rows, key, most).groupBy(key, "pdf_page").agg(
        F.count_if(~F.col("repeated")).alias("rows_added"),
        F.count_if(F.col("repeated")).alias("headers_removed"),
        F.sha2(F.array_join(lines, "\n"), 256).alias("page_hash"),
    )
    return log.withColumn("page_hash", F.when(F.col("rows_added") > 0, F.col("page_hash")).otherwise(""))


def drop_keyword_headers(rows: DataFrame, phrases: list[str], least: int = 2) -> DataFrame:
    """Rows that hold at least ``least`` of the header phrases are dropped."""
    text = F.lower(F.array_join("cells", " "))
    hits = sum((F.contains(text, F.lit(p.lower())).cast("int") for p in phrases), F.lit(0))
    return rows.where(hits < least)


def skip_header_rows(rows: DataFrame, n: int = 1) -> DataFrame:
    """The first ``n`` rows of every table are dropped, and tables of fewer than two rows."""
    table = Window.partitionBy(*PAGE, "table_idx")
    counted = rows.withColumn("n", F.count("*").over(table)).withColumn("place", F.row_number().over(table.orderBy("row_idx")))
    return counted.where((F.col("n") >= 2) & (F.col("place") > n)).drop("n", "place")
