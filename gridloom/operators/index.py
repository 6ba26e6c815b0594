"""Page indexing and search (group B)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.dictionary import held_names

# fixed values: heading and contents-line patterns
TITLE = r"(?i)TABLE[- ]?\d+(?:\([A-Z]\))?\s*:\s*([^\n]+)"
TOC_LINE = r"(?i)TABLE[- ]?(\d+(?:\([A-Z]\))?)\s*:\s*(.*?)\s+(\d+)"
NUMBER = r"\d+(?:\([a-zA-Z]\))?"


def toc_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(TOC_LINE))


def drop_toc_pages(pages: DataFrame, most: int = 2) -> DataFrame:
    """B2: pages with more than ``most`` contents lines are dropped."""
    return pages.where(F.size(toc_lines(F.col("page_text"))) <= most)


def detect_titles(pages: DataFrame, pattern: str = TITLE) -> DataFrame:
    """B1: one row per heading: match_no, table_number, title_text, raw_text."""
    text = F.col("page_text")
    found = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("raw"), F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("title"))
    rows = pages.select("report_id", "pdf_page", F.posexplode(found).alias("match_no", "m"))
    number = F.regexp_extract(F.col("m.raw"), NUMBER, 0)
    return rows.select(
        "report_id", "pdf_page", "match_no", F.lower(number).alias("table_number"), F.trim("m.title").alias("title_text"),
        F.trim(F.replace(F.col("m.raw"), number, F.lower(number))).alias("raw_text"),
    )


def page_titles(text: Column, pattern: str = TITLE, most: int = 2) -> Column:
    """The headings of a page in order, none of a contents page: B1 and B2 as one expression."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), _with_lower_number)
    return F.when(F.size(toc_lines(text)) <= most, found).otherwise(F.array().cast("array<string>"))


def _with_lower_number(raw: Column) -> Column:
    number = F.regexp_extract(raw, NUMBER, 0)
    return F.trim(F.replace(raw, number, F.lower(number)))


def build_page_index(pages: DataFrame, tables: DataFrame, titles: DataFrame) -> DataFrame:
    """Text length, number of tables and headings of every page."""
    key = ["report_id", "pdf_page"]
    n = tables.groupBy(*key).agg(F.count_distinct("table_idx").alias("table_count"))
    names = titles.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("match_no", "raw_text"))).alias("found"))
    return (
        pages.join(n, key, "left")
        .join(names, key, "left")
        .select(
            *key,
            F.length("page_text").cast("long").alias("text_length"),
            F.coalesce("table_count", F.lit(0)).cast("long").alias("table_count"),
            (F.coalesce("table_count", F.lit(0)) > 0).alias("contains_table"),
            F.coalesce(F.transform("found", lambda t: t["raw_text"]), F.array().cast("array<string>")).alias("titles"),
        )
    )


def page_index_rollup(index: DataFrame) -> DataFrame:
    """Pages, pages with headings and with tables, and the heading pages, of every report."""
    anchored = F.size("titles") > 0
    return index.groupBy("report_id").agg(
        F.count("*").alias("page_count"),
        F.count_if(anchored).alias("pages_with_titles"),
        F.count_if("contains_table").alias("pages_with_tables"),
        F.array_join(F.sort_array(F.collect_set(F.when(anchored, F.col("pdf_page")))), ",").alias("anchor_pages"),
    )


def tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != ""))


def page_search(pages: DataFrame, queries: DataFrame, limit: int = 20) -> DataFrame:
    """Pages that hold every token of a query, the first ``limit`` in page order.

    An inverted index joined on the token; a page hits when all tokens of the query met.
    """
    terms = queries.select("query_id", F.explode(tokens(F.col("query"))).alias("term"))
    terms = terms.withColumn("n_terms", F.count("*").over(Window.partitionBy("query_id")))
    wanted = terms.select("term").distinct()
    index = pages.select("report_id", "pdf_page", F.explode(tokens(F.col("page_text"))).alias("term")).join(wanted, "term")
    hits = index.join(terms, "term").groupBy("query_id", "report_id", "pdf_page", "n_terms").agg(F.count("*").alias("n")).where("n = n_terms")
    order = Window.partitionBy("query_id").orderBy("report_id", "pdf_page")
    return hits.select("query_id", "report_id", "pdf_page", F.row_number().over(order).alias("place")).where(F.col("place") <= limit)


def title_catalog(titles: DataFrame, min_page: int = 1, least: int = 8) -> DataFrame:
    """Distinct squeezed headings of every page, longer than ``least``, joined and split again."""
    clean = F.trim(F.regexp_replace("title_text", r"\s+", " "))
    joined = titles.select("report_id", "pdf_page", clean.alias("title")).where(F.length("title") > least).groupBy("report_id", "pdf_page").agg(F.array_join(F.sort_array(F.collect_set("title")), " | ").alias("titles"))
    rows = joined.where(F.col("pdf_page") >= min_page).select("report_id", "pdf_page", F.explode(F.split("titles", r" \| ")).alias("title"))
    return rows.where(F.length("title") >= 5)


def phrase_pages(pages: DataFrame, phrases: DataFrame, lines: int = 3) -> DataFrame:
    """Pages that contain a phrase, case ignored, with their first lines."""
    preview = F.array_join(F.slice(F.split("page_text", "\n"), 1, lines), "\n")
    named = phrases.withColumn("name", F.upper("phrase"))
    texts = pages.select("report_id", "pdf_page", F.upper("page_text").alias("text"))
    held = held_names(texts, named.select("name").distinct(), ["report_id", "pdf_page"]).join(named, "name")
    return pages.join(held, ["report_id", "pdf_page"]).select("phrase", "report_id", "pdf_page", preview.alias("preview"))
