"""Keyword queries over records and blocks (group L)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.dictionary import held_names

# fixed values
STOP_WORDS = ("extract", "show", "find", "get", "what", "is", "the", "charges", "charge", "open", "access", "for", "of", "in")


def detect_query_group(queries: DataFrame, groups: DataFrame) -> DataFrame:
    """L1: the longest group name that the query contains; null where there is none."""
    named = groups.select("group", F.lower("group").alias("name")).distinct()
    asked = queries.select("query_id", F.lower("query").alias("text"))
    hits = asked.join(held_names(asked.select("text").distinct(), named.select("name").distinct()), "text").join(named, "name")
    best = hits.groupBy("query_id").agg(F.max_by("group", F.struct(F.length("group"), "group")).alias("group"))
    return queries.join(best, "query_id", "left")


def query_keywords(queries: DataFrame) -> DataFrame:
    """L2: words of the query without the group's name and stop words, in order."""
    rest = F.replace(F.lower("query"), F.lower(F.coalesce("group", F.lit(""))), F.lit(" "))
    rest = F.when(F.coalesce("group", F.lit("")) == "", F.lower("query")).otherwise(rest)
    words = F.regexp_extract_all(rest, F.lit(r"[a-z0-9]+"), F.lit(0))
    return queries.withColumn("keywords", F.filter(words, lambda w: ~w.isin(*STOP_WORDS)))


def score_rows(queries: DataFrame, records: DataFrame) -> DataFrame:
    """L3: number of keywords that a record of the query's group contains."""
    text = F.lower(F.regexp_replace("search_text", r"[^A-Za-z0-9]+", " "))
    score = F.size(F.filter("keywords", lambda w: text.contains(w)))
    return queries.join(records, "group").withColumn("score", score)


def ranked_search(queries: DataFrame, records: DataFrame, n: int = 20) -> DataFrame:
    """L4: the ``n`` best records of every query by score, then position; a row without a record where no group was found."""
    scored = score_rows(queries.where("group IS NOT NULL"), records).where("score > 0")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "position")
    top = scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).select("query_id", "place", "position", "score", F.lit("ok").alias("status"))
    none = queries.where("group IS NULL").select("query_id", F.lit(None).cast("int").alias("place"), F.lit(None).cast("long").alias("position"), F.lit(0).alias("score"), F.lit("no group").alias("status"))
    return top.withColumn("position", F.col("position").cast("long")).unionByName(none)


def block_catalog(rows: DataFrame) -> DataFrame:
    """State, first page, rows and search text of every block."""
    lines = F.transform(F.sort_array(F.collect_list(F.struct("row_no", F.array_join(F.filter("cells", lambda c: c != ""), " ").alias("t")))), lambda r: r["t"])
    return rows.groupBy("report_id", "block_no").agg(F.min_by("state", "row_no").alias("state"), F.min("pdf_page").alias("start_page"), F.count("*").alias("row_count"), F.array_join(lines, " ").alias("search_text"))


def retrieve_block(terms: DataFrame, blocks: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of the first block of a report whose state contains the term."""
    named = terms.select("term", F.lower("term").alias("name")).distinct()
    placed = blocks.select("report_id", "block_no", F.lower("state").alias("text"))
    held = held_names(placed.select("text").distinct(), named.select("name").distinct()).join(named, "name")
    hit = placed.join(held, "text").groupBy("term", "report_id").agg(F.min("block_no").alias("block_no"))
    return rows.join(hit, ["report_id", "block_no"]).select("term", "report_id", "block_no", "row_no")
