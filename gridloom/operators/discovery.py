"""From headings to sections: contents lines, aliases, offsets and page ranges (group C)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.dictionary import held_names
from gridloom.operators.index import TOC_LINE


def extract_toc(pages: DataFrame, pattern: str = TOC_LINE, max_pages: int = 15) -> DataFrame:
    """One row per contents line of the first pages: number, title, printed page."""
    lines = pages.where(F.col("pdf_page") <= max_pages).select("report_id", "pdf_page", F.posexplode(F.split("page_text", "\n")).alias("line_no", "line"))
    found = lines.where(F.col("line").rlike(pattern)).select(
        "report_id", "pdf_page", "line_no",
        F.lower(F.regexp_extract("line", pattern, 1)).alias("table_number"),
        F.trim(F.regexp_extract("line", pattern, 2)).alias("title_text"),
        F.regexp_extract("line", pattern, 3).try_cast("int").alias("printed_page"),
    )
    return found.where("printed_page >= 1")


def match_alias(titles: DataFrame, aliases: DataFrame, supported: list[str] | None = None, keys: tuple[str, ...] = ("report_id", "table_number")) -> DataFrame:
    """The first parameter, by priority, whose alias the title contains."""
    kept = aliases if supported is None else aliases.where(F.col("parameter_id").isin(supported))
    kept = kept.withColumn("_name", F.lower("alias"))
    texts = titles.select(F.lower("title_text").alias("text")).distinct()
    held = held_names(texts, kept.select(F.col("_name").alias("name")).distinct())
    hits = titles.withColumn("text", F.lower("title_text")).join(held, "text").join(kept, F.col("name") == F.col("_name")).drop("text", "name", "_name")
    best = Window.partitionBy(*keys).orderBy("priority", "parameter_id")
    return hits.withColumn("place", F.row_number().over(best)).where("place = 1").drop("place", "alias", "priority")


def merge_catalog(toc: DataFrame, index: DataFrame, offsets: DataFrame) -> DataFrame:
    """Contents matches (the last wins) and index matches (the first wins), per parameter."""
    key = ["report_id", "parameter_id"]
    t = toc.groupBy(*key).agg(F.max_by(F.struct("table_number", "title_text", "printed_page"), F.struct("pdf_page", "line_no")).alias("t"))
    i = index.groupBy(*key).agg(F.min_by(F.struct("table_number", "title_text", "pdf_page"), F.struct("pdf_page", "match_no")).alias("i"))
    both = t.join(i, key, "full").join(offsets.select("report_id", "offset"), "report_id", "left")
    source = F.when(F.col("t").isNotNull() & F.col("i").isNotNull(), "merged").when(F.col("t").isNotNull(), "toc").otherwise("index")
    return both.select(
        *key,
        F.coalesce("i.table_number", "t.table_number").alias("table_number"),
        F.coalesce("i.title_text", "t.title_text").alias("title_text"),
        F.coalesce(F.col("i.pdf_page"), F.col("t.printed_page") + F.coalesce("offset", F.lit(0))).alias("anchor_page"),
        source.alias("discovery_source"),
    )


def first_phrase_page(pages: DataFrame, phrases: DataFrame) -> DataFrame:
    """C4: first page, of those given, that contains a phrase; ``missing`` where there is none.

    The result has a row for every report and phrase; phrases are a list that users write.
    """
    all_phrases = phrases.agg(F.collect_set("phrase")).scalar()
    wanted = pages.select("report_id").distinct().select("report_id", F.explode(all_phrases).alias("phrase"))
    names = phrases.select("phrase", F.lower("phrase").alias("name")).distinct()
    texts = pages.select("report_id", "pdf_page", F.lower("page_text").alias("text"))
    held = held_names(texts, names.select("name").distinct(), ["report_id", "pdf_page"])
    hits = held.groupBy("report_id", "name").agg(F.min("pdf_page").alias("pdf_page")).join(names, "name").drop("name")
    return wanted.join(hits, ["report_id", "phrase"], "left").withColumn("missing", F.col("pdf_page").isNull())


def calibrate_offset(hits: DataFrame) -> DataFrame:
    """Most common difference of real and printed page; ties go to the one seen first; 0 by default."""
    delta = hits.withColumn("delta", F.col("pdf_page") - F.col("printed_page"))
    counts = delta.where("delta IS NOT NULL").groupBy("report_id", "delta").agg(F.count("*").alias("n"), F.min("seq").alias("seen"))
    best = Window.partitionBy("report_id").orderBy(F.desc("n"), "seen")
    top = counts.withColumn("place", F.row_number().over(best)).where("place = 1").select("report_id", F.col("delta").alias("offset"))
    out = hits.select("report_id").distinct().join(top, "report_id", "left")
    method = F.when(F.col("offset").isNull(), "default").otherwise("phrase_search")
    return out.select("report_id", F.coalesce("offset", F.lit(0)).alias("offset"), method.alias("method"))


def page_range_anchor_chain(titles: DataFrame, page_counts: DataFrame) -> DataFrame:
    """A section ends before the next heading, the last one with its report."""
    w = Window.partitionBy("report_id").orderBy("pdf_page", "match_no")
    chained = titles.withColumn("next_page", F.lead("pdf_page").over(w)).withColumn("next_title", F.lead("title_text").over(w)).join(page_counts, "report_id")
    last = F.col("next_page").isNull()
    return chained.select(
        "report_id", "table_number", "title_text", "next_title",
        F.col("pdf_page").alias("start_page"),
        F.when(last, F.greatest("pdf_page", "page_count")).otherwise(F.greatest(F.col("pdf_page"), F.col("next_page") - 1)).alias("end_page"),
        F.when(last, "end_of_document").otherwise("next_anchor").alias("boundary_rule"),
    )


def page_range_toc_next(toc: DataFrame, offsets: DataFrame, page_counts: DataFrame) -> DataFrame:
    """Printed pages plus offset, clamped to the report; ends before the next contents entry."""
    w = Window.partitionBy("report_id").orderBy("pdf_page", "line_no")
    placed = toc.join(offsets, "report_id").join(page_counts, "report_id")
    start = F.greatest(F.lit(1), F.least(F.col("printed_page") + F.col("offset"), F.col("page_count")))
    placed = placed.withColumn("start_page", start)
    following = F.lead("start_page").over(w)
    end = F.when(following.isNull(), F.col("page_count")).otherwise(F.greatest(F.col("start_page"), following - 1))
    return placed.select("report_id", "table_number", "title_text", "start_page", end.alias("end_page"))


def page_range_next_anchor(titles: DataFrame, page_counts: DataFrame) -> DataFrame:
    """Ends before the first heading of another number on a later page.

    Pages are taken in order once.  A page with headings of one number continues the run of
    the page before if that has the same one alone.  The next page ends a section unless it
    has the section's number alone; then the page behind its run does.
    """
    numbers = titles.groupBy("report_id", "pdf_page").agg(F.min("table_number").alias("low"), F.max("table_number").alias("high"))
    alone = numbers.select("report_id", "pdf_page", F.when(F.col("low") == F.col("high"), F.col("low")).alias("alone"))
    w = Window.partitionBy("report_id").orderBy("pdf_page")
    down = Window.partitionBy("report_id").orderBy(F.desc("pdf_page"))
    before = F.lag("alone").over(w)
    starts = F.col("alone").isNull() | before.isNull() | (before != F.col("alone"))
    runs = alone.withColumn("start", F.when(starts, F.col("pdf_page")))
    # from the last page upwards, so that the frame only grows
    runs = runs.withColumn("behind", F.last("start", ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, -1)))
    runs = runs.select("report_id", "pdf_page", *[F.lead(c).over(w).alias(f"next_{n}") for c, n in (("pdf_page", "page"), ("alone", "alone"), ("behind", "behind"))])
    joined = titles.join(runs, ["report_id", "pdf_page"]).join(page_counts, "report_id")
    same = F.coalesce(F.col("next_alone") == F.col("table_number"), F.lit(False))
    later = F.when(same, F.col("next_behind")).otherwise(F.col("next_page"))
    end = F.when(later.isNull(), F.col("page_count")).otherwise(F.greatest(F.col("pdf_page"), later - 1))
    return joined.select("report_id", "table_number", F.col("pdf_page").alias("start_page"), end.alias("end_page"))


def page_preview(pages: DataFrame, ranges: DataFrame, lines: int = 15) -> DataFrame:
    """First lines of every page of a range."""
    r = ranges.select(F.col("report_id").alias("r"), "table_number", "start_page", "end_page")
    inside = (F.col("report_id") == F.col("r")) & F.col("pdf_page").between(F.col("start_page"), F.col("end_page"))
    return pages.join(r, inside).select("report_id", "table_number", "pdf_page", F.array_join(F.slice(F.split("page_text", "\n"), 1, lines), "\n").alias("preview"))


def catalog_rollup(catalog: DataFrame, supported: list[str]) -> DataFrame:
    """Parameters, supported ones and sources of every report."""
    return catalog.groupBy("report_id").agg(
        F.count("*").alias("parameter_count"),
        F.count_if(F.col("parameter_id").isin(supported)).alias("supported_count"),
        F.array_join(F.sort_array(F.collect_set("discovery_source")), ",").alias("sources"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("anchor_page", "parameter_id"))), lambda x: x["parameter_id"]), ",").alias("parameters"),
    )


def route_query(queries: DataFrame, keywords: DataFrame, ranges: DataFrame) -> DataFrame:
    """C11: a request's first keyword, the first heading that contains it, and its section."""
    low = keywords.withColumn("name", F.lower("keyword"))
    asked = queries.select("query_id", F.lower("query").alias("text"))
    k = asked.join(held_names(asked.select("text").distinct(), low.select("name").distinct()), "text").join(low, "name")
    k = k.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy("priority"))).where("place = 1").select("query_id", "keyword", "name")
    titled = ranges.withColumn("text", F.lower("title_text"))
    hits = titled.join(held_names(titled.select("text").distinct(), k.select("name").distinct()), "text").join(k, "name")
    first = Window.partitionBy("query_id", "report_id").orderBy("start_page", "table_number")
    return hits.withColumn("place", F.row_number().over(first)).where("place = 1").select("query_id", "keyword", "report_id", "title_text", "start_page", "end_page")


def apply_range_overrides(ranges: DataFrame, overrides: DataFrame) -> DataFrame:
    """``12-14`` or ``12`` replaces a range; what cannot be read leaves the suggestion."""
    text = F.trim("override")
    low = F.regexp_extract(text, r"^(\d+)(?:\s*-\s*(\d+))?$", 1).try_cast("int")
    high = F.coalesce(F.regexp_extract(text, r"^(\d+)\s*-\s*(\d+)$", 2).try_cast("int"), low)
    valid = low.isNotNull() & (low >= 1) & (low <= high)
    joined = ranges.join(overrides, ["report_id", "table_number"], "left")
    return joined.select(
        "report_id", "table_number",
        F.when(valid, low).otherwise(F.col("start_page")).alias("start_page"),
        F.when(valid, high).otherwise(F.col("end_page")).alias("end_page"),
        F.when(valid, "user").otherwise("suggested").alias("source"),
    )


def toc_ranges(toc: DataFrame) -> DataFrame:
    """Ends one page before the next start; the last end is open."""
    w = Window.partitionBy("report_id").orderBy("printed_page", "line_no")
    return toc.select("report_id", "table_number", F.col("printed_page").alias("start_page"), (F.lead("printed_page").over(w) - 1).alias("end_page"))


def select_parameters(catalog: DataFrame, requests: DataFrame) -> DataFrame:
    """C14: the requested parameters of a report; all of them for ``all``, blank, or no match."""
    wanted = F.transform(F.split(F.lower(F.coalesce("request", F.lit(""))), ","), lambda w: F.trim(w))
    joined = catalog.join(requests, "report_id", "left").withColumn("wanted", wanted)
    named = F.array_contains("wanted", F.lower("parameter_id"))
    some = F.max(named).over(Window.partitionBy("report_id"))
    everything = F.trim(F.lower(F.coalesce("request", F.lit("")))).isin("", "all")
    return joined.withColumn("some", some).where(everything | named | ~F.col("some")).select("report_id", "parameter_id")
