"""Checks of records, catalogs and structure (group J); every check is one grouped aggregate or anti join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.sources.scratch import written

KEY = "parameter_id"


def blank(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name).cast("string")), F.lit("")) == ""


def missing(name: str) -> Column:
    """Null for rates: blank, or the words for not available."""
    return blank(name) | F.upper(F.trim(F.col(name).cast("string"))).isin("N/A", "NA", "NOT AVAILABLE")


def _checks(counts: DataFrame, rule: str, severity: str, metric: str, limit: Column | float = 0) -> DataFrame:
    value = F.col(metric).cast("double")
    return counts.select(KEY, F.lit(rule).alias("rule_id"), F.lit(severity).alias("severity"), (value <= limit).alias("passed"), value.alias("metric"))


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def check_required(records: DataFrame, required: list[str], severity: str = "error") -> DataFrame:
    """Blank values of every required column."""
    counts = records.groupBy(KEY).agg(*[F.count_if(blank(c)).alias(c) for c in required])
    long = counts.unpivot([KEY], required, "column", "n")
    return long.select(KEY, F.concat(F.lit("required."), "column").alias("rule_id"), F.lit(severity).alias("severity"), (F.col("n") == 0).alias("passed"), F.col("n").cast("double").alias("metric"))


def check_duplicate_ids(records: DataFrame, column: str = "record_id") -> DataFrame:
    """Records that repeat an identity after its first use."""
    per = records.groupBy(KEY, column).agg((F.count("*") - 1).alias("n")).groupBy(KEY).agg(F.sum("n").alias("n"))
    return _checks(per, "duplicate_id", "error", "n")


def check_composite_duplicates(records: DataFrame, keys: list[str], severity: str = "warning") -> DataFrame:
    """Records that repeat the lower-cased, trimmed key columns that are present."""
    present = [F.lower(F.trim(F.coalesce(F.col(k).cast("string"), F.lit("")))).alias(k) for k in keys if k in records.columns]
    per = records.select(KEY, *present).groupBy(KEY, *[k for k in keys if k in records.columns]).agg((F.count("*") - 1).alias("n"))
    return _checks(per.groupBy(KEY).agg(F.sum("n").alias("n")), "composite_duplicate", severity, "n")


def check_catalog_membership(records: DataFrame, names: DataFrame, column: str = "state") -> DataFrame:
    """Non-blank values that no catalog name or alias equals (``names`` has alias)."""
    values = records.where(~blank(column)).select(KEY, F.lower(F.trim(column)).alias("alias"))
    bad = values.join(names.select(F.lower("alias").alias("alias")).distinct(), "alias", "left_anti").groupBy(KEY).agg(F.count("*").alias("n"))
    out = records.select(KEY).distinct().join(bad, KEY, "left").na.fill(0, ["n"])
    return _checks(out, f"catalog.{column}", "error", "n")


def check_range(records: DataFrame, column: str, low: float = 0.0, high: float = 1000.0) -> DataFrame:
    """Numbers outside the range."""
    per = records.groupBy(KEY).agg(F.count_if(~F.col(column).between(low, high)).alias("n"))
    return _checks(per, f"range.{column}", "warning", "n")


def check_null_rates(records: DataFrame, limits: dict[str, float], value_fields: list[str] = (), value_limit: float = 0.2) -> DataFrame:
    """Share of missing values of every column that is present, against its limit; ``value_fields`` that are present have one share together."""
    used = {c: v for c, v in limits.items() if c in records.columns}
    pooled = [c for c in value_fields if c in records.columns]
    rates = {c: F.avg(missing(c).cast("double")) for c in used}
    if pooled:
        rates["values"] = reduce(lambda a, b: a + b, [F.count_if(missing(c)) for c in pooled]) / (F.count("*") * len(pooled))
        used = {**used, "values": value_limit}
    rates = records.groupBy(KEY).agg(*[r.alias(c) for c, r in rates.items()])
    return union([_checks(rates.select(KEY, F.col(c)), f"null_rate.{c}", "warning", c, v) for c, v in used.items()])


def check_min_records(records: DataFrame, least: int) -> DataFrame:
    """At least so many records."""
    per = records.groupBy(KEY).agg(F.count("*").alias("n"))
    return per.select(KEY, F.lit("min_records").alias("rule_id"), F.lit("error").alias("severity"), (F.col("n") >= least).alias("passed"), F.col("n").cast("double").alias("metric"))


def check_coverage(records: DataFrame, names: DataFrame, least: int, column: str = "state") -> DataFrame:
    """Distinct canonical names that the records reach."""
    found = records.select(KEY, F.lower(F.trim(column)).alias("alias")).join(names.select(F.lower("alias").alias("alias"), "canonical"), "alias")
    per = found.groupBy(KEY).agg(F.count_distinct("canonical").alias("n"))
    out = records.select(KEY).distinct().join(per, KEY, "left").na.fill(0, ["n"])
    return out.select(KEY, F.lit("coverage").alias("rule_id"), F.lit("warning").alias("severity"), (F.col("n") >= least).alias("passed"), F.col("n").cast("double").alias("metric"))


def recalibrate_confidence(records: DataFrame, names: DataFrame, fields: list[str]) -> DataFrame:
    """.95 with all fields filled, else .8; at most .5 for an unknown state, at most .3 for a column label as utility."""
    known = names.select(F.lower("alias").alias("_alias"), F.lit(True).alias("_known")).distinct()
    joined = records.join(known, F.lower(F.trim("state")) == F.col("_alias"), "left")
    full = reduce(lambda a, b: a & b, [~blank(f) for f in fields])
    score = F.when(full, 0.95).otherwise(0.8)
    score = F.when(F.col("_known").isNull(), F.least(score, F.lit(0.5))).otherwise(score)
    score = F.when(F.col("utility").rlike(r"^Col \d+$"), F.least(score, F.lit(0.3))).otherwise(score)
    return joined.withColumn("confidence", score).drop("_alias", "_known")


def lineage(records: DataFrame, position: str = "position", column: str = "record_id", block: int = 1024, levels: int = 3) -> DataFrame:
    """One digest of the record identities of every parameter in the order of ``position``.

    It is the root of a tree of hashes: identities of ``block`` positions are hashed
    together in order, then the hashes of ``block`` blocks, and so on, so that no row holds
    more than a block.  Equal positions are taken in the order of their identities.
    """
    level = records.select(KEY, F.col(position).cast("long").alias("at"), F.col(column).cast("string").alias("part"))
    for turn in range(levels + 1):
        keys = [F.col(KEY)] if turn == levels else [F.col(KEY), F.floor(F.col("at") / block).alias("at")]
        parts = F.sort_array(F.collect_list(F.struct("at", "part")))
        level = level.groupBy(*keys).agg(F.sha2(F.array_join(F.transform(parts, lambda p: p["part"]), ""), 256).alias("part"))
    return level.select(KEY, F.col("part").alias("lineage_hash"))


def validation_report(checks: DataFrame, max_warnings: int = 5, max_errors: int = 0, records: DataFrame | None = None) -> DataFrame:
    """Failed errors and warnings of every parameter, whether it may be exported, and the lineage of its ``records`` (which have a ``position``)."""
    failed = ~F.col("passed")
    per = checks.groupBy(KEY).agg(F.count_if(failed & (F.col("severity") == "error")).alias("errors"), F.count_if(failed & (F.col("severity") == "warning")).alias("warnings"), F.count("*").alias("checks"))
    per = per.withColumn("passed", F.col("errors") == 0).withColumn("export_allowed", (F.col("errors") <= max_errors) & (F.col("warnings") <= max_warnings))
    return per if records is None else per.join(lineage(records), KEY, "left")


def coverage_summary(records: DataFrame, value: str = "value") -> DataFrame:
    """Records, the distinct states and utilities, and the share without a value.

    Records are counted by state and utility once.  The names of a parameter are put in order in
    ranges of names, many at a time, and a row joins the texts of the ranges, so
    no task sorts or holds all names of a parameter one by one.
    """
    counts = records.groupBy(KEY, "state", "utility").agg(F.count("*").alias("n"), F.count_if(F.col(value).isNull()).alias("empty"))
    counts = written(counts, "coverage")
    out = counts.groupBy(KEY).agg(F.sum("n").alias("record_count"), (F.sum("empty") / F.sum("n")).alias("null_rate"))
    named = lambda c: counts.where(F.col(c).isNotNull()).select(KEY, F.col(c).alias("name")).distinct()
    names = written(named("state").select(KEY, F.lit("states").alias("field"), "name").unionByName(named("utility").select(KEY, F.lit("utilities").alias("field"), "name")), "names")
    told = ~blank("name")
    ranges = names.repartitionByRange(KEY, "field", "name").groupBy(KEY, "field", F.spark_partition_id().alias("range"))
    part = ranges.agg(F.array_join(F.sort_array(F.collect_list(F.when(told, F.col("name")))), ",").alias("part"), F.min(F.when(told, F.col("name"))).alias("first"), F.count("*").alias("n"))
    parts = F.sort_array(F.collect_list(F.when(F.col("first").isNotNull(), F.struct("first", "part"))))
    joined = part.groupBy(KEY, "field").agg(F.array_join(F.transform(parts, lambda p: p["part"]), ",").alias("joined"), F.sum("n").alias("n"))
    of = lambda field, c: F.coalesce(F.max(F.when(F.col("field") == field, F.col(c))), F.lit("" if c == "joined" else 0))
    lists = joined.groupBy(KEY).agg(of("states", "joined").alias("states"), of("utilities", "joined").alias("utilities"), of("utilities", "n").alias("utility_count"))
    full = out.join(lists, out[KEY].eqNullSafe(lists[KEY]), "left").select(out[KEY], "record_count", F.coalesce("states", F.lit("")).alias("states"), F.coalesce("utilities", F.lit("")).alias("utilities"), F.coalesce("utility_count", F.lit(0)).alias("utility_count"), "null_rate")
    return full


def export_gate(records: DataFrame, reports: DataFrame) -> DataFrame:
    """The records of parameters that may be exported."""
    return records.join(reports.where("export_allowed").select(KEY), KEY, "left_semi")


def profile_records(records: DataFrame, fields: list[str]) -> DataFrame:
    """Distinct and empty values of every field."""
    per = records.groupBy(KEY).agg(F.count("*").alias("_n"), *[F.struct(F.count_distinct(F.col(f)).alias("d"), F.count_if(blank(f)).alias("e")).alias(f) for f in fields])
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}.d").alias("distinct_values"), F.col(f"{f}.e").alias("empty_values")) for f in fields]))
    out = per.select(KEY, "_n", rows.alias("r")).select(KEY, "_n", "r.*")
    return out.withColumn("empty_percent", F.col("empty_values") * 100.0 / F.col("_n")).drop("_n")


def audit_hierarchy(records: DataFrame, value: str = "value") -> DataFrame:
    """Rows of every state, suspicious names, utilities that are states, and rows without a value."""
    states = records.select(KEY, F.col("state").alias("utility"), F.lit(True).alias("leak")).distinct()
    joined = records.join(states, [KEY, "utility"], "left")
    odd = (F.length("utility") < 3) | F.upper("utility").rlike("STATE|UTILITY")
    return joined.groupBy(KEY, "state").agg(F.count("*").alias("rows"), F.count_if(odd).alias("suspicious"), F.count_if(F.col("leak")).alias("leaks"), F.count_if(F.col(value).isNull()).alias("empty_values"))


def check_contracts(pages: DataFrame, rows: DataFrame, ranges: DataFrame, records: DataFrame, names: DataFrame, id_pattern: str) -> DataFrame:
    """Contiguous pages, equal widths, rows without gaps, ordered ranges of their stated length, identities of one
    pattern, confidences from 0 to 1, and a catalog (``position``, ``name``) in order; one row a violation.

    Records are reported by their identity, catalogs by the name that comes too late.
    """
    p = pages.groupBy("report_id").agg(F.min("pdf_page").alias("a"), F.max("pdf_page").alias("b"), F.count_distinct("pdf_page").alias("n"))
    w = rows.groupBy("report_id").agg(F.count_distinct(F.size("cells")).alias("widths"), F.max("row_no").alias("b"), F.count("*").alias("n"))

    def broken(table: DataFrame, item: str, **rules: Column | str) -> DataFrame:
        """One row for each rule that a row breaks; the table is read once for all."""
        names = [F.when(F.expr(r) if isinstance(r, str) else r, F.lit(rule)) for rule, r in rules.items()]
        return table.select(F.col(item).cast("string").alias("report_id"), F.explode(F.array_compact(F.array(*names))).alias("rule_id"))

    found = [
        broken(p, "report_id", pages_contiguous="a <> 1 OR b <> n"),
        broken(w, "report_id", equal_widths="widths > 1", rows_numbered="b <> n"),
        broken(ranges, "report_id", range_ordered="start_page > end_page", range_length="length <> end_page - start_page + 1"),
        broken(records, "record_id", id_pattern=~F.col("record_id").rlike(id_pattern), confidence_range="confidence NOT BETWEEN 0 AND 1"),
        # a catalog is a small dimension, so one task may hold it
        names.withColumn("_b", F.lag("name").over(Window.orderBy("position"))).where("_b > name").select(F.col("name").alias("report_id"), F.lit("catalog_sorted").alias("rule_id")),
    ]
    return union(found)


def check_catalog_refs(aliases: DataFrame, names: DataFrame, children: DataFrame, parents: DataFrame) -> DataFrame:
    """Aliases without their target, children without their parent, and names that repeat."""
    a = aliases.join(names.select("canonical"), "canonical", "left_anti").select(F.lit("alias_target").alias("rule_id"), F.col("alias").alias("item"))
    c = children.join(parents.select("parent"), "parent", "left_anti").select(F.lit("parent").alias("rule_id"), F.col("child").alias("item"))
    d = names.groupBy("canonical").count().where("count > 1").select(F.lit("duplicate_name").alias("rule_id"), F.col("canonical").alias("item"))
    return union([a, c, d])


def check_bindings(parameters: DataFrame, registry: DataFrame, parsers: DataFrame) -> DataFrame:
    """J16, bindings: parameters whose parser, family or pattern does not resolve; one row a violation.

    ``parameters`` has parameter_id, parser_id, family and pattern (null where none is
    forced), ``registry`` the parser bound to each parameter, ``parsers`` parser_id, family
    and the patterns it takes.  A parameter is reported for the first rule it breaks, a
    registered one also for a bound parser that does not exist.
    """
    bound = registry.select("parameter_id", F.col("parser_id").alias("bound"))
    known = parsers.select("parser_id", F.col("family").alias("own_family"), "patterns")
    joined = parameters.join(bound, "parameter_id", "left").join(known, "parser_id", "left")
    rule = (
        F.when(F.col("bound").isNull(), "unregistered").when(~F.col("bound").eqNullSafe(F.col("parser_id")), "binding")
        .when(F.col("own_family").isNull(), "unknown_parser").when(~F.col("family").eqNullSafe(F.col("own_family")), "family")
        .when(F.col("pattern").isNotNull() & ~F.coalesce(F.array_contains("patterns", F.col("pattern")), F.lit(False)), "pattern")
    )
    own = joined.withColumn("rule_id", rule).where("rule_id IS NOT NULL").select("rule_id", F.col("parameter_id").alias("item"))
    lost = registry.join(parsers, "parser_id", "left_anti").select(F.lit("bound_parser").alias("rule_id"), F.col("parameter_id").alias("item"))
    twice = registry.groupBy("parameter_id").count().where("count > 1").select(F.lit("bound_twice").alias("rule_id"), F.col("parameter_id").alias("item"))
    return union([own, lost, twice])
