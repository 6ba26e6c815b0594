"""Shape features of tables and their layout (group F)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.text import YEAR_LABEL, is_blank

# fixed values: word lists of the features, and weights and rules of the layouts
UTILITY_WORDS = ["discom", "utility", "licensee", " torrent", "msedcl", "guvnl", "ugvcl", "pgvcl", "dgvcl", "mgvcl", "bescom", "cesc", "tpl"]
SECTION_KEYWORDS = ["ht", "lt", "eht", "high tension", "low tension", "extra high tension", "domestic", "commercial", "agriculture", "industrial"]
TARIFF_WORDS = ["tariff", "charge", "surcharge", "rate", "cost", "price", "fee"]
VOLTAGE_PATTERN = r"(?i)\b\d+\s*kv\b|\bvoltage\b|\bvolt\b|\bkv\b"
WEIGHTS = {
    "key_value": {"column_count": -4.0, "text_density": 2.0, "numeric_density": 1.0, "hierarchy_indicators": -3.0, "indentation_indicators": -2.0},
    "numeric_matrix": {"numeric_density": 8.0, "column_count": 2.0, "state_name_occurrence": -3.0, "hierarchy_indicators": -2.0},
    "state_block_matrix": {"state_name_occurrence": 10.0, "hierarchy_indicators": 6.0, "numeric_density": 4.0, "column_count": 2.0},
    "wide_table": {"column_count": 8.0, "numeric_density": 3.0, "average_cells_per_row": 4.0},
    "simple_matrix": {"numeric_density": 6.0, "column_count": 2.0, "state_name_occurrence": -6.0, "hierarchy_indicators": -6.0},
    "hierarchical_parent_child": {"text_density": 6.0, "hierarchy_indicators": 8.0, "indentation_indicators": 4.0, "numeric_density": -4.0},
}
RULES = [
    ("key_value", "column_count", "=", 2.0, 15.0),
    ("key_value", "column_count", ">", 2.0, -15.0),
    ("numeric_matrix", "column_count", ">", 2.0, 5.0),
    ("numeric_matrix", "numeric_density", ">", 0.5, 8.0),
    ("numeric_matrix", "state_name_occurrence", "=", 0.0, 5.0),
    ("state_block_matrix", "state_name_occurrence", ">", 0.0, 15.0),
    ("state_block_matrix", "hierarchy_indicators", ">", 0.0, 8.0),
    ("wide_table", "column_count", ">", 8.0, 20.0),
    ("wide_table", "column_count", "<", 4.0, -20.0),
    ("simple_matrix", "column_count", ">", 2.0, 5.0),
    ("simple_matrix", "state_name_occurrence", "=", 0.0, 10.0),
    ("simple_matrix", "hierarchy_indicators", "=", 0.0, 8.0),
    ("hierarchical_parent_child", "hierarchy_indicators", ">", 0.0, 10.0),
    ("hierarchical_parent_child", "numeric_density", "<", 0.3, 5.0),
]
FAMILIES = {"key_value": "key_value", "numeric_matrix": "numeric_matrix", "state_block_matrix": "state_block_matrix", "wide_table": "wide_to_long", "simple_matrix": "simple_matrix", "hierarchical_parent_child": "narrative"}


def _count(cells: Column, test) -> Column:
    return F.size(F.filter(cells, test))


def _any_of(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.lower(c).contains(w) for w in words])


def table_features(rows: DataFrame, stripped: DataFrame | None = None, key: str = "report_id") -> DataFrame:
    """shape signals of every table, from one pass over its rows.

    Uses ``row_label`` and ``propagated`` where the rows have them; ``stripped`` gives
    the header rows that merging took away (key, headers_stripped).
    """
    label = F.col("row_label") if "row_label" in rows.columns else F.lit("")
    carried = F.col("propagated") if "propagated" in rows.columns else F.lit(False)
    cells = F.col("cells")
    filled = _count(cells, lambda c: ~is_blank(c))
    pairs = F.transform(cells, lambda c, i: (is_blank(c) | ((i > 0) & (c == F.get(cells, i - 1)))).cast("int"))
    base = rows.select(
        key, "row_no", "cells", filled.alias("filled"), F.size(cells).alias("width"),
        _count(cells, lambda c: c.rlike(r"\d")).alias("num"), _count(cells, lambda c: c.rlike("[a-zA-Z]")).alias("alpha"),
        _count(cells, lambda c: _any_of(c, UTILITY_WORDS)).alias("utility"), _count(cells, lambda c: _any_of(c, SECTION_KEYWORDS)).alias("section"),
        _count(cells, lambda c: c.rlike(VOLTAGE_PATTERN)).alias("voltage"), _count(cells, lambda c: _any_of(c, TARIFF_WORDS)).alias("tariff"),
        _count(cells, lambda c: c.rlike(YEAR_LABEL)).alias("years"),
        (is_blank(F.get(cells, F.lit(0))) & ~is_blank(F.coalesce(F.get(cells, F.lit(1)), F.lit("")))).alias("indented"),
        (F.aggregate(pairs, F.lit(0), lambda a, b: a + b) / F.size(cells)).alias("merged"), label.alias("label"), carried.alias("carried"),
    )
    total = F.sum("width")
    columns = F.max("width")
    used = rows.select(key, F.posexplode("cells").alias("col_idx", "cell")).where(~is_blank(F.col("cell"))).groupBy(key).agg(F.count_distinct("col_idx").alias("used"))
    out = base.groupBy(key).agg(
        F.count("*").cast("double").alias("row_count"),
        columns.cast("double").alias("column_count"),
        F.avg((F.col("filled") == 0).cast("double")).alias("empty_row_ratio"),
        F.min_by("merged", "row_no").alias("merged_header_indicators"),
        (F.sum("num") / total).alias("numeric_density"),
        (F.sum("alpha") / total).alias("text_density"),
        (total / F.count("*")).alias("average_cells_per_row"),
        F.var_pop("filled").alias("row_length_variance"),
        (F.count_if("carried") + F.count_if(F.col("label") == "master")).cast("double").alias("state_name_occurrence"),
        F.sum("utility").cast("double").alias("utility_name_occurrence"),
        F.sum("section").cast("double").alias("section_keyword_occurrence"),
        F.sum("voltage").cast("double").alias("voltage_keyword_occurrence"),
        F.sum("tariff").cast("double").alias("tariff_keyword_occurrence"),
        F.sum("years").cast("double").alias("year_occurrence"),
        F.count_if(F.col("label") == "continuation").cast("double").alias("continuation_row_indicators"),
        F.count_if("indented").cast("double").alias("indentation_indicators"),
        F.count_if(F.col("label").isin("master", "child")).cast("double").alias("hierarchy_indicators"),
    )
    out = out.join(used, key, "left").withColumn("empty_column_ratio", 1 - F.coalesce("used", F.lit(0)) / F.col("column_count")).drop("used")
    if stripped is None:
        out = out.withColumn("repeated_header_indicators", F.lit(0.0))
    else:
        out = out.join(stripped.select(key, F.col("headers_stripped").cast("double").alias("repeated_header_indicators")), key, "left").na.fill(0.0, ["repeated_header_indicators"])
    return out.withColumn("header_repetition_frequency", F.col("repeated_header_indicators") / F.col("row_count"))


def score_patterns(features: DataFrame, key: str = "report_id") -> DataFrame:
    """F2: weighted features plus rule scores of every layout."""

    def score(pattern: str) -> Column:
        parts = [F.col(f) * w for f, w in WEIGHTS[pattern].items()]
        for p, f, sign, limit, points in RULES:
            if p == pattern:
                hit = {"=": F.abs(F.col(f) - limit) < 1e-6, ">": F.col(f) > limit, "<": F.col(f) < limit}[sign]
                parts.append(F.when(hit, points).otherwise(0.0))
        return reduce(lambda a, b: a + b, parts)

    scored = F.array(*[F.struct(F.lit(p).alias("pattern"), F.lit(i).alias("order"), score(p).alias("score")) for i, p in enumerate(WEIGHTS)])
    return features.select(key, F.explode(scored).alias("s")).select(key, "s.*")


def classify(scores: DataFrame, threshold: float = 0.6, key: str = "report_id") -> DataFrame:
    """softmax over the scores; best and second, a flag below the threshold, ``unknown`` below 0.3."""
    w = Window.partitionBy(key)
    e = scores.withColumn("e", F.exp(F.col("score") - F.max("score").over(w)))
    e = e.withColumn("confidence", F.col("e") / F.sum("e").over(w)).withColumn("place", F.row_number().over(w.orderBy(F.desc("confidence"), "order")))
    out = e.where("place <= 2").groupBy(key).agg(
        F.max(F.when(F.col("place") == 1, F.col("pattern"))).alias("best"), F.max(F.when(F.col("place") == 1, F.col("confidence"))).alias("confidence"),
        F.max(F.when(F.col("place") == 2, F.col("pattern"))).alias("runner_up"), F.max(F.when(F.col("place") == 2, F.col("confidence"))).alias("runner_up_confidence"),
    )
    low = F.col("confidence") < threshold
    return out.select(key, F.when(low & (F.col("confidence") < 0.3), "unknown").otherwise(F.col("best")).alias("pattern"), "confidence", "runner_up", "runner_up_confidence", low.alias("needs_confirmation"))


def apply_pattern_overrides(classes: DataFrame, forced: DataFrame, key: str = "report_id") -> DataFrame:
    """preset, then config, then user-confirmed pattern, then the classifier's (``forced``: key, preset, config, confirmed)."""
    j = classes.join(forced, key, "left")
    source = F.when(F.col("preset").isNotNull() | F.col("config").isNotNull(), "config_override").when(F.col("confirmed").isNotNull(), "user_confirmed").otherwise("classifier")
    pattern = F.coalesce("preset", "config", "confirmed", "pattern")
    return j.select(key, pattern.alias("pattern"), F.when(source == "classifier", F.col("confidence")).otherwise(1.0).alias("confidence"), source.alias("routing_source"))


# fixed values: parts of a parameter's name that tell its family, in order
NAME_FAMILIES = (("wheel", "wide_to_long"), ("cross", "state_block_matrix"), ("bank", "narrative"), ("trans", "numeric_matrix"))


def route_parser(classes: DataFrame, bindings: DataFrame, key: str = "report_id", parsers: DataFrame | None = None, name: str | None = None) -> DataFrame:
    """the family of a table, and the step that gave it.

    The family bound to a table, else that of its bound parser, else that of its bound
    pattern; else the family of the classifier's parser, else of the classifier's pattern; else
    the family that a part of the table's ``name`` tells, else the simple matrix.

    ``bindings`` has the key and family, and may have parser_id and bound_pattern;
    ``classes`` has pattern and may have parser_id; ``parsers`` (parser_id, family)
    resolves parser identities, and one that it lacks is passed over.
    """
    known = F.create_map(*[F.lit(x) for p in FAMILIES.items() for x in p])
    have = lambda df, c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    own = bindings.select(key, F.col("family").alias("_family"), have(bindings, "parser_id").alias("_bound"), have(bindings, "bound_pattern").alias("_pattern"))
    joined = classes.withColumn("_parser", have(classes, "parser_id")).join(own, key, "left")
    for c in ("_bound", "_parser"):
        if parsers is None:
            joined = joined.withColumn(f"{c}_family", F.lit(None).cast("string"))
        else:
            joined = joined.join(parsers.select(F.col("parser_id").alias(c), F.col("family").alias(f"{c}_family")), c, "left")
    told = F.lit(None).cast("string")
    if name is not None:
        for part, family in reversed(NAME_FAMILIES):
            told = F.when(F.contains(F.col(name), F.lit(part)), family).otherwise(told)
    steps = [
        ("binding", F.col("_family")), ("bound_parser", F.col("_bound_family")), ("bound_pattern", F.try_element_at(known, F.col("_pattern"))),
        ("classified_parser", F.col("_parser_family")), ("pattern", F.try_element_at(known, F.col("pattern"))), ("name", told), ("default", F.lit("simple_matrix")),
    ]
    step = F.coalesce(*[F.when(f.isNotNull(), n) for n, f in steps])
    return joined.select(key, "pattern", F.coalesce(*[f for _, f in steps]).alias("family"), step.alias("step"))


def block_layout(rows: DataFrame, key: str = "report_id") -> DataFrame:
    """a block headed by a category is a matrix if one of its rows has a single cell, else a simple matrix; others are key-value."""
    packed = F.filter(F.transform("cells", lambda c: F.trim(c)), lambda c: c != "")
    per = rows.select(key, "block_no", "row_no", packed.alias("p")).groupBy(key, "block_no").agg(
        F.min_by(F.lower(F.array_join("p", " ")), "row_no").alias("head"), F.max(F.size("p") == 1).alias("single"), F.max(F.size("p")).alias("widest")
    )
    layout = F.when(F.col("widest") == 0, "unknown").when(F.col("head").contains("category") & F.col("single"), "matrix").when(F.col("head").contains("category"), "simple_matrix").otherwise("key_value")
    return per.select(key, "block_no", layout.alias("layout"))
