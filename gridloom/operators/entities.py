"""Entities of distinct cell values (group G): canonical value, confidence and method.

Matchers run on distinct values and are joined back, so a value that fills millions of
cells is matched once.
"""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import text as tx
from gridloom.operators.dictionary import held_names, pieces
from gridloom.operators.normalize import _word

ORDER = ["state", "utility", "voltage", "year", "unit", "category"]


def found(canonical: Column, confidence: float | Column, method: str) -> Column:
    score = confidence if isinstance(confidence, Column) else F.lit(confidence)
    return F.struct(canonical.cast("string").alias("canonical"), score.cast("double").alias("confidence"), F.lit(method).alias("method"))


def first_hit(steps: list[tuple[Column, Column]]) -> Column:
    """The result of the first step whose condition holds; null where none does."""
    out = F.lit(None).cast("struct<canonical:string,confidence:double,method:string>")
    for test, result in reversed(steps):
        out = F.when(test, result).otherwise(out)
    return out


def unpacked(values: DataFrame, hit: Column, value: str = "value") -> DataFrame:
    return values.withColumn("_m", hit).select(value, "_m.canonical", F.coalesce("_m.confidence", F.lit(0.0)).alias("confidence"), "_m.method")


def is_number(value: Column) -> Column:
    """Whether a value is a number and nothing else, but for commas and percent signs."""
    return F.trim(F.regexp_replace(value, "[,%]", "")).try_cast("double").isNotNull()


def similarity_ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp ratio, in Arrow batches."""

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y)])

    return ratio(a, b)


def levenshtein_ratio(a: Column, b: Column) -> Column:
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def shared_letters(a: Column, b: Column) -> Column:
    """How many letters two texts have in common, each as often as both have it."""
    times = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    letters = F.array_distinct(F.filter(F.split(a, ""), lambda c: c != ""))
    return F.aggregate(F.transform(letters, lambda c: F.least(times(a, c), times(b, c))), F.lit(0), lambda x, y: x + y)


def _numbered_grams(text: Column) -> Column:
    """The pairs of letters of a text, the second ``ab`` told from the first by its number."""
    at = F.sequence(F.lit(1), F.length(text) - 1)
    grams = F.when(F.length(text) >= 2, F.transform(at, lambda i: F.substring(text, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    earlier = lambda g, i: F.size(F.filter(F.slice(grams, 1, i), lambda h: h == g))
    return F.transform(grams, lambda g, i: F.struct(g.alias("gram"), earlier(g, i).alias("k")))


def close_pairs(values: DataFrame, names: DataFrame, least: float, inserts: bool) -> DataFrame:
    """(key, name) of all pairs that may be similar to ``least``, found by joins on pairs of letters.

    An edit spoils two pairs of letters at most, so of the rarest pairs of both texts, two
    for every edit that ``least`` allows and one more, one must be common.  Edits are
    replacements, too, or with ``inserts`` only insertions and deletions (of which
    the ratio allows more).  Pairs of a length that cannot do are left out, and with
    ``inserts`` those with too few letters in common.
    """
    length = F.length("text")
    if inserts:
        # 2 * common >= least * (a + b) bounds the other length and the edits
        edits = F.floor((1 - least) * length * (1 + (2 / least - 1)) + 1e-9)
        shorter = lambda a, b: 2 * F.least(a, b) >= least * (a + b) - 1e-9
    else:
        edits = F.floor((1 - least) / least * length + 1e-9)
        shorter = lambda a, b: F.least(a, b) >= least * F.greatest(a, b) - 1e-9
    taken = lambda df, c: df.select(F.col(c).alias("text")).distinct()
    grams = lambda df: df.select("text", length.alias("n"), (2 * edits + 1).cast("int").alias("take"), F.explode(_numbered_grams(F.col("text"))).alias("g"))
    # texts as long as no name can be are not taken apart
    sizes = names.select(F.length("name").alias("m")).distinct().select("m", F.explode(F.sequence(F.lit(0), F.ceil(F.col("m") * (2 / least)).cast("int"))).alias("n"))
    sizes = sizes.where(shorter(F.col("n"), F.col("m"))).select("n").distinct()
    near = taken(values, "key").withColumn("n", length).join(F.broadcast(sizes), "n", "left_semi").select("text")
    left, right = grams(near), grams(taken(names, "name"))
    weight = right.groupBy("g").agg(F.count("*").alias("weight"))

    def rarest(side: DataFrame) -> DataFrame:
        ordered = F.row_number().over(Window.partitionBy("text").orderBy(F.coalesce("weight", F.lit(0)), "g"))
        return side.join(weight, "g", "left").withColumn("place", ordered).where("place <= take").select("text", "n", "g")

    a = rarest(left).select(F.col("text").alias("key"), F.col("n").alias("a"), "g")
    b = rarest(right).select(F.col("text").alias("name"), F.col("n").alias("b"), "g")
    met = a.join(b, "g").where(shorter(F.col("a"), F.col("b"))).select("key", "name", "a", "b").distinct()
    if inserts:
        met = met.where(2 * shared_letters(F.col("key"), F.col("name")) >= least * (F.col("a") + F.col("b")) - 1e-9)
    return met.select("key", "name")


def match_state(values: DataFrame, names: DataFrame, aliases: DataFrame, least: float = 0.85, ratio=levenshtein_ratio) -> DataFrame:
    """G1: exact, then alias, then the closest name; names come before aliases of equal ratio.

    ``least`` is above two thirds, where similar texts are sure to share pairs of letters.
    """
    keyed = values.select("value").distinct().withColumn("key", tx.normalize_key(F.col("value")))
    table = names.select(F.lower("canonical").alias("name"), "canonical", "priority", F.lit(0).alias("kind")).unionByName(aliases.select(F.lower("alias").alias("name"), "canonical", "priority", F.lit(1).alias("kind")))
    same = keyed.hint("merge").join(table, F.col("key") == F.col("name")).groupBy("value").agg(F.min_by(F.struct("canonical", "kind"), F.struct("kind", "priority")).alias("e"))
    exact = same.select("value", F.col("e.canonical").alias("canonical"), F.lit(1.0).alias("confidence"), F.when(F.col("e.kind") == 0, "exact").otherwise("alias").alias("method"))
    left = keyed.join(exact.hint("merge"), "value", "left_anti").where("key <> ''")
    close = close_pairs(left, table, least, ratio is not levenshtein_ratio)
    close = close.withColumn("r", ratio(F.col("key"), F.col("name"))).where(F.col("r") >= least).join(table, "name")
    fuzzy = left.hint("merge").join(close, "key").groupBy("value").agg(F.min_by(F.struct("canonical", "r"), F.struct(-F.col("r"), F.col("kind"), F.col("priority"))).alias("b"))
    fuzzy = fuzzy.select("value", F.col("b.canonical").alias("canonical"), F.bround(F.col("b.r") * 0.9, 2).alias("confidence"), F.lit("fuzzy").alias("method"))
    out = keyed.select("value").join(exact.unionByName(fuzzy).hint("merge"), "value", "left")
    return out.withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))


def match_utility(values: DataFrame, utilities: DataFrame, patterns: list[str], header: Column | None = None, state: Column | None = None) -> DataFrame:
    """Exact name, a name inside the value or the reverse (4 letters at least), the same at any
    length among the names of the active state, a pattern, or the header's word for it.
    Names and values are joined by sorting both sides, as both may be large.

    With ``state``, ``utilities`` has a state too; the result is by value, and by header and state where given.
    """
    keyed = values.select("value", (header if header is not None else F.lit("")).alias("header"), (state if state is not None else F.lit(None).cast("string")).alias("state"))
    keyed = keyed.distinct().withColumn("key", tx.normalize_key(F.col("value")))
    names = utilities.select(F.lower("canonical").alias("name"), "canonical", "priority", *(["state"] if state is not None else []))
    first = F.min_by("canonical", F.struct("priority", "canonical"))
    named = names.groupBy("name").agg(F.min(F.struct("priority", "canonical")).alias("e")).select("name", "e.*")
    keys = keyed.select("key").where("key IS NOT NULL").distinct()
    long_names = named.where(F.length("name") >= 4)
    inside = held_names(keys.withColumnRenamed("key", "text"), long_names.select("name")).select(F.col("text").alias("key"), "name")
    around = held_names(named.select(F.col("name").alias("text")), keys.where(F.length("key") >= 4).withColumnRenamed("key", "name")).select(F.col("name").alias("key"), F.col("text").alias("name"))
    part = inside.unionByName(around).join(named.hint("merge"), "name").groupBy("key").agg(first.alias("_part"))
    exact = named.select(F.col("name").alias("key"), F.col("canonical").alias("_exact"))
    joined = keyed.join(exact.hint("merge"), "key", "left").join(part.hint("merge"), "key", "left")
    if state is not None:
        # longer names are found above; left are keys below four letters in a name of the state, and such names in a key
        own = names.select("name", "canonical", "priority", F.col("state").alias("own_state"))
        asked = joined.where("_exact IS NULL AND _part IS NULL AND key <> ''").select("key", "state").distinct()
        short = lambda c: F.concat(*[pieces(F.col(c), n) for n in (1, 2, 3)])
        owned = own.withColumnRenamed("own_state", "state")
        lowest = owned.select("state", F.explode(short("name")).alias("key"), "priority").groupBy("key", "state").agg(F.min("priority").alias("priority"))
        held = asked.join(lowest.hint("merge"), ["key", "state"]).join(owned.hint("merge"), ["state", "priority"]).where(F.contains("name", "key"))
        held = held.select("key", "state", F.struct("priority", "canonical").alias("e"))
        holds = asked.select("key", "state", F.explode(F.array_append(short("key"), F.lit(""))).alias("name"))
        brief = own.where(F.length("name") < 4).groupBy("name", F.col("own_state").alias("state")).agg(F.min(F.struct("priority", "canonical")).alias("e"))
        near = held.unionByName(holds.join(brief, ["name", "state"]).select("key", "state", "e"))
        near = near.groupBy("key", "state").agg(F.min("e").alias("e")).select("key", "state", F.col("e.canonical").alias("_near"))
        joined = joined.join(near, ["key", "state"], "left")
    else:
        joined = joined.withColumn("_near", F.lit(None).cast("string"))
    regex = reduce(lambda a, b: a | b, [F.col("value").rlike(p) for p in patterns], F.lit(False))
    headed = F.lower("header").rlike("utility|discom|licensee") & ~is_number(F.col("value")) & (F.length("key") > 2)
    out = joined.withColumn("_m", first_hit([
        (F.col("_exact").isNotNull(), found(F.col("_exact"), 1.0, "exact")),
        (F.col("_part").isNotNull(), found(F.col("_part"), 0.9, "substring")),
        (F.col("_near").isNotNull(), found(F.col("_near"), 0.85, "active_state")),
        (regex, found(tx.strip(F.col("value")), 0.6, "regex")),
        (headed, found(tx.strip(F.col("value")), 0.5, "header")),
    ]))
    return out.select("value", *(["header"] if header is not None else []), *(["state"] if state is not None else []), "_m.canonical", F.coalesce("_m.confidence", F.lit(0.0)).alias("confidence"), "_m.method")


def _lookup(aliases: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for p in aliases.items() for x in p])


def _first_word(text: Column, words: list[str], holds=_word) -> Column:
    """The first of ``words`` that stands in the text; null where none does."""
    return F.get(F.filter(F.array(*map(F.lit, words)), lambda a: holds(text, a)), F.lit(0))


KV = r"\b(\d+(?:\.\d+)?)\s*kv\b"


def voltage_band(canonical: Column) -> Column:
    """LT below 11 kV, HT up to 33 kV, EHT beyond; a band stays as it is."""
    kv = F.regexp_extract(F.lower(canonical), KV, 1).try_cast("double")
    return F.when(kv < 11, "LT").when(kv <= 33, "HT").when(kv > 33, "EHT").when(canonical.rlike(r"^\d+ V$"), "LT").otherwise(canonical)


def voltage_hit(value: Column, header: Column, aliases: dict[str, str]) -> Column:
    """``n kV``, ``n V``, an alias as the whole value, or as one of its words, or the header's ``n kV`` for a short value."""
    key = tx.normalize_key(value)
    kv = F.regexp_extract(key, KV, 1)
    volts = F.regexp_extract(key, r"\b(\d+)\s*(?:v|volts?)\b", 1)
    table = _lookup(aliases)
    alias = F.try_element_at(table, key)
    framed = lambda t, a: F.concat(F.lit(" "), t, F.lit(" ")).contains(F.concat(F.lit(" "), a, F.lit(" ")))
    word = _first_word(key, list(aliases), framed)
    above = F.regexp_extract(F.lower(F.coalesce(header, F.lit(""))), KV, 1)
    return first_hit([
        (kv != "", found(F.concat(kv, F.lit(" kV")), 0.95, "kv")),
        (volts != "", found(F.concat(volts, F.lit(" V")), 0.9, "volt")),
        (alias.isNotNull(), found(alias, 1.0, "alias")),
        (word.isNotNull(), found(F.try_element_at(table, word), 0.8, "word")),
        ((above != "") & (key != "") & (F.length(key) < 5), found(F.concat(above, F.lit(" kV")), 0.7, "header")),
    ])


def match_voltage(values: DataFrame, aliases: dict[str, str], header: Column | None = None) -> DataFrame:
    """G3 for distinct values, and headers where given; ``band`` is that of the level."""
    keys = ["value"] if header is None else ["value", "header"]
    v = values.select("value", (header if header is not None else F.lit("")).alias("header")).distinct()
    out = v.withColumn("_m", voltage_hit(F.col("value"), F.col("header"), aliases))
    out = out.select(*keys, "_m.canonical", F.coalesce("_m.confidence", F.lit(0.0)).alias("confidence"), "_m.method")
    return out.withColumn("band", voltage_band(F.col("canonical")))


def year_hit(value: Column) -> Column:
    """``20yy-yy``, ``20yy/yy``, ``FY yy-yy``, then a bare ``20yy``."""

    def pair(pattern: str, lead: str = "") -> tuple[Column, Column]:
        a, b = F.regexp_extract(value, pattern, 1), F.regexp_extract(value, pattern, 2)
        return a != "", F.concat(F.lit(lead), a, F.lit("-"), b)

    dash, slash, short = pair(r"\b(20\d{2})\s*-\s*(\d{2})\b"), pair(r"\b(20\d{2})\s*/\s*(\d{2})\b"), pair(r"(?i)\bFY\s*(\d{2})\s*-\s*(\d{2})\b", "20")
    year = F.regexp_extract(value, r"\b(20\d{2})\b", 1)
    return first_hit([
        (dash[0], found(dash[1], 1.0, "fy_dash")), (slash[0], found(slash[1], 0.95, "fy_slash")),
        (short[0], found(short[1], 0.9, "fy_short")), (year != "", found(year, 0.85, "calendar")),
    ])


def match_year(values: DataFrame) -> DataFrame:
    """G4 for distinct values."""
    return unpacked(values.select("value").distinct(), year_hit(F.col("value")))


def unit_hit(value: Column, header: Column, aliases: dict[str, str]) -> Column:
    """A catalog name or alias, percent, a charge per unit, or the header's unit."""
    key = F.lower(tx.strip(value))
    alias = F.try_element_at(_lookup(aliases), key)
    head = tx.extract_unit(header, "")
    return first_hit([
        (alias.isNotNull(), found(alias, 1.0, "alias")),
        (key.rlike(r"%|\bpercent\b"), found(F.lit("%"), 0.95, "percent")),
        (key.rlike(r"(rs\.?|paise|p)\s*/\s*k?[wv]"), found(tx.extract_unit(F.regexp_replace(key, r"\s*/\s*", "/")), 0.85, "regex")),
        (head != "", found(head, 0.75, "header")),
    ])


def match_unit(values: DataFrame, aliases: dict[str, str], header: Column | None = None) -> DataFrame:
    """G5 for distinct values."""
    v = values.select("value", (header if header is not None else F.lit("")).alias("header")).distinct()
    return unpacked(v, unit_hit(F.col("value"), F.col("header"), aliases))


def category_hit(value: Column, header: Column, aliases: dict[str, str], header_words: str = "category") -> Column:
    """A catalog name or alias, an alias of three letters at least as a word, or the header's word for it."""
    key = tx.normalize_key(value)
    table = _lookup(aliases)
    alias = F.try_element_at(table, key)
    word = _first_word(key, [a for a in aliases if len(a) >= 3])
    headed = F.lower(header).rlike(header_words) & ~is_number(value) & (key != "")
    return first_hit([
        (alias.isNotNull(), found(alias, 1.0, "alias")),
        (word.isNotNull(), found(F.try_element_at(table, word), 0.9, "word")),
        (headed, found(tx.strip(value), 0.75, "header")),
    ])


def match_category(values: DataFrame, aliases: dict[str, str], header: Column | None = None) -> DataFrame:
    """G6 for distinct values."""
    v = values.select("value", (header if header is not None else F.lit("")).alias("header")).distinct()
    return unpacked(v, category_hit(F.col("value"), F.col("header"), aliases))


def recognize_in_context(
    triples: DataFrame, states: tuple[DataFrame, DataFrame], utilities: DataFrame, patterns: list[str],
    voltages: dict[str, str], units: dict[str, str], categories: dict[str, str],
) -> DataFrame:
    """G7 in context: what a value is below its column's header, in a row of its state.

    ``triples`` has value, header and state (null where a row has none); the result has
    the best of the six matchers for each distinct one, by confidence and then in
    their order, else ``unknown``.  Voltage, year, unit and category are read in one pass;
    states are matched by value, utilities by value, header and state, and joined back.  A
    number alone below the header of a charge is no unit.
    """
    keyed = triples.select("value", F.coalesce("header", F.lit("")).alias("header"), F.coalesce("state", F.lit("")).alias("state")).distinct()
    named = match_state(keyed, *states).where("canonical IS NOT NULL").select("value", F.struct("canonical", "confidence", "method").alias("_state"))
    owned = match_utility(keyed, utilities, patterns, F.col("header"), F.col("state")).where("canonical IS NOT NULL")
    owned = owned.select("value", "header", "state", F.struct("canonical", "confidence", "method").alias("_utility"))
    value, header = F.col("value"), F.col("header")
    unit = unit_hit(value, F.when(tx.strip(value).rlike("(?i)rs|paise|kw|kva|%"), header).otherwise(""), units)
    read = {"voltage": voltage_hit(value, header, voltages), "year": year_hit(value), "unit": unit, "category": category_hit(value, header, categories, "category|consumer|tariff")}
    joined = keyed.withColumns({f"_{k}": h for k, h in read.items()}).join(named.hint("merge"), "value", "left").join(owned.hint("merge"), ["value", "header", "state"], "left")
    evidence = F.array(*[F.when(F.col(f"_{k}").isNotNull(), F.struct(F.col(f"_{k}.confidence").alias("confidence"), F.lit(-i).alias("o"), F.lit(k).alias("entity_type"), F.col(f"_{k}.canonical").alias("canonical"), F.col(f"_{k}.method").alias("method"))) for i, k in enumerate(ORDER)])
    best = joined.select("value", "header", "state", F.array_max(evidence).alias("b"))
    return best.select("value", "header", "state", F.coalesce("b.entity_type", F.lit("unknown")).alias("entity_type"), F.col("b.canonical").alias("canonical"), F.coalesce("b.confidence", F.lit(0.0)).alias("confidence"), F.col("b.method").alias("method"))


def recognize(matches: dict[str, DataFrame]) -> DataFrame:
    """The best match of a value over all matchers; equal confidence keeps the matchers' order."""
    frames = [m.where("canonical IS NOT NULL").select("value", F.lit(k).alias("entity_type"), F.lit(-ORDER.index(k)).alias("o"), "canonical", "confidence") for k, m in matches.items()]
    values = reduce(DataFrame.union, [m.select("value") for m in matches.values()]).distinct()
    best = reduce(DataFrame.unionByName, frames).groupBy("value").agg(F.max_by(F.struct("entity_type", "canonical", "confidence"), F.struct("confidence", "o")).alias("b"))
    return values.join(best, "value", "left").select("value", F.coalesce("b.entity_type", F.lit("unknown")).alias("entity_type"), F.col("b.canonical").alias("canonical"), F.coalesce("b.confidence", F.lit(0.0)).alias("confidence"))


def canonicalize_utility(rows: DataFrame, alias_map: list[tuple[str, str]], utilities: DataFrame) -> DataFrame:
    """An alias inside the name (list order decides), else a catalog name inside it, of the row's state before any other; year parts go first.

    Of several names of a catalog, the one that sorts first is taken.
    """
    parts = F.filter(F.split("utility", " - "), lambda p: ~p.rlike(r"^20\d{2}-\d{2}$"))
    base = rows.withColumn("utility", F.array_join(parts, " - "))
    low = F.lower("utility")
    alias = F.lit(None).cast("string")
    for name, target in reversed(alias_map):
        alias = F.when(low.contains(name.lower()), target).otherwise(alias)
    u = utilities.select(F.lower("canonical").alias("name"), "canonical", F.col("state").alias("_s")).where("name <> ''").distinct()
    held = held_names(base.select(low.alias("text")).where("text IS NOT NULL").distinct(), u.select("name").distinct()).join(u.hint("merge"), "name")
    anywhere = held.groupBy(F.col("text").alias("_k")).agg(F.min("canonical").alias("_any"))
    in_state = held.groupBy(F.col("text").alias("_k"), "_s").agg(F.min("canonical").alias("_own"))
    joined = base.withColumn("_k", low).join(anywhere.hint("merge"), "_k", "left")
    joined = joined.join(in_state.hint("merge"), (joined["_k"] == in_state["_k"]) & (joined["state"] == in_state["_s"]), "left").drop(in_state["_k"])
    own = F.col("_own")
    step = F.when(alias.isNotNull(), "alias").when(own.isNotNull(), "state").when(F.col("_any").isNotNull(), "catalog").otherwise("as_is")
    return joined.withColumns({"canonical": F.coalesce(alias, own, F.col("_any"), F.col("utility")), "step": step}).drop("_k", "_s", "_any", "_own")
