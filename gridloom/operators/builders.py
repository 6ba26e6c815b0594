"""Layouts to long-form facts (group I).

Every loop that carries a value down the rows is a segment, where a running sum of
reset flags counts up, and the last non-null value inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import text as tx
from gridloom.operators.dictionary import held_names
from gridloom.operators.normalize import ordered
from gridloom.operators.running import running

KEY = "report_id"
#: Rows of a block that one nested row spans.
NESTED_ROWS = 2_000
#: Rows that a task sorts while it nests blocks, about.
TASK_ROWS = 500_000


def cell(i: int) -> Column:
    return F.coalesce(F.get("cells", F.lit(i)), F.lit(""))


def carry(value: Column, key: str = KEY, segment: str | None = None) -> Column:
    """The last non-null value so far, inside a segment if one is named."""
    keys = [key, segment] if segment else [key]
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy("row_no"))


def filled(c: Column) -> Column:
    return F.when(~tx.is_blank(c), tx.strip(c))


def header_labels(header: DataFrame) -> DataFrame:
    """Label of a column: its non-blank header cells joined by `` - ``, else ``Col n``."""
    cells = header.select(KEY, "row_no", F.posexplode("cells").alias("col_idx", "cell"))
    parts = F.transform(F.sort_array(F.collect_list(F.when(~tx.is_blank(F.col("cell")), F.struct("row_no", tx.strip(F.col("cell")).alias("cell"))))), lambda p: p["cell"])
    joined = cells.groupBy(KEY, "col_idx").agg(F.array_join(parts, " - ").alias("label"))
    return joined.withColumn("label", F.when(F.col("label") == "", F.concat(F.lit("Col "), F.col("col_idx").cast("string"))).otherwise(F.col("label")))


def melt(rows: DataFrame, labels: DataFrame, first: int = 1, kept: tuple[str, ...] = ("cells",)) -> DataFrame:
    """Numeric cells from column ``first`` on, with the label of their column and the ``kept`` columns of their row."""
    later = F.slice("cells", first + 1, F.greatest(F.size("cells"), F.lit(1)))
    cells = rows.select(KEY, "row_no", "pdf_page", *kept, F.posexplode(later).alias("col_idx", "cell")).withColumn("col_idx", F.col("col_idx") + first)
    cells = cells.withColumn("value", tx.parse_number(F.col("cell"))).where("value IS NOT NULL")
    # one row a report and column
    return cells.join(F.broadcast(labels), [KEY, "col_idx"])


def with_utility(records: DataFrame, names: DataFrame, column: str = "category") -> DataFrame:
    """The first of the catalog's ``names`` (canonical, priority) that the column holds, else ``state_level``."""
    known = names.select(F.lower("canonical").alias("name"), "canonical", "priority").where("name <> ''")
    texts = records.select(F.lower(column).alias("text")).where("text <> ''").distinct()
    held = held_names(texts, known.select("name").distinct()).join(known, "name")
    held = held.groupBy(F.col("text").alias("_text")).agg(F.min_by("canonical", F.struct("priority", "canonical")).alias("_found"))
    # blank texts, of which there may be many, meet in no task
    named = F.coalesce(F.col(column) != "", F.lit(False))
    joined = records.where(named).join(held, F.lower(column) == F.col("_text"), "left").unionByName(records.where(~named), allowMissingColumns=True)
    return joined.withColumn("utility", F.coalesce("_found", F.lit("state_level"))).drop("_text", "_found")


def wide_to_long(rows: DataFrame, labels: DataFrame, first: int = 4, names: DataFrame | None = None) -> DataFrame:
    """Every numeric cell with category, subcategory, voltage, year, unit and provenance, and its utility where catalog names are given."""
    sub = labels.where("col_idx = 1").select(KEY, F.lower("label").contains("category").alias("has_sub"))
    year = F.get(F.filter("cells", lambda c: c.rlike(r"^\d{4}-\d{2}$")), F.lit(0))
    # what belongs to a row is found once, not for each of its cells
    rows = rows.withColumns({"category": tx.strip(cell(0)), "subcategory": tx.strip(cell(1)), "year": year})
    found = [] if names is None else ["utility"]
    if found:
        rows = with_utility(rows, names)
    voltages = labels.withColumn("voltage_level", tx.extract_voltage(F.col("label")))
    out = melt(rows, voltages, first, ("category", "subcategory", "year", *found)).join(F.broadcast(sub), KEY, "left")
    return out.select(
        KEY, "row_no", "pdf_page", "col_idx", "category",
        F.when(F.col("has_sub"), F.col("subcategory")).otherwise("").alias("subcategory"),
        "voltage_level", "year",
        tx.extract_unit(F.concat_ws(" ", "label", "cell")).alias("charge_unit"),
        "label", "value", *found,
    )


def wide_to_long_keyed(rows: DataFrame, columns: dict[str, int]) -> DataFrame:
    """A fixed {label: column} melt with carried state, utility and year.

    Blank values stay, header rows go, and of equal (state, utility, year, label) the
    first row wins.  A row that names a state but no utility is at ``state_level``.
    """
    head = F.lower(F.array_join(F.slice("cells", 1, 3), " ")).contains("utility")
    body = rows.where(~head)
    named, own = filled(cell(0)), filled(cell(1))
    # a row that names a state ends the utility before it
    body = running(body, last={"state": named, "_utility": F.when(named.isNotNull() | own.isNotNull(), F.struct(own.alias("v"))), "year": filled(cell(2))})
    body = body.withColumn("utility", F.coalesce("_utility.v", F.lit("state_level")))
    pairs = F.array(*[F.struct(F.lit(k).alias("label"), cell(i).alias("raw")) for k, i in columns.items()])
    long = body.select(KEY, "row_no", "pdf_page", "state", "utility", "year", F.explode(pairs).alias("p")).select(KEY, "row_no", "pdf_page", "state", "utility", "year", "p.label", "p.raw")
    first = Window.partitionBy(KEY, "state", "utility", "year", "label").orderBy("row_no")
    once = long.withColumn("_k", F.row_number().over(first)).where("_k = 1").drop("_k")
    return once.withColumn("value", tx.parse_number(F.col("raw"))).withColumn("charge_unit", tx.extract_unit(F.col("raw"))).drop("raw")


def numeric_matrix(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """I4: row label by column label."""
    return melt(rows, labels, 1).select(KEY, "row_no", "pdf_page", tx.strip(cell(0)).alias("row_label"), F.col("label").alias("column_label"), "value")


def year_anchored_rows(rows: DataFrame, year: str = r"^\d{4}-\d{2}$") -> DataFrame:
    """The four non-blank cells after the year cell are charge, unit, charge, unit.

    State and utility are carried from the first two cells.  Rows without a year, or
    without both charges, are dropped after they have been carried.
    """
    place = F.array_position(F.transform("cells", lambda c: c.rlike(year)), True).cast("int")
    body = rows.withColumn("state", carry(filled(cell(0)))).withColumn("utility", carry(filled(cell(1)))).withColumn("_p", place)
    after = F.filter(F.slice("cells", F.col("_p") + 1, F.size("cells")), lambda c: ~tx.is_blank(c))
    found = body.where("_p > 0").withColumn("_a", after)
    found = found.select(
        KEY, "row_no", "pdf_page", "state", "utility", F.element_at("cells", F.col("_p")).alias("year"),
        tx.parse_number(F.get("_a", F.lit(0))).alias("charge_1"), F.get("_a", F.lit(1)).alias("unit_1"),
        tx.parse_number(F.get("_a", F.lit(2))).alias("charge_2"), F.get("_a", F.lit(3)).alias("unit_2"),
    )
    return found.where("charge_1 IS NOT NULL AND charge_2 IS NOT NULL")


def drop_shadowed_aggregate(records: DataFrame, keys: list[str], values: list[str], utility: str = "utility") -> DataFrame:
    """A ``state_level`` row goes where a named utility of its key has equal values."""
    named = records.where(F.col(utility) != "state_level").select(*keys, *values).distinct()
    level = records.where(F.col(utility) == "state_level").join(named, [*keys, *values], "left_anti")
    return records.where(F.col(utility) != "state_level").unionByName(level.select(records.columns))


def sectioned_values(rows: DataFrame, default_year: str = "2025-26") -> DataFrame:
    """The section carried from its header rows; the value is the last cell that is no year and no state.

    Needs ``is_section`` and ``state``.  ``N/A`` stays as a sentinel without a number.
    """
    w = Window.partitionBy(KEY).orderBy("row_no")
    section = F.last(F.when(F.col("is_section"), tx.strip(cell(1))), ignorenulls=True).over(w)
    body = rows.withColumn("section", section).where("NOT is_section")
    rest = F.filter("cells", lambda c: ~tx.is_blank(c) & ~c.rlike(r"^\d{4}-\d{2}$") & (tx.strip(c) != F.col("state")))
    year = F.get(F.filter(F.slice("cells", 2, 3), lambda c: c.rlike(r"^\d{4}-\d{2}$")), F.lit(0))
    body = body.withColumn("raw", F.try_element_at(rest, F.lit(-1))).where("raw IS NOT NULL AND state <> ''")
    return body.select(KEY, "row_no", "state", "section", F.coalesce(year, F.lit(default_year)).alias("year"), "raw", tx.parse_sentinel_number(F.col("raw")).alias("value"))


def split_multi_value(records: DataFrame, col: str) -> DataFrame:
    """I8: ``1.13 (Partial OA) 1.53 (Full OA)`` becomes one record a value, with its qualifier."""
    found = records.withColumn("_all", F.regexp_extract_all(col, F.lit(r"\d+(?:\.\d+)?\s*\([^)]*\)"), F.lit(0)))
    one = F.array(F.lit(None).cast("string"))
    # the search stands in a column of its own and the rows are split after it, so that a text is searched once
    split = found.select(*records.columns, F.posexplode(F.when(F.size("_all") > 1, F.col("_all")).otherwise(one)).alias("part", "_x"))
    number, qualifier = F.regexp_extract("_x", r"^\d+(?:\.\d+)?", 0), F.regexp_extract("_x", r"\(([^)]*)\)", 1)
    value = F.coalesce(number.try_cast("double"), tx.parse_sentinel_number(F.col(col)))
    return split.select(*records.columns, "part", value.alias("value"), qualifier.alias("qualifier"))


def resolved_utilities(values: DataFrame, aliases: DataFrame, utilities: DataFrame) -> DataFrame:
    """Canonical utility of (state, utility): the first alias inside the name, else the first catalog name of the state, else of any state.

    ``aliases`` has name, canonical and priority, ``utilities`` canonical, state and
    priority; both are one dictionary, looked up once.  Year parts of what is left go.
    """
    table = aliases.select(F.lower("name").alias("name"), "canonical", F.lit(None).cast("string").alias("own"), F.lit(0).alias("tier"), "priority")
    table = table.unionByName(utilities.select(F.lower("canonical").alias("name"), "canonical", F.col("state").alias("own"), F.lit(1).alias("tier"), "priority"))
    asked = values.select("state", "utility", F.lower("utility").alias("text")).distinct()
    held = held_names(asked.select("text").distinct(), table.select("name").distinct()).join(table, "name")
    tier = F.when((F.col("tier") == 1) & ~F.coalesce(F.col("own") == F.col("state"), F.lit(False)), 2).otherwise(F.col("tier"))
    best = F.min_by("canonical", F.struct(tier, "priority", "canonical"))
    out = asked.join(held.drop("name"), "text", "left").groupBy("state", "utility").agg(F.coalesce(best, F.col("utility")).alias("name"))
    kept = F.filter(F.split("name", " - "), lambda p: ~p.rlike(r"^20\d{2}-\d{2}\b"))
    return out.select("state", "utility", F.when(F.contains("name", F.lit(" - ")), F.array_join(kept, " - ")).otherwise(F.col("name")).alias("canonical"))


def with_canonical_utility(records: DataFrame, aliases: DataFrame, utilities: DataFrame, values: DataFrame | None = None) -> DataFrame:
    """``records`` with the canonical name of their utility; ``values`` are their distinct (state, utility), where these are at hand."""
    asked = records.select("state", "utility").distinct() if values is None else values
    names = resolved_utilities(asked, aliases, utilities).withColumnsRenamed({"state": "_s", "utility": "_u"})
    out = records.join(names, F.col("state").eqNullSafe(F.col("_s")) & (F.col("utility") == F.col("_u")), "left")
    return out.withColumn("utility", F.col("canonical")).drop("_s", "_u", "canonical")


# fixed values
HEADER_WORDS = ("category", "sub-category", "s.no", "sl.no", "sno", "state", "ut", "year", "value", "unit")
VOLTAGE_LINE = r"(?i)\b(11\s*kV|33\s*kV|132\s*kV|220\s*kV|66\s*kV|400\s*kV|LT\b|HT\b|EHT\b)"
NO_VALUE = r"(?i)\b20\d{2}\b|\bFY\s*\d{2}\s*-\s*\d{2}\b|\b\d+\s*kv\b|\b\d+\s*v(olts?)?\b"
CATEGORY_LEVELS = (("HT", ("ht", "high tension")), ("LT", ("lt", "low tension")), ("EHT", ("eht", "extra high tension")))


def block_matrix(rows: DataFrame, columns: DataFrame, aliases: DataFrame | None = None, utilities: DataFrame | None = None, spanning: bool = False) -> DataFrame:
    """Values of every block by category, voltage and utility.

    ``rows`` needs ``block_no`` and ``state`` and may have ``year``; ``columns``
    (col_idx, display_name, role, year, unit) has what is known of the columns.  The
    category stands in the last column with the role category or voltage, else in the first;
    values stand in those with the role value.  Without such a role the category is the
    second column and values follow it, or the first where names span (or where there
    are two columns only).

    A line with a voltage and no value sets the voltage of the lines below it in its
    block.  The block's first line with ``category`` among its first cells names the
    utilities: a value takes the nearest of these headers, the left one of two, and
    otherwise the name of its column.  Names go through aliases and catalog, if given;
    year and unit come from the column, else from the block and ``Rs/kWh``.  Years and
    voltages are no values.  Headers are a map carried over the block and looked up in
    every cell, so no cell is joined.
    """
    role = lambda *r: F.col("role").isin(*r)
    known = columns.groupBy(KEY).agg(
        F.max(F.when(role("category", "voltage"), F.col("col_idx"))).alias("_category"),
        F.sort_array(F.collect_list(F.when(role("value"), F.col("col_idx")))).alias("_values"),
        F.map_from_entries(F.collect_list(F.struct("col_idx", F.struct("display_name", "year", "unit")))).alias("_columns"),
    )
    n = F.size("cells")
    wide = F.lit(False) if spanning else n > 2
    named = F.coalesce(F.size("_values"), F.lit(0)) > 0
    rest = F.sequence(F.when(wide, 2).otherwise(1), F.greatest(n - 1, F.when(wide, 2).otherwise(1)))
    body = rows.join(known, KEY, "left").withColumn("year", F.col("year") if "year" in rows.columns else F.lit(None).cast("string"))
    body = body.withColumn("_c", F.when(named, F.coalesce("_category", F.lit(0))).otherwise(F.when(wide, 1).otherwise(0)))
    body = body.withColumn("_v", F.filter(F.when(named, F.col("_values")).otherwise(rest), lambda i: i < n))
    at = lambda i: F.coalesce(F.get("cells", i), F.lit(""))
    number = lambda c: F.when(~c.rlike(NO_VALUE), tx.parse_number(c))
    body = body.withColumn("category", tx.strip(at(F.col("_c"))))
    low = F.lower("category")
    valued = F.exists("_v", lambda i: ~tx.strip(at(i)).isin("", "-", "nil") & number(at(i)).isNotNull())
    stands = (F.col("category") != "") & ~low.isin("category", "sub-category", "utility")
    found = F.regexp_extract("category", VOLTAGE_LINE, 1)
    line = stands & ~valued & (found != "")
    voltage = F.when(F.lower(found).isin("lt", "ht", "eht"), F.upper(found)).otherwise(found)
    cells = F.transform("cells", lambda c, i: F.struct(i.alias("col"), tx.strip(c).alias("label")))
    heads = F.filter(cells, lambda h: (h["label"] != "") & ~F.lower(h["label"]).isin(*HEADER_WORDS))
    heads = F.when(F.exists(F.slice("cells", 1, 4), lambda c: F.lower(tx.strip(c)) == "category"), heads)
    block = Window.partitionBy(KEY, "block_no").orderBy("row_no")
    whole = block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    body = body.withColumns({
        "_line": line, "_stands": stands,
        "_heads": F.first(heads, ignorenulls=True).over(whole),
        "voltage_level": F.coalesce(F.last(F.when(line, voltage), ignorenulls=True).over(block), F.lit("all")),
    }).where("_stands AND NOT _line")
    level = F.col("voltage_level")
    own = F.lit(None).cast("string")
    for name, parts in reversed(CATEGORY_LEVELS):
        own = F.when(low.rlike("|".join(parts)), name).otherwise(own)
    beside = F.when((F.col("_c") + 1 < n) & ~F.array_contains("_v", F.col("_c") + 1), tx.strip(at(F.col("_c") + 1))).otherwise("")
    body = body.withColumns({"voltage_level": F.when(level == "all", F.coalesce(own, level)).otherwise(level), "subcategory": beside})
    out = body.select("*", F.explode("_v").alias("col_idx")).withColumn("value", number(at(F.col("col_idx")))).where("value IS NOT NULL")
    nearest = F.array_min(F.transform("_heads", lambda h: F.struct(F.abs(h["col"] - F.col("col_idx")), h["col"], h["label"].alias("label"))))
    own_column = F.try_element_at("_columns", F.col("col_idx"))
    title = F.coalesce(F.when(own_column["display_name"] != "", own_column["display_name"]), F.concat(F.lit("Col "), F.col("col_idx").cast("string")))
    out = out.select(
        KEY, "block_no", "row_no", "col_idx", "state",
        F.when(F.size("_heads") > 0, nearest["label"]).otherwise(title).alias("utility"),
        "category", "subcategory", "voltage_level", "value",
        F.coalesce(own_column["unit"], F.lit("Rs/kWh")).alias("charge_unit"),
        F.coalesce(own_column["year"], F.col("year")).alias("year"),
    )
    return out if aliases is None or utilities is None else with_canonical_utility(out, aliases, utilities)


def nearest_header_column(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """A value column takes the header whose column is closest, the first of equals."""
    heads = headers.groupBy(KEY).agg(F.collect_list(F.struct(F.col("col_idx").alias("h"), "label")).alias("_heads"))
    nearest = F.array_min(F.transform("_heads", lambda x: F.struct(F.abs(F.col("col_idx") - x["h"]).alias("d"), x["h"].alias("h"), x["label"].alias("label"))))
    return cells.join(heads, KEY).select(*cells.columns, nearest["label"].alias("nearest_label"))


def simple_matrix(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Category by column; the column's label is the utility."""
    out = melt(rows, labels, 1)
    return out.select(KEY, "row_no", tx.strip(cell(0)).alias("category"), F.col("label").alias("utility"), "value", tx.extract_unit(F.col("label")).alias("charge_unit"))


def key_value(rows: DataFrame, key_col: int = 0, value_col: int = 1) -> DataFrame:
    """Pairs of a key and a number; others are dropped."""
    pairs = rows.select(KEY, "row_no", tx.strip(cell(key_col)).alias("metric"), tx.parse_number(cell(value_col)).alias("value"))
    return pairs.where("metric <> '' AND value IS NOT NULL").withColumn("charge_unit", tx.extract_unit(F.col("metric")))


def narrative_hierarchy(rows: DataFrame) -> DataFrame:
    """A master row sets the category and clears the child, a child row sets the subcategory; last number of the row."""
    master, child = F.col("row_label") == "master", F.col("row_label") == "child"
    body = rows.withColumn("_seg", F.sum(master.cast("int")).over(ordered()))
    w = Window.partitionBy(KEY, "_seg").orderBy("row_no")
    body = body.withColumn("category", F.last(F.when(master, tx.strip(cell(0))), ignorenulls=True).over(w))
    body = body.withColumn("subcategory", F.last(F.when(child, tx.strip(cell(1))), ignorenulls=True).over(w))
    numbers = F.filter(F.transform(F.slice("cells", 4, F.greatest(F.size("cells"), F.lit(1))), lambda c: tx.parse_number(c)), lambda n: n.isNotNull())
    return body.withColumn("value", F.try_element_at(numbers, F.lit(-1))).where("value IS NOT NULL").select(KEY, "row_no", "category", F.coalesce("subcategory", F.lit("")).alias("subcategory"), "value")


def narrative_fill(rows: DataFrame, charge: int = 4, period: int = 6, policy: int | None = None) -> DataFrame:
    """Charge, period and policy carried inside a state; rows before the first utility are dropped.

    The policy is the configured cell, or the longest cell of more than 30 letters; a
    period has fewer than 30 letters and does not start with a colon.
    """
    named = filled(cell(0))
    body = rows.withColumn("state", carry(named))
    before = F.lag("state").over(ordered())
    body = body.withColumn("_seg", F.sum(F.coalesce((F.col("state") != before).cast("int"), F.lit(0))).over(ordered()))
    longest = F.try_element_at(F.array_sort(F.filter("cells", lambda c: F.length(c) > 30), lambda a, b: F.length(b) - F.length(a)), F.lit(1))
    text = filled(cell(policy)) if policy is not None else longest
    length = F.when((F.length(cell(period)) < 30) & ~cell(period).startswith(":"), filled(cell(period)))
    for name, value in (("charge", filled(cell(charge))), ("period", length), ("policy", text), ("utility", filled(cell(1)))):
        body = body.withColumn(name, carry(value, segment="_seg"))
    return body.where("utility IS NOT NULL").select(KEY, "row_no", "state", "utility", "charge", "period", "policy")


def append_continuations(rows: DataFrame) -> DataFrame:
    """I16: rows with policy text only are appended to the policy of the record above (needs ``is_record``, ``policy``)."""
    owner = F.sum(F.col("is_record").cast("int")).over(ordered())
    owned = rows.withColumn("record_no", owner).where("record_no > 0")
    parts = F.transform(F.sort_array(F.collect_list(F.when(F.col("policy") != "", F.struct("row_no", "policy")))), lambda p: p["policy"])
    return owned.groupBy(KEY, "record_no").agg(F.min("row_no").alias("row_no"), F.array_join(parts, "\n").alias("policy"), F.count("*").alias("lines"))


def inherit_parent_payload(rows: DataFrame, payload: list[str], emit_parent: bool = False) -> DataFrame:
    """The payload of a parent row is copied to the rows below it (needs ``is_parent``)."""
    parent = F.when(F.col("is_parent"), F.struct(*payload))
    out = rows.withColumn("_p", carry(parent)).where("_p IS NOT NULL")
    out = out if emit_parent else out.where("NOT is_parent")
    return out.withColumns({c: F.col(f"_p.{c}") for c in payload}).drop("_p")


def with_record_id(records: DataFrame, parameter: str, parts: list[str]) -> DataFrame:
    """Identity of a record from its parameter, state, utility and further columns."""
    return records.withColumn("record_id", tx.record_id(F.lit(parameter), *[F.col(p) for p in parts]))


def block_records_nested(rows: DataFrame, labels: DataFrame, first: int = 4) -> DataFrame:
    """One row a block row: a map of label to cell, with the block's utility carried."""
    names = labels.groupBy(KEY).agg(F.transform(F.sort_array(F.collect_list(F.struct("col_idx", "label"))), lambda x: x["label"]).alias("names"))
    joined = rows.join(names, KEY)
    w = Window.partitionBy(KEY, "block_no").orderBy("row_no")
    joined = joined.withColumn("utility", F.last(filled(cell(1)), ignorenulls=True).over(w))
    size = F.size("cells") - first
    return joined.select(KEY, "block_no", "row_no", "utility", F.map_from_arrays(F.slice("names", first + 1, size), F.slice("cells", first + 1, size)).alias("values"))


def nested_blocks(rows: DataFrame, layouts: DataFrame, most: int = NESTED_ROWS, count: int | None = None) -> DataFrame:
    """I19, whole: every block as one row, nested by its layout (``layouts``: block, layout).

    Blank cells go first.  A ``matrix`` has sections: a row of one cell names one, a row that
    begins with ``category`` names the columns of what follows, other rows are entries of
    their section once columns are known.  A ``simple_matrix`` takes its columns from its
    first row.  A ``key_value`` block has metrics, and its utility from the last row that begins
    with ``category``.  An entry maps columns to cells as far as both go; of equal columns
    the last counts.  ``columns`` of a section are those known where it begins.

    A block that spans more than ``most`` rows goes on in rows of the next ``part``, so no row
    grows with the table.  Each has the columns and utility of its block; a section that goes on
    is named again, and its ``columns`` stand where it begins.  With ``count``, the number of all
    rows, parts are dealt to as many tasks as those need.
    """
    block = [KEY, "block_no"]
    c = rows.join(layouts.select(*block, "layout"), block).withColumn("c", F.filter(F.transform("cells", lambda x: tx.strip(F.coalesce(x, F.lit("")))), lambda x: x != ""))
    c = c.where(F.size("c") > 0)
    first, rest = F.get("c", F.lit(0)), F.slice("c", 2, F.greatest(F.size("c"), F.lit(1)))
    named, matrix, simple = F.lower(first) == "category", F.col("layout") == "matrix", F.col("layout") == "simple_matrix"
    wide = named & (F.size("c") > 1)
    ends = c.groupBy(*block).agg(F.min("row_no").alias("_first"), F.count("*").alias("_n"), F.max_by(F.get("c", F.lit(1)), F.when(wide, F.col("row_no"))).alias("_utility"))
    c = c.join(ends, block).withColumns({"_head": F.when(simple, F.col("row_no") == F.col("_first")).otherwise(wide), "part": F.floor((F.col("row_no") - F.col("_first")) / most).cast("int")})
    c = c.withColumn("_starts", matrix & (F.size("c") == 1) & ~F.col("_head"))
    if count is not None:
        c = c.repartition(max(-(-count // TASK_ROWS), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *block, "part")
    c = running(c, last={"_columns": F.when(F.col("_head"), rest), "_name": F.when(F.col("_starts"), first)}, sums={"_section": F.col("_starts").cast("int")}, key=block, run="part")
    n = F.least(F.size("_columns"), F.size("c") - 1)
    pairs = F.arrays_zip(F.slice("_columns", 1, n).alias("k"), F.slice(rest, 1, n).alias("v"))
    later = lambda e, i: F.exists(F.slice("_pairs", i + 2, F.greatest(F.size("_pairs"), F.lit(1))), lambda f: f["k"] == e["k"])
    c = c.withColumn("_pairs", F.when(F.col("_columns").isNotNull() & (n >= 0), pairs))
    values = F.map_from_entries(F.filter("_pairs", lambda e, i: ~later(e, i)))
    entry = ~F.col("_head") & F.col("_columns").isNotNull() & F.when(matrix, (F.col("_section") > 0) & ~F.col("_starts")).otherwise(simple)
    c = c.withColumn("_entry", F.when(entry, F.struct("row_no", first.alias("category"), values.alias("values"))))
    ordered_list = lambda x: F.sort_array(F.collect_list(x))
    # maps cannot be ordered, so entries are put in order by their row
    entries = F.array_sort(F.collect_list("_entry"), lambda a, b: F.signum(a["row_no"] - b["row_no"]).cast("int"))
    # the parts of a block lie as they were carried, so they are not shuffled again
    part = [*block, "part", "layout"]
    parts = c.groupBy(*part, "_section").agg(
        F.max("_name").alias("name"),
        F.max_by("_columns", F.when(F.col("_starts"), F.col("row_no"))).alias("section_columns"),
        F.max_by("_columns", "row_no").alias("columns"),
        entries.alias("rows"),
        ordered_list(F.when(~F.col("_head") & (F.size("c") >= 2), F.struct("row_no", first.alias("metric"), F.get("c", F.lit(1)).alias("value")))).alias("metrics"),
        F.max("_utility").alias("utility"), F.max("_n").alias("n"),
    )
    section = F.when((F.col("_section") > 0) & (F.col("layout") == "matrix"), F.struct("_section", "name", F.col("section_columns").alias("columns"), "rows"))
    out = parts.groupBy(*part).agg(
        F.array_sort(F.collect_list(section), lambda a, b: F.signum(a["_section"] - b["_section"]).cast("int")).alias("sections"),
        F.max_by("columns", "_section").alias("columns"), F.max_by("rows", "_section").alias("rows"), F.max_by("metrics", "_section").alias("metrics"),
        F.max_by("utility", "_section").alias("utility"), F.max("n").alias("n"),
    )
    whole, pair = (F.col("layout") == "simple_matrix") & (F.col("n") > 1), F.col("layout") == "key_value"
    return out.select(
        *block, "part", F.col("layout").alias("parser_type"), "sections",
        F.when(whole, F.col("columns")).alias("columns"), F.when(whole, F.col("rows")).alias("rows"),
        F.when(pair, F.col("metrics")).alias("metrics"), F.when(pair, F.col("utility")).alias("utility"),
    )


def flat_blocks(nested: DataFrame) -> DataFrame:
    """The cells of nested blocks again: section, category or metric, column and value; blocks are read once."""
    block = [KEY, "block_no", "parser_type"]
    line = lambda section, r, category, cells: F.struct(section.cast("string").alias("section"), r["row_no"].alias("row_no"), category.alias("category"), cells.alias("cells"))
    pairs = lambda values: F.transform(F.map_entries(values), lambda e: F.struct(e["key"].alias("label"), e["value"].alias("value")))
    entries = lambda rows, section: F.transform(rows, lambda r: line(section, r, r["category"], pairs(r["values"])))
    metric = lambda m: line(F.lit(None), m, m["metric"], F.array(F.struct(F.col("utility").alias("label"), m["value"].alias("value"))))
    found = [F.flatten(F.transform("sections", lambda s: entries(s["rows"], s["name"]))), entries(F.col("rows"), F.lit(None)), F.transform("metrics", metric)]
    lines = nested.select(*block, F.explode(F.flatten(F.array_compact(F.array(*found)))).alias("l"))
    return lines.select(*block, "l.section", "l.row_no", "l.category", F.inline("l.cells"))


def parse_summary(records: DataFrame, rows: DataFrame) -> DataFrame:
    """Records and rows of every report, and whether parsing gave anything."""
    n = records.groupBy(KEY).agg(F.count("*").alias("record_count"), F.count_distinct("row_no").alias("rows_used"))
    all_ = rows.groupBy(KEY).agg(F.count("*").alias("rows_processed"))
    out = all_.join(n, KEY, "left").na.fill(0, ["record_count", "rows_used"])
    return out.withColumn("status", F.when(F.col("record_count") == 0, "empty").otherwise("success"))


def source_pages(records: DataFrame, keys: list[str]) -> DataFrame:
    """The pages and rows that the records of a key come from."""
    return records.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_set("pdf_page")), ",").alias("pages"), F.min("row_no").alias("first_row"), F.max("row_no").alias("last_row"))


def classify_record_rows(rows: DataFrame, charge: int = 4, period: int = 6) -> DataFrame:
    """A row with a utility is a record, another one a continuation; flags for charge and period."""
    return rows.select(
        KEY, "row_no",
        F.when(~tx.is_blank(cell(1)), "record").otherwise("continuation").alias("row_type"),
        (~tx.is_blank(cell(charge))).alias("has_charge"),
        (~tx.is_blank(cell(period)) & (cell(period) != "-")).alias("has_period"),
    )


def group_members(rows: DataFrame) -> DataFrame:
    """A master row starts a group; named rows below it are its members in order (needs ``is_master``, ``utility``)."""
    out = rows.withColumn("group_no", F.sum(F.col("is_master").cast("int")).over(ordered())).where("group_no > 0")
    members = F.transform(F.sort_array(F.collect_list(F.when(~F.col("is_master") & (F.col("utility") != ""), F.struct("row_no", "utility")))), lambda m: m["utility"])
    out = out.groupBy(KEY, "group_no").agg(F.min_by("state", "row_no").alias("state"), F.min_by("utility", "row_no").alias("master"), members.alias("m"))
    return out.select(KEY, "group_no", "state", "master", F.array_join("m", ",").alias("members"), F.size("m").alias("member_count"))


def parent_or_child_values(rows: DataFrame, value_col: int = 4) -> DataFrame:
    """A row that names a state is a record without utility; other named rows lie under the current state."""
    named = filled(cell(0))
    out = rows.withColumn("state", carry(named)).withColumn("utility", F.when(named.isNull(), filled(cell(1))))
    out = out.where(named.isNotNull() | F.col("utility").isNotNull()).where("state IS NOT NULL")
    return out.select(KEY, "row_no", "state", "utility", tx.parse_number(cell(value_col)).alias("value"))
