"""Headers of tables and the meaning of columns and cells (group H)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import text as tx

KEY = "report_id"
#: Header rows that are looked for where no row is labelled.
MOST_HEADER_ROWS = 5
# fixed values: words that tell a column's role, in order
ROLE_WORDS = [
    ("utility", r"utility|discom|licensee"),
    ("voltage", r"voltage|kv|tension"),
    ("category", r"category|consumer"),
    ("serial_number", r"s\.no|sl\.no|^sno$"),
]


def header_depth(rows: DataFrame, most: int = MOST_HEADER_ROWS) -> DataFrame:
    """H1: leading rows labelled header, or leading rows of the first ``most`` without a number that is no year; 1 at least."""
    number = lambda c: F.regexp_replace(F.trim(c), "[,%]", "").try_cast("double")
    year = lambda c: number(c).between(1990, 2100) | F.trim(c).contains("-") | F.trim(c).contains("/")
    data = F.exists("cells", lambda c: F.coalesce(number(c).isNotNull() & ~year(c), F.lit(False)))
    label = F.col("row_label") if "row_label" in rows.columns else F.lit("")
    # numbers are looked for in the first rows only
    top = rows.select(KEY, "row_no", F.when(F.col("row_no") <= most, data).alias("data"), (label != "header").alias("body"))
    per = top.groupBy(KEY).agg(F.count("*").alias("n"), F.min(F.when(F.col("data"), F.col("row_no"))).alias("first_data"), F.min(F.when(F.col("body"), F.col("row_no"))).alias("first_body"))
    detected = F.coalesce(F.col("first_data") - 1, F.least(F.lit(most), F.col("n")))
    labelled = F.coalesce(F.col("first_body") - 1, F.col("n"))
    return per.select(KEY, F.greatest(F.lit(1), F.least(F.greatest(detected, labelled), F.col("n"))).cast("int").alias("depth"))


def header_cells(rows: DataFrame, depths: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(depths), KEY).where("row_no <= depth").select(KEY, "row_no", F.posexplode("cells").alias("col_idx", "cell")).withColumn("cell", tx.strip(F.col("cell")))


def fill_header_spans(rows: DataFrame, depths: DataFrame) -> DataFrame:
    """H2: the first header row is filled from the left; later rows from above, else from the left.

    A blank cell below takes the filled one above it, else the one to its left.  A column
    is thus begun by the first row that has text at or left of it, with the last such
    text; below that it keeps the last text of its own.  Headers of any depth are filled
    by windows along rows and columns.
    """
    cells = header_cells(rows, depths)
    own = F.when(F.col("cell") != "", F.col("cell"))
    across = Window.partitionBy(KEY, "row_no").orderBy("col_idx")
    column = Window.partitionBy(KEY, "col_idx")
    held = cells.withColumn("_own", own).withColumn("_left", F.last(own, ignorenulls=True).over(across))
    held = held.withColumn("_begin", F.min(F.when(F.col("_left").isNotNull(), F.col("row_no"))).over(column))
    text = F.when(F.col("row_no") == F.col("_begin"), F.col("_left")).otherwise(F.col("_own"))
    filled = F.coalesce(F.last(text, ignorenulls=True).over(column.orderBy("row_no")), F.lit(""))
    return held.select(KEY, "row_no", "col_idx", filled.alias("cell"))


def header_paths(filled: DataFrame) -> DataFrame:
    """H3: the path of every column from the top, without marks and repeats of the part above."""
    column = filled.groupBy(KEY, "col_idx").agg(F.transform(F.sort_array(F.collect_list(F.struct("row_no", "cell"))), lambda x: x["cell"]).alias("all"))
    parts = F.filter("all", lambda p: ~p.isin("", "/", "\\", "-"))
    once = F.filter("parts", lambda p, i: (i == 0) | (p != F.get(F.col("parts"), i - 1)))
    return column.withColumn("parts", parts).select(KEY, "col_idx", once.alias("header_path"))


def header_tree(paths: DataFrame) -> DataFrame:
    """Columns below every prefix of a header path."""
    prefixes = paths.where(F.size("header_path") > 0).select(KEY, "col_idx", F.explode(F.transform(F.sequence(F.lit(1), F.size("header_path")), lambda n: F.slice("header_path", 1, n))).alias("prefix"))
    return prefixes.groupBy(KEY, F.array_join("prefix", " > ").alias("prefix")).agg(F.array_join(F.sort_array(F.collect_set("col_idx")), ",").alias("columns"))


def describe_columns(paths: DataFrame) -> DataFrame:
    """H4: display name, year, unit, group, role and entity type of every column.

    The type is what cells of the role are; values are a percentage where the unit is
    ``%``, else a charge.
    """
    parts = F.filter(F.transform("header_path", lambda p: F.regexp_replace(p, r"^[\s/*+-]+|[\s/*+-]+$", "")), lambda p: p != "")
    name = F.when(F.size(parts) == 0, F.concat(F.lit("Column "), F.col("col_idx").cast("string"))).otherwise(F.array_join(parts, " - "))
    text = F.array_join("header_path", " ")
    year = F.regexp_extract(text, tx.YEAR_LABEL, 0)
    unit = tx.extract_unit(text, "")
    low = F.lower(F.col("display_name"))
    out = paths.select(KEY, "col_idx", name.alias("display_name"), F.when(year != "", year).alias("year"), F.when(unit != "", unit).alias("unit"), F.when(F.size(parts) > 1, F.get(parts, F.lit(0))).alias("group"))
    role = F.when((F.col("col_idx") == 0) & low.rlike(r"\bstate\b|union territory|\but\b"), "state")
    for r, words in ROLE_WORDS:
        role = role.when(low.rlike(words), r)
    value = F.col("unit").isNotNull() | F.col("year").isNotNull() | low.rlike("charge|value")
    out = out.withColumn("role", role.when(value, "value").otherwise("unknown"))
    amount = F.when(F.col("unit") == "%", "percentage").otherwise("charge")
    return out.withColumn("entity_type", F.when(F.col("role") == "value", amount).otherwise(F.col("role")))


# fixed values: cells that say nothing
EMPTY_CELLS = ("", "NA", "N/A", "na", "n/a", "-")


def cells_in_context(rows: DataFrame, columns: DataFrame, depths: DataFrame, match_states) -> DataFrame:
    """Every cell with its column's header, role and unit, and the state that its row's state column names.

    ``match_states`` takes distinct values and returns their canonical states; the
    state column is the first with that role, else the first of all.
    """
    place = columns.groupBy(KEY).agg(F.min(F.when(F.col("role") == "state", F.col("col_idx"))).alias("_s"))
    # one row a report each
    base = rows.join(F.broadcast(depths), KEY).join(F.broadcast(place), KEY, "left").select(KEY, "row_no", "cells", (F.col("row_no") <= F.col("depth")).alias("head"), F.coalesce("_s", F.lit(0)).alias("_s"))
    base = base.withColumn("_own", F.when(~F.col("head"), F.get("cells", F.col("_s"))))
    # most rows leave the state to the rows above; these are joined with nothing, so they meet in no task
    named, own = F.coalesce(F.col("_own") != "", F.lit(False)), base.select(F.col("_own").alias("value"))
    states = match_states(own.where("value <> ''").distinct())
    states = states.where("canonical IS NOT NULL").select(F.col("value").alias("_own"), F.col("canonical").alias("state"))
    base = base.where(named).join(states, "_own", "left").unionByName(base.where(~named), allowMissingColumns=True)
    cells = base.select(KEY, "row_no", "head", "state", F.posexplode("cells").alias("col_idx", "value"))
    seen = columns.select(KEY, "col_idx", F.col("display_name").alias("header"), "role", F.col("unit").alias("column_unit"))
    return cells.withColumn("value", tx.strip(F.coalesce("value", F.lit("")))).join(seen, [KEY, "col_idx"], "left")


def _says_something() -> Column:
    return F.coalesce(~F.col("head") & ~F.col("value").isin(*EMPTY_CELLS), F.lit(False))


def triples_of(cells: DataFrame) -> DataFrame:
    """The distinct (value, header, state) of the cells that say something."""
    return cells.where(_says_something()).select("value", F.coalesce("header", F.lit("")).alias("header"), F.coalesce("state", F.lit("")).alias("state")).distinct()


def annotate_cells(cells: DataFrame, entities: DataFrame) -> DataFrame:
    """H5: what every cell is: header, empty, an entity, or a number typed by its column's role.

    ``cells`` comes from ``cells_in_context``, ``entities`` from recognising their
    triples.  Years, voltages, states, utilities and serial numbers are no numbers; a
    charge has its column's unit or ``Rs/kWh``, a percentage ``%``.
    """
    key = {"value": F.col("value"), "header": F.coalesce("header", F.lit("")), "state": F.coalesce("state", F.lit(""))}
    known = entities.where("entity_type <> 'unknown'").select(*[F.col(k).alias(f"_{k}") for k in key], F.col("entity_type").alias("_type"), F.col("canonical").alias("_name"), F.col("confidence").alias("_sure"))
    # entities grow with the names in a grid, so both sides are sorted; headers and blanks, of which there are many alike, stay out
    said = _says_something()
    joined = cells.where(said).join(known.hint("merge"), [c == F.col(f"_{k}") for k, c in key.items()], "left")
    joined = joined.unionByName(cells.where(~said), allowMissingColumns=True)
    number = tx.parse_number(F.col("value"))
    found = F.coalesce("_type", F.lit("unknown")) != "unknown"
    share = (F.col("column_unit") == "%") | F.contains("value", F.lit("%"))
    kind = (
        F.when(F.col("head"), "header").when(F.col("value").isin(*EMPTY_CELLS), "empty").when(found, F.col("_type")).when(number.isNull(), "unknown")
        .when(F.col("role").isin("serial_number", "voltage"), F.col("role")).when((F.col("role") == "value") & F.coalesce(share, F.lit(False)), "percentage").otherwise("charge")
    )
    out = joined.withColumn("annotation", kind).withColumn("_number", number)
    named = F.col("annotation").isin("year", "voltage", "header", "serial_number", "state", "utility", "empty")
    level = F.when((F.col("annotation") == "voltage") & ~found, F.concat(F.col("_number").cast("long").cast("string"), F.lit(" kV")))
    canonical = F.when(F.col("annotation") == "empty", None).when(F.col("head"), F.col("value")).when(found, F.col("_name")).otherwise(F.coalesce(level, F.col("value")))
    sure = F.when(F.col("annotation").isin("header", "empty"), 1.0).when(found, F.col("_sure")).when(F.col("annotation") == "unknown", 0.0).otherwise(0.95)
    unit = F.when(F.col("annotation") == "percentage", "%").when(F.col("annotation") == "charge", F.coalesce("column_unit", F.lit("Rs/kWh")))
    return out.select(KEY, "row_no", "col_idx", "annotation", canonical.alias("canonical"), sure.alias("confidence"), F.when(~named, F.col("_number")).alias("number"), unit.alias("unit"), F.col("header").alias("context"), "state")


def annotated_numbers(cells: DataFrame, value: Column, annotation: Column) -> DataFrame:
    """H6: numbers of cells whose annotation allows one."""
    return cells.withColumn("number", tx.parse_number(value, annotation))
