"""Geometry, text, implied groups and blocks of merged grids (group E)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import text as tx
from gridloom.operators.dictionary import held_names, held_words
from gridloom.operators.running import running

# fixed values: words that no group name holds
EXCLUDED_WORDS = (
    "ht", "lt", "eht", "category", "power", "surcharge", "charge", "voltage", "level", "kv", "utility", "discom", "tension",
    "industry", "industries", "supply", "domestic", "commercial", "traction", "irrigation", "general", "billing", "period",
    "policy", "residential", "apartment", "apartments", "township", "townships", "colony", "colonies", "villa", "villas",
    "station", "stations",
)


# fixed values: letters that tell a section, in the order they are listed
SECTIONS = (("EHT", ("eht", "extra high tension")), ("HT", ("ht", "high tension")), ("LT", ("lt", "low tension")))


def ordered(key: str = "report_id"):
    return Window.partitionBy(key).orderBy("row_no")


def align_headers(rows: DataFrame, depth: int = 4, key: str = "report_id") -> DataFrame:
    """Header text one column off its data is moved onto it.

    A column has header text only, data only, both or neither.  Within a maximal run of
    columns that alternate between header only and data only, the first and second, third
    and fourth, ... are pairs; the non-blank header cells of a pair move to its data column.
    """
    cells = rows.select(key, "row_no", F.posexplode("cells").alias("col_idx", "cell"))
    text = F.col("cell").isNotNull() & ~tx.is_blank(F.col("cell")) & ~tx.strip(F.col("cell")).isin("/", "\\", "-")
    head = F.max(F.when(F.col("row_no") <= depth, text).otherwise(False))
    data = F.max(F.when(F.col("row_no") > depth, ~tx.is_blank(F.col("cell"))).otherwise(False))
    columns = cells.groupBy(key, "col_idx").agg(head.alias("h"), data.alias("d"))
    columns = columns.withColumn("kind", F.when(F.col("h") & ~F.col("d"), "H").when(F.col("d") & ~F.col("h"), "D"))
    w = Window.partitionBy(key).orderBy("col_idx")
    before = F.lag("kind").over(w)
    starts = F.col("kind").isNull() | before.isNull() | (before == F.col("kind"))
    columns = columns.withColumn("run", F.sum(starts.cast("int")).over(w))
    in_run = Window.partitionBy(key, "run").orderBy("col_idx")
    columns = columns.withColumn("place", F.row_number().over(in_run)).withColumn("next_kind", F.lead("kind").over(in_run)).withColumn("prev_kind", F.lag("kind").over(in_run))
    odd = F.col("place") % 2 == 1
    target = (
        F.when((F.col("kind") == "H") & odd & (F.col("next_kind") == "D"), F.col("col_idx") + 1)
        .when((F.col("kind") == "H") & ~odd & (F.col("prev_kind") == "D"), F.col("col_idx") - 1)
    )
    moves = columns.select(key, target.alias("to"), F.col("col_idx").alias("from")).where("to IS NOT NULL")
    held = moves.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("to", "from"))).alias("into"), F.collect_list("from").alias("gone"))
    joined = rows.join(held, key, "left")

    def moved(c: Column, i: Column) -> Column:
        source = F.get("cells", F.try_element_at("into", i))
        return F.when(~tx.is_blank(F.coalesce(source, F.lit(""))), source).when(F.array_contains("gone", i), F.lit("")).otherwise(c)

    new = F.when(F.col("into").isNotNull() & (F.col("row_no") <= depth), F.transform("cells", moved)).otherwise(F.col("cells"))
    return joined.withColumn("cells", new).select(rows.columns)


def drop_empty_columns(rows: DataFrame, key: str = "report_id") -> DataFrame:
    """Columns that are blank in all rows are dropped; flags of a table are one array."""
    width = rows.groupBy(key).agg(F.max(F.size("cells")).alias("width"))
    cells = rows.select(key, F.posexplode("cells").alias("col_idx", "cell")).where(~tx.is_blank(F.col("cell")))
    keep = cells.groupBy(key).agg(F.sort_array(F.collect_set("col_idx")).alias("keep")).join(width, key)
    joined = rows.join(keep.select(key, "keep"), key, "left")
    kept = F.transform(F.coalesce("keep", F.array().cast("array<int>")), lambda i: F.get("cells", i))
    return joined.withColumn("cells", kept).select(rows.columns)


def drop_empty_rows(rows: DataFrame) -> DataFrame:
    """Rows whose cells are all blank are dropped."""
    return rows.where(F.exists("cells", lambda c: ~tx.is_blank(c)))


def cleanup_stats(before: DataFrame, after: DataFrame, key: str = "report_id") -> DataFrame:
    """Rows and columns removed, and OCR tokens of the raw cells."""
    tokens = F.aggregate(F.transform("cells", tx.count_artifacts), F.lit(0), lambda a, b: a + b)
    b = before.groupBy(key).agg(F.count("*").alias("rows_before"), F.max(F.size("cells")).alias("cols_before"), F.sum(tokens).alias("cid_tokens_removed"))
    a = after.groupBy(key).agg(F.count("*").alias("rows_after"), F.max(F.size("cells")).alias("cols_after"))
    joined = b.join(a, key, "left").na.fill(0)
    return joined.select(key, (F.col("rows_before") - F.col("rows_after")).alias("empty_rows_removed"), (F.col("cols_before") - F.col("cols_after")).alias("empty_cols_removed"), "cid_tokens_removed")


def clean_cells(rows: DataFrame) -> DataFrame:
    """E5 and E6 on every cell."""
    return rows.withColumn("cells", F.transform("cells", tx.clean_cell))


def artifact_counts(rows: DataFrame, key: str = "report_id") -> DataFrame:
    """OCR tokens of every table."""
    return rows.groupBy(key).agg(F.sum(F.aggregate(F.transform("cells", tx.count_artifacts), F.lit(0), lambda a, b: a + b)).alias("cid_tokens"))


def _word(text: Column, name: Column) -> Column:
    """Whether ``name`` stands in ``text`` between word borders."""
    return F.concat(F.lit(" "), F.regexp_replace(text, r"\W+", " "), F.lit(" ")).contains(F.concat(F.lit(" "), F.regexp_replace(name, r"\W+", " "), F.lit(" ")))


def resolve_state(values: DataFrame, names: DataFrame, aliases: DataFrame, value: str = "value") -> DataFrame:
    """Canonical name of distinct values: exact, by alias, then a name or an alias as whole words.

    ``names`` has canonical and priority, ``aliases`` alias, canonical and priority.
    """
    keyed = values.select(value).distinct().withColumn("key", tx.normalize_key(F.col(value)))
    table = (
        names.select(F.lower("canonical").alias("name"), "canonical", "priority", F.lit(1).alias("exact"), F.lit(3).alias("inside"))
        .unionByName(aliases.select(F.lower("alias").alias("name"), "canonical", "priority", F.lit(2).alias("exact"), F.lit(4).alias("inside")))
    )
    keys = keyed.select(F.col("key").alias("text")).where("text IS NOT NULL").distinct()
    inside = held_words(keys, table.select("name").distinct()).join(table, "name").select(F.col("text").alias("key"), "canonical", "priority", F.col("inside").alias("step"))
    same = table.select(F.col("name").alias("key"), "canonical", "priority", F.col("exact").alias("step"))
    best = inside.unionByName(same).groupBy("key").agg(F.min_by(F.struct("canonical", "step"), F.struct("step", "priority")).alias("b"))
    method = F.element_at(F.array(*map(F.lit, ["exact", "alias", "name_word", "alias_word"])), F.col("b.step"))
    return keyed.join(best, "key", "left").select(value, F.col("b.canonical").alias("canonical"), F.when(F.col("b").isNotNull(), method).alias("method"))


def detect_group_in_row(rows: DataFrame, names: DataFrame, aliases: DataFrame, first: int = 4, key: str = "report_id") -> DataFrame:
    """The first of the first cells that names a group and holds no excluded word."""
    cells = rows.select(key, "row_no", F.posexplode(F.slice("cells", 1, first)).alias("col_idx", "value"))
    words = F.split(tx.normalize_key(F.col("value")), r"\W+")
    cells = cells.where(~tx.is_blank(F.col("value")) & ~F.arrays_overlap(words, F.array(*map(F.lit, EXCLUDED_WORDS))))
    found = cells.join(resolve_state(cells, names, aliases).where("canonical IS NOT NULL"), "value")
    return found.groupBy(key, "row_no").agg(F.min_by("canonical", "col_idx").alias("state"), F.min("col_idx").alias("col_idx"))


def detect_section_header(rows: DataFrame, col: int = 1, pattern: str = "(?i)low|medium|not available") -> DataFrame:
    """First cell blank, the configured cell holds a section word, and all later cells are blank."""
    label = F.get("cells", F.lit(col))
    rest = F.slice("cells", col + 2, F.greatest(F.size("cells"), F.lit(1)))
    flag = tx.is_blank(F.get("cells", F.lit(0))) & label.rlike(pattern) & F.forall(rest, tx.is_blank)
    return rows.withColumn("is_section", F.coalesce(flag, F.lit(False)))


def forward_fill_group(rows: DataFrame, col: int = 0, key: str = "report_id", section: Column | None = None) -> DataFrame:
    """A blank group cell takes the last named one; a section header resets the carry."""
    own = F.when(~tx.is_blank(F.get("cells", F.lit(col))), F.get("cells", F.lit(col)))
    reset = F.coalesce(section, F.lit(False)) if section is not None else F.lit(False)
    carried = running(rows, last={"_carried": F.when(own.isNotNull() | reset, F.struct(own.alias("v")))}, key=key)
    state = F.col("_carried.v")
    return carried.withColumn("state", F.coalesce(state, F.lit(""))).withColumn("propagated", own.isNull() & state.isNotNull()).drop("_carried")


def label_rows(rows: DataFrame, header_words: list[str], header_rows: int = 1) -> DataFrame:
    """Header, section_header, master, child, continuation or data; the first rule wins.

    Needs ``state`` (carried) and ``is_section``.
    """
    head = F.lower(F.array_join(F.slice("cells", 1, 3), " "))
    is_head = F.col("row_no") <= header_rows
    for w in header_words:
        is_head = is_head | head.contains(w.lower())
    c0, c1 = F.get("cells", F.lit(0)), F.get("cells", F.lit(1))
    values = F.exists(F.slice("cells", 3, F.greatest(F.size("cells"), F.lit(1))), lambda c: ~tx.is_blank(c))
    return rows.withColumn(
        "row_label",
        F.when(is_head, "header")
        .when(F.col("is_section"), "section_header")
        .when(~tx.is_blank(c0), "master")
        .when(~tx.is_blank(c1) & (F.col("state") != ""), "child")
        .when(tx.is_blank(c0) & tx.is_blank(c1) & values & (F.col("state") != ""), "continuation")
        .otherwise("data"),
    )


def segment_blocks_spanning(rows: DataFrame, starts: Column, key: str = "report_id") -> DataFrame:
    """A new block at every row that names a group; rows before the first are dropped."""
    return running(rows, sums={"block_no": starts.cast("int")}, key=key).where("block_no > 0")


def segment_blocks_column(rows: DataFrame, group: Column, key: str = "report_id") -> DataFrame:
    """A new block only where the resolved group changes; blank rows stay with the current one."""
    w = ordered(key)
    named = rows.withColumn("_g", group)
    before = F.last("_g", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    change = F.col("_g").isNotNull() & (before.isNull() | (before != F.col("_g")))
    return named.withColumn("block_no", F.sum(change.cast("int")).over(w)).where("block_no > 0").drop("_g")


def block_spans(rows: DataFrame, key: str = "report_id") -> DataFrame:
    """First and last row, and number of rows, of every block."""
    return rows.groupBy(key, "block_no").agg(F.min("row_no").alias("start_row"), F.max("row_no").alias("end_row"), F.count("*").alias("row_count"))


def segment_blocks_marker(rows: DataFrame, key: str = "report_id") -> DataFrame:
    """A block starts at a row with a year and a slash; its name is what follows the last slash, less the year."""
    text = F.array_join("cells", " ")
    marker = text.rlike(tx.YEAR_LABEL) & text.contains("/")
    name = tx.strip(F.regexp_replace(F.element_at(F.split(text, "/"), -1), tx.YEAR_LABEL, ""))
    w = ordered(key)
    out = rows.withColumn("_m", marker).withColumn("block_no", F.sum(marker.cast("int")).over(w)).withColumn("block_name", F.last(F.when(marker, name), ignorenulls=True).over(w))
    return out.where("block_no > 0 AND NOT _m").drop("_m")


def describe_blocks(rows: DataFrame, names: DataFrame | None = None, key: str = "report_id") -> DataFrame:
    """First year label, distinct utilities, sections and identity of every block (needs ``state``).

    ``names`` (name, canonical) holds the alias map and the catalog together: every
    canonical name whose name a cell of the block holds counts.  A block without any takes
    its cells with a word for a utility; sections go by letters, so EHT is HT, too.
    """
    cells = rows.select(key, "block_no", "row_no", "state", F.posexplode_outer("cells").alias("col_idx", "cell")).withColumn("text", F.lower("cell"))
    none = F.array().cast("array<string>")
    year = F.regexp_extract("cell", tx.YEAR_LABEL, 0)
    place = F.struct("row_no", "col_idx")
    has = lambda *parts: F.max(F.when(F.col("text").rlike("|".join(parts)), 1))
    out = cells.groupBy(key, "block_no").agg(
        F.min_by("state", "row_no").alias("state"),
        F.min_by(year, F.when(year != "", place)).alias("year"),
        F.sort_array(F.collect_set(F.when(F.col("text").rlike("discom|utility|licensee"), tx.strip(F.col("cell"))))).alias("worded"),
        F.array_join(F.array(*[F.when(has(*p) == 1, s) for s, p in SECTIONS]), ",").alias("sections"),
        F.min("row_no").alias("start_row"),
        F.max("row_no").alias("end_row"),
        F.count_if(F.coalesce(F.col("col_idx"), F.lit(0)) == 0).alias("row_count"),
    )
    if names is None:
        out = out.withColumn("held", none)
    else:
        # only cells that hold a name are joined, so blank ones meet in no task
        low = names.select(F.lower("name").alias("name"), "canonical").distinct()
        said = cells.where("text <> ''").select(key, "block_no", "text").distinct()
        met = held_names(said.select("text").distinct(), low.select("name").distinct()).join(low, "name").select("text", "canonical").distinct()
        held = said.join(met, "text").groupBy(key, "block_no").agg(F.sort_array(F.collect_set("canonical")).alias("held"))
        out = out.join(held, [key, "block_no"], "left").withColumn("held", F.coalesce("held", none))
    utilities = F.array_join(F.when(F.size("held") > 0, F.col("held")).otherwise(F.col("worded")), ",")
    block_id = F.concat_ws("_", F.col(key).cast("string"), F.replace(F.lower("state"), F.lit(" "), F.lit("_")), F.col("start_row").cast("string"), F.col("end_row").cast("string"))
    return out.select(key, "block_no", "state", "year", utilities.alias("utilities"), "sections", "start_row", "end_row", "row_count", block_id.alias("block_id"))


def utility_to_group(values: DataFrame, utilities: DataFrame, value: str = "value") -> DataFrame:
    """The group of a utility by its exact name, else of the first utility that stands in the value as words."""
    keyed = values.select(value).distinct().withColumn("key", tx.normalize_key(F.col(value)))
    exact = keyed.join(utilities, F.col("key") == F.col("alias")).groupBy(value).agg(F.min("state").alias("state"))
    left = keyed.join(exact, value, "left_anti")
    # a utility's name is found by its last word, so that the words are joined by equality
    last = F.element_at(F.split("alias", r"\W+"), -1)
    tokens = left.select(value, "key", F.explode(F.array_distinct(F.split("key", r"\W+"))).alias("word"))
    inside = tokens.join(utilities.withColumn("word", last), "word").where(_word(F.col("key"), F.col("alias")))
    inside = inside.groupBy(value).agg(F.min_by("state", "alias").alias("state"))
    found = exact.withColumn("method", F.lit("exact")).unionByName(inside.withColumn("method", F.lit("word")))
    return keyed.select(value).join(found, value, "left")
