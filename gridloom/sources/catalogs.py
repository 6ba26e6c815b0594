"""Catalog dimensions (A3): canonical names with their aliases in priority order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def names(df: DataFrame, column: str, priority: Column, kind: str) -> DataFrame:
    """alias (lower-case key), canonical, kind and priority of a column of names; the priority comes from a key, so no table is numbered."""
    return df.select(F.lower(F.trim(column)).alias("alias"), F.col(column).alias("canonical"), F.lit(kind).alias("kind"), priority.alias("priority"))


def ranked(df: DataFrame, column: str) -> DataFrame:
    """The few distinct names of a column with their place in alphabetical order."""
    return df.agg(F.sort_array(F.collect_set(column)).alias("_all")).select(F.posexplode("_all").alias("place", column)).withColumn("place", F.col("place") + 1)


def catalogs_of(nation: DataFrame, region: DataFrame, customer: DataFrame) -> dict[str, DataFrame]:
    """Places, groups and organisations as dimensions; ``aliases`` is all small ones together."""
    segments = ranked(customer, "c_mktsegment")
    states = names(region, "r_name", (F.col("r_regionkey") + 1).cast("int"), "region")
    nations = names(nation, "n_name", (F.col("n_nationkey") + 1).cast("int"), "nation")
    groups = names(segments, "c_mktsegment", F.col("place"), "segment")
    utilities = customer.select(F.lower("c_name").alias("alias"), F.col("c_name").alias("canonical"), F.col("c_mktsegment").alias("state"))
    return {"aliases": states.unionByName(nations).unionByName(groups), "states": groups, "nations": nations, "utilities": utilities}


#: The files of a catalog folder and what each holds: a list of names, names by alias, lists by name, or entries with aliases by name.
CATALOG_FILES = {
    "states": "array<string>",
    "state_aliases": "map<string,string>",
    "utilities": "map<string,array<string>>",
    "voltages": "map<string,struct<aliases:array<string>>>",
    "units": "map<string,array<string>>",
    "categories": "map<string,struct<aliases:array<string>,subcategories:array<string>>>",
}


def load_catalogs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """A3: the nested files of a catalog folder as flat dimensions.

    Each file is JSON with one field of its own name (``{"states": [...]}``).  Names are
    trimmed, aliases also lower-cased; ``priority`` is the place in the file.  States and
    utilities have canonical and priority (utilities their state, too); state_aliases,
    voltages, units and categories have alias and canonical, every name being an alias of
    itself; subcategories have their category.  Blank names go.
    """

    def content(name: str) -> DataFrame:
        return spark.read.option("multiLine", True).schema(f"{name} {CATALOG_FILES[name]}").json(f"{folder}/{name}.json")

    def listed(name: str) -> DataFrame:
        """key, priority and value of a file of entries by name."""
        return content(name).select(F.posexplode(F.map_entries(name)).alias("priority", "e")).select("priority", F.trim("e.key").alias("key"), F.col("e.value").alias("value"))

    def aliased(name: str, aliases: Column) -> DataFrame:
        own = F.concat(F.array("key"), F.coalesce(aliases, F.array().cast("array<string>")))
        rows = listed(name).select("priority", "key", F.posexplode(own).alias("place", "alias"))
        return rows.select(F.lower(F.trim("alias")).alias("alias"), F.col("key").alias("canonical"), "priority", "place").where("alias <> ''")

    states = content("states").select(F.posexplode("states").alias("priority", "canonical")).withColumn("canonical", F.trim("canonical")).where("canonical <> ''")
    utilities = listed("utilities").select(F.col("key").alias("state"), "priority", F.posexplode("value").alias("place", "canonical"))
    utilities = utilities.withColumn("canonical", F.trim("canonical")).where("canonical <> ''")
    aliases = listed("state_aliases").select(F.lower("key").alias("alias"), F.trim("value").alias("canonical"), "priority")
    below = listed("categories").select(F.col("key").alias("category"), F.explode("value.subcategories").alias("subcategory"))
    return {
        "states": states, "state_aliases": aliases, "utilities": utilities,
        "voltages": aliased("voltages", F.col("value.aliases")), "units": aliased("units", F.col("value")), "categories": aliased("categories", F.col("value.aliases")),
        "subcategories": below.withColumn("subcategory", F.lower(F.trim("subcategory"))),
    }


def write_catalogs(tables: dict[str, DataFrame], folder: str) -> None:
    """One JSON file for each of ``tables``, which have a single row and column."""
    for name, df in tables.items():
        df.coalesce(1).write.json(f"{folder}/{name}.json")
