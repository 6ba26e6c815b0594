"""Names and phrases found in texts by joins on equal pieces, never name by name.

A name is looked for under its longest word.  The distinct words of all texts are cut
into all pieces that are as long as the longest word of some name; a piece equal to such a
word leads from the word to the name, and the word leads to the texts.  All joins are on
equal keys and sort both sides, so dictionary and texts may both be large: neither is
sent whole through the driver, and no piece meets words that do not hold the name's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def pieces(text: Column, n: int | Column) -> Column:
    """The distinct pieces of ``n`` letters of a text."""
    size = n if isinstance(n, Column) else F.lit(n)
    at = F.sequence(F.lit(1), F.greatest(F.length(text) - (size - 1), F.lit(1)))
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(at, lambda i: F.substring(text, i, size)))).otherwise(F.array().cast("array<string>"))


def words(text: Column) -> Column:
    """The distinct runs without white space."""
    return F.filter(F.array_distinct(F.split(text, r"\s+")), lambda w: w != "")


def _anchored(names: DataFrame) -> DataFrame:
    """Names with their longest word, the last in order of equals; names without a word find nothing."""
    longest = F.array_max(F.transform(words(F.col("name")), lambda w: F.struct(F.length(w), w.alias("word"))))
    return names.select("name", longest["word"].alias("anchor")).where("anchor IS NOT NULL")


def _holding_words(found: DataFrame, names: DataFrame) -> DataFrame:
    """(word, name) of every word that holds the longest word of a name."""
    anchored = _anchored(names)
    lengths = anchored.select(F.length("anchor").alias("n")).distinct()
    sized = found.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("n")).join(F.broadcast(lengths), "n")
    cut = sized.select("word", F.explode(pieces(F.col("word"), F.col("n"))).alias("anchor"))
    return cut.join(anchored.hint("merge"), "anchor").select("word", "name")


def held_names(texts: DataFrame, names: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Every (text, name) where the text holds the name; with ``key``, those columns of ``texts`` instead of the text.

    ``texts`` has distinct texts, or distinct keys; ``names`` distinct names.  Null and
    blank texts and names give nothing.
    """
    columns = key or ["text"]
    posts = texts.select(*columns, F.explode(words(F.col("text"))).alias("word"))
    met = posts.join(_holding_words(posts.select("word").distinct(), names).hint("merge"), "word").select(*columns, "name").distinct()
    if key:
        met = texts.join(met.hint("merge"), key)
    return met.where(F.contains("text", "name")).select(*columns, "name")


def held_words(texts: DataFrame, names: DataFrame) -> DataFrame:
    """Every (text, name) where the words of the name stand in the text one after the other; marks part words."""
    plain = lambda c: F.trim(F.regexp_replace(c, r"\W+", " "))
    spelt = texts.select("text", plain("text").alias("_t"))
    sought = names.select("name", plain("name").alias("_n")).where("_n <> ''")
    anchored = _anchored(sought.select(F.col("_n").alias("name")).distinct()).withColumnRenamed("name", "_n")
    posts = spelt.select("text", "_t", F.explode(words(F.col("_t"))).alias("anchor"))
    framed = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    met = posts.join(anchored.hint("merge"), "anchor").where(F.contains(framed(F.col("_t")), framed(F.col("_n")))).select("text", "_n")
    return met.join(sought.hint("merge"), "_n").select("text", "name")
