"""Linking of quotations: who answers whom, and conversations without quotes.

A line that starts with ``>`` marks, blanks allowed between them, is quoted as often
as it has marks.  Quoted lines, whole runs of lines at one level, their sentences and
their shingles of six words are normalised and hashed, and joined to the earliest
message of the conversation that wrote the same passage itself, so a part of a message,
or one that was wrapped anew, finds its source.  A part of under six words that is no
whole sentence or line does not.  A message answers the message behind its shallowest
level of quotation, there the one with most matches, then the latest; a passage counts
as often as it has parts, so a whole one outweighs pieces of it elsewhere.  DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.storage import materialize

#: Words of a shingle.
_WIDTH = 6
_MARKS = r"^((?:[ \t]*>)+)[ \t]?"


def quote_lines(text: Column) -> Column:
    """The lines of a text as (level, body)."""

    def line(x: Column) -> Column:
        marks = F.regexp_extract(x, _MARKS, 1)
        level = F.length(F.regexp_replace(marks, "[^>]", ""))
        return F.struct(level.alias("level"), F.regexp_replace(x, _MARKS, "").alias("body"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), line)


def normalised(text: Column) -> Column:
    """Lower case, with white space and punctuation squeezed to single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\s\p{P}\p{S}]+", " "))


def _runs(lines: Column) -> Column:
    """Neighbouring lines of one level, joined: (level, body).  Linear in the lines."""

    def of(x: Column) -> Column:
        def joined(starts: Column) -> Column:
            def run(s: Column, k: Column) -> Column:
                part = F.slice(x, s + 1, F.coalesce(F.get(starts, k + 1), F.size(x)) - s)
                return F.struct(F.get(x, s)["level"].alias("level"), F.concat_ws(" ", F.transform(part, lambda y: y["body"])).alias("body"))

            return F.transform(starts, run)

        places = F.sequence(F.lit(0), F.size(x) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(x, i)["level"] != F.get(x, i - 1)["level"]))
        return F.flatten(F.transform(F.array(starts), joined))

    # bound as variables, the lines and the starts are made once and not for every run
    return F.flatten(F.transform(F.array(lines), of))


def _sentences(text: Column) -> Column:
    """The sentences of a text, split behind their end marks."""
    return F.split(text, r"(?<=[.!?…])[\p{P}]*\s+|(?<=[。！？])\s*")


def _pieces(body: Column, run: Column) -> Column:
    """Hashed (h1, h2, n) passages of one normalised text: itself, counting for all its shingles, and those shingles for a run."""

    def named(x: Column, n: Column) -> Column:
        # two independent hashes name a passage
        return F.struct(F.xxhash64(x).alias("h1"), F.hash(x, F.lit(7)).alias("h2"), n.cast("int").alias("n"))

    def of(words: Column) -> Column:
        last = F.size(words) - _WIDTH
        at = F.when(run & (last > 0), F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        shingles = F.transform(at, lambda i: named(F.concat_ws(" ", *[F.get(words, i + k) for k in range(_WIDTH)]), F.lit(1)))
        return F.concat(F.array(named(body, F.greatest(last + 1, F.lit(1)))), shingles)

    # bound as a variable, the words are split once and not for every shingle
    return F.flatten(F.transform(F.array(F.split(body, " ")), of))


def _passages(messages: DataFrame, quoted: bool) -> DataFrame:
    """(conv_id, turn, level, h1, h2, n) of the lines, runs, sentences and shingles that are quoted, or that are not."""
    wanted = (lambda x: x["level"] > 0) if quoted else (lambda x: x["level"] == 0)
    runs = F.filter("_runs", wanted)
    sentences = F.flatten(F.transform(runs, lambda r: F.transform(_sentences(r["body"]), lambda x: F.struct(r["level"].alias("level"), x.alias("body")))))
    # shingles of a run are those of its lines and sentences too
    whole = F.transform(F.concat(F.filter("_lines", wanted), sentences), lambda x: F.struct(x["level"], x["body"], F.lit(False).alias("run")))
    parts = F.concat(whole, F.transform(runs, lambda x: F.struct(x["level"], x["body"], F.lit(True).alias("run"))))
    rows = messages.select("conv_id", "turn", F.explode(parts).alias("part"))
    rows = rows.select("conv_id", "turn", "part.level", "part.run", normalised(F.col("part.body")).alias("body")).where("body <> ''")
    rows = rows.select("conv_id", "turn", "level", F.explode(_pieces(F.col("body"), F.col("run"))).alias("p"))
    return rows.select("conv_id", "turn", "level", "p.h1", "p.h2", "p.n")


def link_quotations(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without quotes, quoted_lines, reply_to, thread_root, thread_depth.

    Ordered by conversation, thread and turn, so that every message comes after the
    one it answers.  ``reply_to`` is the turn that is answered, null for a message that
    quotes no earlier message of its conversation; such a message is the root of a
    thread.  A text without quotes stays as it is.  Rows that share (conv_id, turn) share their links and all stay; a null
    conv_id or turn has no links.  Null text counts as empty.  Other columns are dropped.
    Of equal votes the latest source wins, and a passage that several wrote is the first
    one's.  No step holds a conversation: a hot one is only rows of a grouped minimum.
    """
    base = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.coalesce("text", F.lit("")).alias("_text"), quote_lines(F.col("text")).alias("_lines"))
    some = F.exists("_lines", lambda x: x["level"] > 0)
    quoting = base.where(some).withColumn("_runs", _runs(F.col("_lines")))
    quotes = _passages(quoting, True).distinct()
    # only conversations with quotes need their messages' own passages
    within = quoting.select("conv_id").distinct()
    own = base.join(within, "conv_id", "left_semi").withColumn("_runs", _runs(F.col("_lines")))
    own = _passages(own, False).drop("n").groupBy("conv_id", "h1", "h2").agg(F.min("turn").alias("source"))
    found = quotes.join(own, ["conv_id", "h1", "h2"]).where("source < turn")
    votes = found.groupBy("conv_id", "turn", "level", "source").agg(F.sum("n").alias("n"))
    links = votes.groupBy("conv_id", "turn").agg(F.max(F.struct((-F.col("level")).alias("level"), "n", "source"))["source"].alias("reply_to"))
    links = materialize(links, "replies")

    # follow the links upwards, twice as far in every round
    above = links.select("conv_id", "turn", F.col("reply_to").alias("root"), F.lit(1).cast("long").alias("depth"))
    while True:
        higher = above.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        moved = above.join(higher, ["conv_id", "root"], "left").select(
            "conv_id", "turn", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved")
        )
        moved = materialize(moved, "threads")
        above = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    tree = links.join(above, ["conv_id", "turn"])
    kept = F.array_join(F.transform(F.filter("_lines", lambda x: x["level"] == 0), lambda x: x["body"]), "\n")
    quoted = F.size(F.filter("_lines", lambda x: x["level"] > 0)).cast("long")
    clean = F.when(quoted == 0, F.col("_text")).otherwise(F.regexp_replace(kept, r"^\s+|\s+$", ""))
    out = base.select("conv_id", "turn", "role", clean.alias("text"), quoted.alias("quoted_lines"))
    out = out.join(tree, ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", "text", "quoted_lines", "reply_to",
        F.coalesce("root", "turn").alias("thread_root"), F.coalesce("depth", F.lit(0)).cast("long").alias("thread_depth"),
    ).orderBy("conv_id", "thread_root", "turn")
