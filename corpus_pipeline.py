"""From raw documents to packed training sequences: five stages, each on all that the last one kept."""

from __future__ import annotations

from fractions import Fraction

from gridloom.llm.decontaminate import drop_contaminated
from gridloom.llm.jaccard_join import jaccard_components
from gridloom.llm.langid import UNKNOWN, identify
from gridloom.llm.langid import train as train_languages
from gridloom.llm.packing import pack_documents
from gridloom.llm.quality import score_quality
from gridloom.llm.quality import train as train_quality
from gridloom.llm.queries import table, tokenizer_path
from gridloom.llm.storage import materialize, new_folder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A text whose best cosine is below this is in none of the learned languages.
LEAST_LANGUAGE_SCORE = 0.1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = train_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).where("accepted").select(docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled documents show."""
    seen = identify(docs, train_languages(docs))
    return seen.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five words, similarity 0.8): the smallest doc_id, null last.

    Rows are compared under a number made of doc_id and text, so a repeated or missing
    doc_id neither drops nor keeps a text; rows that agree in both are one document.
    """
    number = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"))
    named = docs.select(number.alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text", F.lit(1)).alias("_text"))
    groups = jaccard_components(docs.select(number.alias("doc_id"), "text"), width=5, similarity=Fraction(4, 5))
    groups = groups.select(F.col("doc_id").alias("_row"), "component_id").distinct()
    rank = F.struct(F.col("_id").isNull().alias("unnamed"), "_id", "_row")
    kept = groups.join(named.distinct(), "_row").groupBy("component_id").agg(F.min_by("_row", rank).alias("_row")).select("_row")
    rows = docs.withColumns({"_row": number, "_text": F.xxhash64("text", F.lit(1))})
    return rows.join(materialize(kept, "kept"), "_row", "left_semi").dropDuplicates(["_row", "_text"]).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_path(), window=2048, end_id=1)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("deduplicate", deduplicate),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Tokenizers and trained models are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
