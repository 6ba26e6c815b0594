"""Quality of documents by hierarchical empirical Bayes.

A logistic classifier of a document's shape gives evidence from its text alone.  Its
probabilities are averaged by site (``host_col``) and by section of a site
(``path_col``); the averages are shrunk, sections towards their site and sites
towards the corpus, by prior strengths that are estimated from the spread between
the groups (method of moments).  A document's odds are its evidence times the odds of
its section against those of the corpus, its own evidence left out of the section.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.storage import materialize
from gridloom.llm.words import word_hashes

#: Up to so many sections are joined as a broadcast table (about 100 bytes each).
_BROADCAST_SECTIONS = 100_000
N_FEATURES = 12


def features(text: str | None) -> np.ndarray:
    """Shape of a whole text: shares of kinds of characters, words and repeats."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    words = word_hashes(text)
    n, size = max(words.size, 1), max(raw.size, 1)
    count = np.bincount(raw, minlength=256)
    letters = count[65:91].sum() + count[97:123].sum()
    lines = text.split("\n")
    distinct = np.unique(words)
    odd = count[list(b"#$%&*+<=>@\\^_`{|}~")].sum()
    return np.array(
        [
            min(odd / n, 2.0),
            min(count[ord("|")] / n, 1.0),
            min(count[ord("!")] / n, 2.0),
            count[65:91].sum() / max(letters, 1),
            count[48:58].sum() / size,
            (words[1:] == words[:-1]).mean() if words.size > 1 else 0.0,
            1 - distinct.size / n if n < 50 else (1 - distinct.size / n) * min(1.0, 200 / n),
            1 - len(set(lines)) / len(lines),
            np.log1p(words.size) / 10,
            min(size / n, 40) / 40,
            letters / size,
            float(words.size == 0),
        ]
    )


class ShapeClassifier:
    """Logistic regression on standardised features, fitted by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.mean = x.mean(0) if len(x) else np.zeros(N_FEATURES)
        self.scale = np.where(x.std(0) > 1e-9, x.std(0), 1.0) if len(x) else np.ones(N_FEATURES)
        self.base = float((y.sum() + 1) / (len(y) + 2))
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))]) if len(x) else np.zeros((0, N_FEATURES + 1))
        w = np.zeros(N_FEATURES + 1)
        w[-1] = np.log(self.base / (1 - self.base))
        penalty = np.full(N_FEATURES + 1, ridge)
        penalty[-1] = 1e-6
        for _ in range(40 if len(x) else 0):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            gradient = z.T @ (p - y) + penalty * w - np.append(np.zeros(N_FEATURES), penalty[-1] * w[-1])
            step = np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty), gradient)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return 1 / (1 + np.exp(-np.clip(z @ self.weights[:-1] + self.weights[-1], -15, 15)))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> ShapeClassifier:
    """Fit on at most ``sample_rows`` labelled documents, those with the smallest hashes.

    Labels that are null, and labels without a document, do not count.
    """
    ids = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    shaped = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")

    def shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield pd.DataFrame({"doc_id": part["doc_id"], "quality": part["quality"].astype(float), "x": [features(t).tolist() for t in part["text"]]})

    found = shaped.select("doc_id", "quality", "text").mapInPandas(shapes, "doc_id long, quality double, x array<double>").toPandas()
    found = found.sort_values("doc_id")
    x = np.array(found["x"].tolist()).reshape(-1, N_FEATURES)
    return ShapeClassifier(x, (found["quality"].to_numpy(dtype=float) > 0).astype(float))


def text_evidence(docs: DataFrame, model: ShapeClassifier, out: str = "p_text", text_col: str = "text") -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def evidence(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            x = np.array([features(t) for t in part]).reshape(-1, N_FEATURES)
            yield pd.Series(held.value.probability(x))

    return docs.withColumn(out, evidence(F.col(text_col)))


def _strength(groups: DataFrame, mean: str, centre: str) -> float:
    """Prior strength of groups (n, mean) around their centre, by the method of moments."""
    c = F.col(centre)
    row = groups.agg(
        F.sum(F.col("n") * F.pow(F.col(mean) - c, 2)).alias("spread"),
        F.sum("within").alias("within"),
        F.sum("n").alias("n"),
        F.count("*").alias("groups"),
    ).first()
    if not row.n or row.groups < 2:
        return 10.0
    # variance of the means, less what the documents inside a group explain
    noise = row.within / row.n
    between = max((row.spread - row.groups * noise) / row.n, 1e-6)
    return float(min(max(noise / between, 1.0), 1e6))


def section_posteriors(scored: DataFrame, host_col: str, path_col: str) -> tuple[DataFrame, float]:
    """(host, path, n, total, k_path, host_mean) of every section, and the mean of the corpus.

    Grouped sums with partial aggregation only; a hot site costs one row per task.
    """
    base = scored.select(F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"), "p_text")
    paths = base.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p_text").alias("total"), F.sum(F.col("p_text") * F.col("p_text")).alias("squares"))
    paths = materialize(paths, "sections")
    all_ = paths.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    prior = (all_.total + 1.0) / (all_.n + 2.0) if all_.n else 0.5

    def spread(df: DataFrame) -> DataFrame:
        return df.withColumn("mean", F.col("total") / F.col("n")).withColumn("within", F.col("squares") - F.col("total") * F.col("total") / F.col("n"))

    hosts = spread(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"))).withColumn("centre", F.lit(prior))
    hosts = materialize(hosts, "hosts")
    k_host = _strength(hosts, "mean", "centre")
    means = hosts.select(F.col("host").alias("h"), ((F.col("total") + F.lit(k_host * prior)) / (F.col("n") + F.lit(k_host))).alias("host_mean"))
    joined = spread(paths).join(means, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    joined = materialize(joined, "joined")
    k_path = _strength(joined, "mean", "host_mean")
    return joined.select("host", "path", "n", "total", F.lit(k_path).alias("k_path"), "host_mean"), prior


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def score_quality(docs: DataFrame, model: ShapeClassifier, host_col: str = "source", path_col: str = "lang", accept: float = 0.5, keep_text: bool = True) -> DataFrame:
    """``docs`` with p_text, host_mean, path_mean, p_quality and accepted.

    Null hosts and paths are sites and sections of their own; null, empty and wordless
    texts have the evidence of their shape; repeated rows are scored again; an empty
    table gives an empty result.  Columns that already have one of these names are
    replaced.  Every text is read once: its evidence is written beside the columns of
    ``docs``, without the text unless ``keep_text``.
    """
    added = ("p_text", "host_mean", "path_mean", "p_quality", "accepted")
    docs = docs.select([c for c in docs.columns if c not in added])
    known = text_evidence(docs, model)
    known = materialize(known if keep_text else known.drop("text"), "evidence")
    sections, prior = section_posteriors(known, host_col, path_col)
    sections = sections.toDF("_host", "_path", "_n", "_total", "_k", "host_mean")
    if sections.count() <= _BROADCAST_SECTIONS:
        sections = F.broadcast(sections)
    on = F.col(host_col).cast("string").eqNullSafe(F.col("_host")) & F.col(path_col).cast("string").eqNullSafe(F.col("_path"))
    scored = known.join(sections, on)
    path_mean = (F.col("_total") - F.col("p_text") + F.col("_k") * F.col("host_mean")) / (F.col("_n") - 1 + F.col("_k"))
    odds = _logit(F.col("p_text")) + _logit(F.col("path_mean")) - _logit(F.lit(prior))
    return (
        scored.withColumn("path_mean", path_mean)
        .withColumn("p_quality", 1 / (1 + F.exp(-odds)))
        .withColumn("accepted", F.col("p_quality") >= accept)
        .drop("_host", "_path", "_n", "_total", "_k")
    )
