"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A letter trigram is the product of
its letters' vectors, each permuted (rolled) by its place; a text is the sum of its
trigrams' vectors; a language is the sum of its texts' unit vectors.  A text takes the
language whose prototype is closest by cosine.  Letters up to U+03FF have vectors of
their own; those above share 1,024 vectors by the remainder of their code point.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
_LETTERS = 2048
_TABLES: dict = {}


def _alphabet() -> np.ndarray:
    """For every code point: its row in the letter memory, 0 for what is no letter."""
    if "alphabet" not in _TABLES:
        rows = np.zeros(0x110000, dtype=np.int64)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = ord(s.lower()[0])
                rows[c] = low if 0 < low < 1024 else 1024 + low % (_LETTERS - 1024)
        _TABLES["alphabet"] = rows
    return _TABLES["alphabet"]


class LetterMemory:
    """Random letter vectors of one width, and the vectors of whole texts."""

    def __init__(self, width: int = 512, seed: int = 11):
        base = np.random.default_rng(seed).integers(0, 2, (_LETTERS, width), dtype=np.int8) * 2 - 1
        self.width = width
        self.rolled = [np.roll(base, k, axis=1) for k in (2, 1, 0)]

    def text_vector(self, text: str | None) -> np.ndarray | None:
        """Unit vector of a text; None where it has no letter."""
        codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4")
        rows = _alphabet()[codes]
        if not rows.any():
            return None
        # words are parted by one place of row 0
        keep = np.ones(rows.size, dtype=bool)
        keep[1:] = (rows[1:] != 0) | (rows[:-1] != 0)
        rows = np.concatenate(([0], rows[keep], [0]))
        rows = rows[int(rows[1] == 0) : rows.size - int(rows[-2] == 0)]
        grams, counts = np.unique(rows[:-2] << 22 | rows[1:-1] << 11 | rows[2:], return_counts=True)
        total = np.zeros(self.width, dtype=np.float32)
        a, b, c = self.rolled
        for k in range(0, grams.size, 4096):
            g = grams[k : k + 4096]
            bound = a[g >> 22] * b[g >> 11 & 2047] * c[g & 2047]
            total += counts[k : k + 4096].astype(np.float32) @ bound.astype(np.float32)
        norm = float(np.sqrt(total @ total))
        return total / norm if norm else total


def memory(width: int) -> LetterMemory:
    if width not in _TABLES:
        _TABLES[width] = LetterMemory(width)
    return _TABLES[width]


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", width: int = 512) -> dict[str, np.ndarray]:
    """Unit prototype of every language, from all rows of ``docs`` that have a text and a language.

    Each task sums its texts; the sums, one row per language and place in the vector,
    are added up by Spark.  What comes to the driver is one vector per language.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        own = memory(width)
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                vector = own.text_vector(text)
                if vector is not None:
                    found.setdefault(lang, np.zeros(width)).__iadd__(vector)
        for lang, total in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * width), pa.array(np.arange(width)), pa.array(total)], ["lang", "place", "value"])

    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    added = rows.mapInArrow(sums, "lang string, place long, value double").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    table = added.toArrow().to_pandas()
    out = {}
    for lang, part in table.groupby("lang"):
        vector = np.zeros(width)
        vector[part["place"].to_numpy()] = part["value"].to_numpy()
        out[str(lang)] = vector / max(float(np.sqrt(vector @ vector)), 1e-12)
    return dict(sorted(out.items()))


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", width: int = 512) -> DataFrame:
    """``docs`` with lang_pred and score, the cosine with the closest prototype, 0 at least.

    Texts that are null or without a letter, and all texts when no language was
    learned, get ``und`` and 0; ties go to the language that sorts first, with score 0
    where the trigrams of a text cancel out; repeated rows are judged again.  Columns
    that already have one of the two names are replaced.  No shuffle.
    """
    names = list(prototypes)
    held = docs.sparkSession.sparkContext.broadcast(np.array([prototypes[n] for n in names]).reshape(len(names), width))

    @F.pandas_udf("lang_pred string, score double")
    def guess(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own, table = memory(width), held.value
        for part in parts:
            langs, scores = [], []
            for text in part:
                vector = own.text_vector(text) if names else None
                if vector is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosine = table @ vector
                best = int(cosine.argmax())
                langs.append(names[best])
                scores.append(min(1.0, max(0.0, float(cosine[best]))))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.withColumn("_guess", guess(F.col(text_col))).select(*kept, "_guess.lang_pred", "_guess.score")
