"""Token counts by rank-synchronous array merging."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MERGERS: dict = {}


def _merger(path: str):
    """The merger of this worker, with its cache, for a tokenizer file."""
    from gridloom.llm.bpe import ArrayMerger

    if path not in _MERGERS:
        _MERGERS[path] = ArrayMerger(path)
    return _MERGERS[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, text_col: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit of every whole text.

    Null and empty texts have 0 bytes and tokens; repeated rows are counted one
    by one; other columns are kept, and columns that already have one of the
    three names are replaced.  The scan is the only stage: no shuffle.
    """

    @F.arrow_udf("long")
    def tokens(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merger = _merger(tokenizer)
        for part in parts:
            yield pa.array(merger.count(part))

    text = F.coalesce(F.col(text_col), F.lit(""))
    return (
        docs.withColumn("n_bytes", F.octet_length(text).cast("long"))
        .withColumn("n_tokens", tokens(text))
        .withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
    )
