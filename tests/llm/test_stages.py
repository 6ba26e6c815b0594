"""Every stage of the corpus pipeline on an empty table and on odd rows."""

from collections import Counter

import corpus_pipeline
import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ", p_text double, score double, row long, piece int, component_id long, lang_pred string, accepted boolean, coverage double"
STAGES = dict(corpus_pipeline.STAGES)


def plain(spark, n=60):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(n).collect()
    return [(d.doc_id, d.text, d.lang, d.source, d.n_chars) for d in docs]


def odd(rows):
    return [
        *rows,
        rows[0],
        (None, rows[1][1], "en", None, None),
        (900, None, None, None, None),
        (901, "", "en", "x", 0),
        (902, " \n\t", None, "x", 3),
        (903, "12345 !!! 67", "en", "x", 12),
        (904, rows[2][1], None, None, None),
        (904, rows[3][1], "fr", "x", 7),
        (905, "word " * 60_000, "en", "x", 300_000),
    ]


def frame(spark, rows, clashing=False):
    extra = (0.1, 0.2, 3, 4, 5, "zz", False, 0.9) if clashing else ()
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA + (CLASHING if clashing else "")).repartition(3)


@pytest.mark.parametrize("name", STAGES)
def test_empty_table(spark, name):
    out = STAGES[name](spark, frame(spark, []), SF)
    assert out.count() == 0 and (name == "pack" or out.columns == [c.split()[0] for c in SCHEMA.split(", ")])


@pytest.mark.parametrize("name", [n for n in STAGES if n != "pack"])
def test_odd_rows(spark, name):
    rows = odd(plain(spark))
    docs = frame(spark, rows, clashing=True)
    out = STAGES[name](spark, docs, SF)
    assert out.columns == docs.columns
    kept = Counter(tuple(r)[:5] for r in out.collect())
    given = Counter(rows)
    assert all(n <= given[r] for r, n in kept.items()) and sum(kept.values()) >= 30
    ids = {r[0] for r in kept}
    if name == "language":
        assert not ids & {900, 901, 902, 903}
    if name == "deduplicate":
        # one of the row, its repetition and its nameless copy
        assert sum(n for r, n in kept.items() if r[1] == rows[1][1]) == 1 and kept[rows[0]] == 1 and 900 in ids


def test_packing_odd_rows(spark):
    rows = odd(plain(spark, 20))
    pieces = STAGES["pack"](spark, frame(spark, rows, clashing=True), SF).collect()
    assert Counter(r.doc_id for r in pieces if r.start == 0) == Counter(r[0] for r in rows)
    assert all(r.length == 1 and r.doc_tokens == 1 for r in pieces if r.doc_id in (900, 901))
