"""Collocations against counts in plain Python and against SQL; summaries against exact counts."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from gridloom.llm import collocations as co
from gridloom.llm.queries import ORACLE_SQL, op11_collocations
from hypothesis import given, settings
from hypothesis import strategies as st

SCHEMA = "doc_id long, text string, lang string, phrase string, a int"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, longest=3, least=10, top=2000):
    counts, words = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i : i + k])] += 1
    candidates = {k: f for k, f in counts.items() if len(k[1]) > 1 and f >= least}
    longer = Counter()
    for (lang, w), f in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longer[lang, w[i : i + k]] = max(longer[lang, w[i : i + k]], f)
    out = []
    for lang in words:
        ranked = []
        for (own, w), a in candidates.items():
            if own == lang and not (longer[lang, w] and 100 * longer[lang, w] >= 50 * a):
                cuts = [(10**6 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
                score, k = min(cuts)
                ranked.append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, words[lang], -score))
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r[c] for c in COLUMNS) for r in co.mine_collocations(df, **options).collect())


def made():
    rng = np.random.default_rng(4)
    vocabulary = ["the", "New", "york", "city", "Ünder", "a", "of", "état", "x y", "中文", "naïve\x1c"]
    marks = [" ", "  ", "\t", ", ", ".\n", " ; ", "\r\n", "?!", "\x0b"]
    rows = []
    for i in range(120):
        words = rng.choice(vocabulary, 60, p=[0.3, 0.1, 0.1, 0.1, *[0.4 / 7] * 7])
        parts = rng.choice(marks, 60, p=[0.7, 0.1, 0.05, *[0.15 / 6] * 6])
        rows.append((i, "".join(w + m for w, m in zip(words, parts)), ["en", "de", None][i % 3], "z", 1))
    rows += [(500, None, "fr", "z", 1), (501, "", None, "z", 1), (502, " \t.\n", "fr", "z", 1), (503, "one two " * 9, "es", None, None)]
    rows += [(504, "one two " * 3000, "es", None, None)] + rows[:7]
    return rows


@pytest.mark.parametrize("most_keys", [4_000_000, 3])
@pytest.mark.parametrize("longest", [3, 4])
def test_equals_plain_counts(spark, most_keys, longest):
    assert mined(spark, made(), most_keys=most_keys, longest=longest) == brute(made(), longest=longest)


def test_small_runs_partitions_and_top(spark, monkeypatch):
    # settings of the driver reach the tasks in the closures that use them
    monkeypatch.setattr(co, "_MASS", 300)
    assert mined(spark, made(), top=5, least=4) == brute(made(), top=5, least=4)


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, None, None, None, None), (2, " ", "en", None, None)]) == []


def test_a_text_over_several_runs_and_chunks(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(co, "_CHUNK", 64)
    texts = pa.array([t or "" for _, t, *_ in made()[:40]])
    run = co.Run(texts, np.zeros(40, dtype=np.uint64), second=True)
    for size, at, found in run.grams(3):
        got = Counter(run.phrases(at, size).to_pylist())
        want = Counter()
        for t in texts.to_pylist():
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m.group().lower(), t)):
                w = re.findall(r"[^\x20\x09]+", piece)
                want.update(" ".join(w[i : i + size]) for i in range(len(w) - size + 1))
        assert got == want and len(np.unique(found)) == len(want)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), max_size=30), max_size=6), st.integers(2, 12))
def test_summaries_keep_what_is_frequent(parts, least):
    exact = Counter()
    for part in parts:
        for key, n in part:
            exact[key] += n
    summary = co.Summary(sum(exact.values()) // least + 1)
    for part in parts:
        summary.merge(np.array([k for k, _ in part], dtype=np.uint64), np.array([n for _, n in part], dtype=np.int64))
    assert summary.keys.size <= summary.capacity and summary.lost < least
    assert {k for k, n in exact.items() if n >= least} <= set(summary.reaching(least).tolist())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/{sf}/documents.parquet'")
    want = con.execute(ORACLE_SQL["op11_collocations"])
    names = [d[0] for d in want.description]
    got = op11_collocations(spark, f"/root/testdata/{sf}")
    assert got.columns == names == COLUMNS
    found = want.fetchall()
    assert len(found) > 100 and sorted(map(tuple, got.collect())) == sorted(found)


def test_more_keys_than_are_sent_are_filtered_before_the_shuffle(spark, monkeypatch):
    rows = made() + [(1000 + i, " ".join(f"w{i}x{k}" for k in range(200)), "en", "z", 1) for i in range(60)]
    seen = []
    real = co._counted
    monkeypatch.setattr(co, "_counted", lambda *a: seen.append(real(*a)) or seen[-1])
    assert mined(spark, rows, most_keys=3) == mined(spark, rows) == brute(rows)
    few, sent = (f.where("size > 0").count() for f in seen)
    # 36,000 n-grams of these rows stand once, so few of them may be counted by their words
    assert few < 1.2 * sent + 4000
    assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_only_counts_are_left_behind(spark):
    import os

    from gridloom.llm.storage import shared_folder

    def names():
        folder = shared_folder(spark).replace("file:", "", 1)
        return {f"{top}/{f}" for top in os.listdir(folder) for f in os.listdir(f"{folder}/{top}")}

    before = names()
    co.frequent_ngrams(spark.createDataFrame(made(), SCHEMA))
    assert {n.split("/")[0].rsplit("-", 1)[0] for n in names() - before} == {"gridloom-phrases-counts"}
