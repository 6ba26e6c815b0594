"""Whole methods of the quotation, quality and language operators against plain Python, and SQL against the queries."""

import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import regex
from gridloom.llm import langid, quality, quotations
from gridloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def quoted_line(line):
    marks = regex.match(r"((?:[ \t]*>)+)[ \t]?", line)
    return (marks.group(1).count(">"), line[marks.end() :]) if marks else (0, line)


def plain(text):
    return regex.sub(r"[\s\p{P}\p{S}]+", " ", text.lower()).strip(" ")


def brute_passages(text, quoted):
    """(level, passage) with the number of its parts, by lines, runs, sentences and six-word shingles."""
    lines = [quoted_line(x) for x in regex.split("\r?\n", text)]
    runs = []
    for level, body in lines:
        if runs and runs[-1][0] == level:
            runs[-1][1] += " " + body
        else:
            runs.append([level, body])
    found = set()
    for level, body in runs:
        if (level > 0) == quoted:
            words = plain(body).split(" ")
            found |= {(level, " ".join(words[i : i + 6]), 1) for i in range(len(words) - 5)}
            parts = [body, *regex.split(r"(?<=[.!?])\p{P}*\s+", body)]
            found |= {(level, plain(x), max(1, len(plain(x).split(" ")) - 5)) for x in parts}
    for level, body in lines:
        if (level > 0) == quoted:
            found.add((level, plain(body), max(1, len(plain(body).split(" ")) - 5)))
    return {f for f in found if f[1]}


def brute_replies(rows):
    first, asked = {}, defaultdict(set)
    for conv, turn, text in rows:
        for _, passage, _ in brute_passages(text or "", False):
            first[conv, passage] = min(turn, first.get((conv, passage), turn))
        asked[conv, turn] |= brute_passages(text or "", True)
    out = {}
    for (conv, turn), passages in asked.items():
        votes = Counter()
        for level, passage, n in passages:
            source = first.get((conv, passage), turn)
            if source < turn:
                votes[level, source] += n
        out[conv, turn] = max(votes.items(), key=lambda v: (-v[0][0], v[1], v[0][1]))[0][1] if votes else None
    return out


def test_quotations_against_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for conv in range(12):
        written = []
        for turn in range(14):
            lines = []
            for _ in range(rng.randint(0, 3) if written else 0):
                level = rng.choice((1, 1, 2))
                source = rng.choice(written).split("\n")
                part = source if rng.random() < 0.3 else [rng.choice(source)]
                part = [p[: rng.randint(10, 60)] if rng.random() < 0.3 else p for p in part]
                lines += ["> " * level + p.lstrip("> ") for p in part]
            for _ in range(rng.randint(1, 3)):
                # lines come again, so that the first of several writers and equal votes matter
                old = rng.choice(written).split("\n")[-1] if written and rng.random() < 0.2 else None
                lines.append(old or ". ".join(" ".join(rng.choice(words) for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(1, 3))) + rng.choice(("", "?", "!")))
            written.append("\n".join(lines))
            rows.append((conv, turn, written[-1]))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string").selectExpr("conv_id", "turn", "'u' AS role", "text", "1 AS reply_to", "2 AS level")
    got = quotations.link_quotations(df).collect()
    want = brute_replies(rows)
    assert len(got) == len(rows) and sum(v is not None for v in want.values()) > 50
    for r in got:
        assert r.reply_to == want[r.conv_id, r.turn]
        root, depth = r.turn, 0
        while want[r.conv_id, root] is not None:
            root, depth = want[r.conv_id, root], depth + 1
        assert (r.thread_root, r.thread_depth) == (root, depth)


def test_quotations_of_many_lines(spark):
    body = "\n".join(f"> line number {i} of a long message\nanswer {i}" for i in range(10_000))
    source = "\n".join(f"line number {i} of a long message" for i in range(10_000))
    df = spark.createDataFrame([(1, 0, "u", source), (1, 1, "u", body)], "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in quotations.link_quotations(df).collect()}
    assert got[1].reply_to == 0 and got[1].quoted_lines == 10_000 and got[1].text.count("\n") == 9_999


def brute_quality(rows, model):
    """p_quality of rows (text, host, path) from sums over all rows."""
    p = [float(model.probability(quality.features(t)[None])[0]) for t, _, _ in rows]

    def strength(groups, centre):
        n = sum(len(g) for g in groups.values())
        if not n or len(groups) < 2:
            return 10.0
        noise = sum(sum((x - sum(g) / len(g)) ** 2 for x in g) for g in groups.values()) / n
        spread = sum(len(g) * (sum(g) / len(g) - centre(k)) ** 2 for k, g in groups.items())
        return min(max(noise / max((spread - len(groups) * noise) / n, 1e-6), 1.0), 1e6)

    hosts, paths = defaultdict(list), defaultdict(list)
    for x, (_, host, path) in zip(p, rows):
        hosts[host].append(x)
        paths[host, path].append(x)
    prior = (sum(p) + 1) / (len(p) + 2)
    k_host = strength(hosts, lambda k: prior)
    mean = {h: (sum(g) + k_host * prior) / (len(g) + k_host) for h, g in hosts.items()}
    k_path = strength(paths, lambda k: mean[k[0]])

    def logit(x):
        x = min(max(x, 1e-6), 1 - 1e-6)
        return math.log(x / (1 - x))

    out = []
    for x, (_, host, path) in zip(p, rows):
        g = paths[host, path]
        rest = (sum(g) - x + k_path * mean[host]) / (len(g) - 1 + k_path)
        out.append(1 / (1 + math.exp(-(logit(x) + logit(rest) - logit(prior)))))
    return out


@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_quality_against_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(quality, "_BROADCAST_SECTIONS", broadcast)
    rng = random.Random(6)
    clean, bad = "plain words of a calm report on rivers ", "BUY || now!!! $$$ 99 || "
    rows = []
    for i in range(300):
        host = rng.choice(("a", "a", "a", "b", "c", None))
        text = "".join(rng.choice((clean, clean, bad) if host != "b" else (bad, clean)) for _ in range(rng.randint(1, 12)))
        rows.append((rng.choice((text, text, text, None, "")), host, rng.choice(("x", "y", None))))
    rows.append((clean * 20_000, "long", "x"))
    rows += rows[:5]
    x = np.array([quality.features(t) for t in [clean * k for k in range(1, 9)] + [bad * k for k in range(1, 9)]])
    model = quality.ShapeClassifier(x, np.array([1.0] * 8 + [0.0] * 8))
    df = spark.createDataFrame([(i, *r, "kept") for i, r in enumerate(rows)], "doc_id long, text string, source string, lang string, n string").repartition(5)
    want = brute_quality(rows, model)
    got = quality.score_quality(df, model).collect()
    assert len(got) == len(rows) and {r.n for r in got} == {"kept"}
    for r in got:
        assert abs(r.p_quality - want[r.doc_id]) < 1e-9 and r.accepted == (r.p_quality >= 0.5) and r.text == rows[r.doc_id][0]
    narrow = quality.score_quality(df, model, keep_text=False)
    assert "text" not in narrow.columns and narrow.count() == len(rows)


def test_quality_of_one_class_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "some words", "a", "x"), (2, None, "a", "x")], "doc_id long, text string, source string, lang string")
    for rows in ([], [(1, 1)], [(1, None), (None, 1), (7, 1)]):
        model = quality.train(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert all(0 <= r.p_quality <= 1 for r in quality.score_quality(docs, model).collect())


def brute_vector(text, memory):
    rows = [langid._alphabet()[ord(c)] for c in text or ""]
    if not any(rows):
        return None
    # one blank before, between and behind words
    words, word = [], []
    for r in [*rows, 0]:
        if r:
            word.append(r)
        elif word:
            words.append(word)
            word = []
    line = [0]
    for w in words:
        line += [*w, 0]
    total = np.zeros(memory.width)
    for a, b, c in zip(line, line[1:], line[2:]):
        total += memory.rolled[0][a].astype(float) * memory.rolled[1][b] * memory.rolled[2][c]
    norm = np.sqrt(total @ total)
    return total / norm if norm else total


def test_language_against_brute_force(spark):
    rng = random.Random(2)
    letters = {"aa": "abcdefg hi", "bb": "efghijk lm", "cc": "вгдежз ик"}
    rows = [("".join(rng.choice(letters[k]) for _ in range(rng.randint(1, 60))), k) for k in letters for _ in range(30)]
    rows += rows[:10] + [(None, "aa"), ("12 !", "aa"), ("", "bb"), ("abc", None)]
    memory = langid.memory(512)
    sums = defaultdict(lambda: np.zeros(512))
    for text, lang in rows:
        vector = brute_vector(text, memory)
        if vector is not None and lang is not None:
            sums[lang] += vector
    names = sorted(sums)
    table = np.array([sums[n] / np.sqrt(sums[n] @ sums[n]) for n in names])
    made = langid.train(spark.createDataFrame(rows, "text string, lang string").repartition(3))
    assert list(made) == names and np.allclose(np.array(list(made.values())), table, atol=1e-5)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, score string")
    for r in langid.identify(df, made).collect():
        vector = brute_vector(rows[r.doc_id][0], memory)
        if vector is None:
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            cosine = table @ vector
            assert abs(r.score - max(0.0, cosine.max())) < 1e-4 and cosine[names.index(r.lang_pred)] > cosine.max() - 1e-4


def test_language_of_a_text_that_cancels(spark):
    memory = langid.memory(1)
    text = next(t for t in ("ab" * i + "cde"[: i % 4] + "f" * (i % 3) for i in range(1, 400)) if not memory.text_vector(t).any())
    prototypes = langid.train(spark.createDataFrame([("x y", "b"), ("y x", "a")], "text string, lang string"), width=1)
    got = langid.identify(spark.createDataFrame([(text,)], "text string"), prototypes, width=1).first()
    assert (got.lang_pred, got.score) == ("a", 0.0)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_of_the_queries(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = QUERIES[name](spark, SF)
    want = con.sql(ORACLE_SQL[name])
    assert sorted(found.columns) == sorted(want.columns)
    assert sorted(map(tuple, found.select(*want.columns).collect())) == sorted(want.fetchall())
