"""Vector links, shingle joins and decontamination against brute force."""

import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from gridloom.llm import decontaminate, embedding_dedup, jaccard_join
from gridloom.llm.embedding_dedup import link_vectors
from gridloom.llm.graph import components
from gridloom.llm.storage import scratch
from gridloom.llm.words import shingle_hashes, word_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(n, edges):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    take = min(width, len(words))
    return {tuple(words[i : i + take]) for i in range(len(words) - take + 1)} if words else set()


def test_words_are_those_of_the_pattern():
    texts = ["", None, " A b\tÉ\x0bc ", "x" * 5000, "ÀÉ Z\x00q  é"]
    for t in texts:
        want = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        got = word_hashes(t)
        assert len(got) == len(want)
        assert len(set(got.tolist())) == len(set(want))
        assert len(shingle_hashes(t, 3)) == len(shingles(t, 3))


def test_sketches_bound_the_symmetric_difference():
    rng = np.random.default_rng(3)
    for similarity in (Fraction(9, 10), Fraction(4, 5)):
        lows, blocks = jaccard_join.size_bands(similarity, 5000)
        for _ in range(200):
            a = np.unique(rng.integers(0, 2**63, int(rng.integers(12, 600)), dtype=np.uint64))
            b = np.unique(np.concatenate((a[: int(a.size * rng.uniform(0.8, 1))], rng.integers(0, 2**63, int(rng.integers(0, 9)), dtype=np.uint64))))
            band = int(np.searchsorted(lows, max(a.size, b.size), side="right")) - 1
            x, y = (jaccard_join.sketch(s, band, int(blocks[band])) for s in (a, b))
            apart = np.setxor1d(a, b).size
            assert np.bitwise_count(x ^ y).sum() <= apart
            both = np.intersect1d(a, b).size
            if both * similarity.denominator >= similarity.numerator * (a.size + b.size - both) and apart:
                assert (x == y).any()


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocabulary = ["w%d" % i for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    texts = [None, "", "   \n", "one", "One", "one two", "a a a a", "a a a a a"]
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((12, 60, 150)))] + passage
        for _ in range(rng.choice((1, 2, 5))):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 3))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    # one group of many near copies
    base = [rng.choice(vocabulary) for _ in range(80)]
    for _ in range(90):
        copy = list(base)
        for _ in range(rng.choice((1, 2))):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(6000))] * 2
    return texts


@pytest.mark.parametrize("width,similarity", [(3, Fraction(9, 10)), (5, Fraction(4, 5))])
def test_jaccard_components(spark, corpus, width, similarity):
    rows = [(i * 3, t, "x", 1) for i, t in enumerate(corpus)]
    df = spark.createDataFrame([*rows, (None, "no id", "x", 1), rows[9]], "doc_id long, text string, set_id string, n_shingles int").repartition(5)
    got = jaccard_join.jaccard_components(df, width, similarity).collect()
    sets = [shingles(t, width) for t in corpus]
    edges = []
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and both * similarity.denominator >= similarity.numerator * (len(a) + len(sets[j]) - both):
                edges.append((i, j))
    want = roots(len(sets), edges)
    assert len(got) == len(rows) + 2
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id is None] == [(1, None)]
    for r in got:
        if r.doc_id is None:
            continue
        assert r.n_shingles == len(sets[r.doc_id // 3])
        assert r.component_id == 3 * want[r.doc_id // 3]


def test_jaccard_of_hot_keys_in_blocks(spark, monkeypatch):
    """Hot keys, the count of their pairs and the comparison in blocks give what all pairs give."""
    rng = random.Random(8)
    vocabulary = ["w%d" % i for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = [" ".join(passage + [rng.choice(vocabulary) for _ in range(rng.choice((3, 6, 9, 12, 20, 60)))]) for _ in range(70)]
    sets = [shingles(t, 3) for t in texts]
    want = roots(len(texts), [(i, j) for i, a in enumerate(sets) for j in range(i) if 10 * len(a & sets[j]) >= 9 * len(a | sets[j])])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for many in (0, 1 << 30):
        monkeypatch.setattr(jaccard_join, "_HOT", 2)
        monkeypatch.setattr(jaccard_join, "_BLOCK", 16)
        monkeypatch.setattr(jaccard_join, "_MANY_PAIRS", many)
        got = jaccard_join.jaccard_components(df, 3, Fraction(9, 10)).collect()
        assert {r.doc_id: r.component_id for r in got} == dict(enumerate(want))


def test_pairs_of_a_shared_passage_are_dropped_unwritten(spark):
    """A key of sets that are far apart gives no pair, however few keys it asks for."""
    cold = spark.createDataFrame([(1, s, False, s) for s in (1, 2, 3)], "key long, set_id long, later boolean, root long")
    short = {1: (7, 0, 0, 0), 2: (3, 0, 0, 0), 3: (-1, -1, -1, -1)}
    sets = spark.createDataFrame([(s, False, 100, 2, 0, 0, *f) for s, f in short.items()], "set_id long, later boolean, n_shingles long, band int, spare int, hot long, f0 long, f1 long, f2 long, f3 long")
    with scratch(spark, "pairs") as keep:
        got = jaccard_join._pairs_with_enough(cold, sets, Fraction(4, 5), keep).collect()
    assert [(r.u, r.v) for r in got] == [(1, 2)]


def test_sketching_holds_few_sets_at_once(spark, monkeypatch):
    """Long batches of texts are worked off in short ones, with the same rows."""
    monkeypatch.setattr(jaccard_join, "_ROWS_AT_ONCE", 7)
    batch = pa.RecordBatch.from_arrays([pa.array(range(20))], ["doc_id"])
    parts = list(jaccard_join._in_parts(iter([batch, batch.slice(0, 0)])))
    assert [p.num_rows for p in parts] == [7, 7, 6]
    assert [x for p in parts for x in p.column("doc_id").to_pylist()] == list(range(20))


def test_jaccard_of_an_empty_table(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3)] + [(205, 201), (203, 205)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(41)} == {0}
    assert {got[100 + k] for k in range(30)} == {100}
    assert got[203] == got[205] == 201


def test_vector_links(spark):
    rng = np.random.default_rng(2)
    rows, vectors = [], []
    for group in range(30):
        base = rng.normal(size=16)
        for _ in range(int(rng.choice((1, 3, 40)))):
            vectors.append(base + rng.normal(size=16) * rng.choice((0.0, 0.05, 0.3)))
    rows = [(i, [float(x) for x in v], int(i % 7 == 0)) for i, v in enumerate(vectors)]
    n = len(rows)
    odd = [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] * 16, 0), (n + 3, [None] * 16, 0), (n + 4, rows[0][1], None), (n + 5, [1.0, 2.0], 0), (n + 6, [], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r.vec_id: r for r in link_vectors(df, cell_rows=16).collect()}
    assert len(got) == n + len(odd)
    x = np.array(vectors)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    links = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(links, False)
    want = roots(n, [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(links)))])
    assert [got[i].n_links for i in range(n)] == links.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(n)] == want
    for i in range(n, n + len(odd)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_codebooks_follow_the_largest_label(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(800, 8))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(800 + i, v.tolist(), 1 + i) for i, v in enumerate(rng.normal(size=(800, 8)))]
    sizes, fit = [], embedding_dedup._kmeans
    monkeypatch.setattr(embedding_dedup, "_kmeans", lambda half, k, rng: sizes.append(k) or fit(half, k, rng))
    got = {r.vec_id: r.n_links for r in link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), cell_rows=8).collect()}
    assert sizes == [10, 10]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert [got[i] for i in range(800)] == ((x @ x.T >= 0.93).sum(axis=1) - 1).tolist() and not any(got[i] for i in range(800, 1600))


def test_vector_links_of_an_empty_table(spark):
    assert link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def brute_tiles(a, b, least):
    """Greedy string tiling, longest match first, by trying all places."""
    used_a, used_b, tiles = [False] * len(a), [False] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not used_a[i + k] and not used_b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return tiles
        k, i, j = best
        tiles.append(k)
        used_a[i : i + k] = [True] * k
        used_b[j : j + k] = [True] * k


def test_tiling_is_greedy_and_blind_to_order():
    rng = random.Random(9)
    for _ in range(60):
        item = [rng.choice("abcdefgh") * 2 for _ in range(rng.randint(5, 25))]
        cut = rng.randint(0, len(item))
        doc = [rng.choice("abcdefgh") * 2 for _ in range(10)] + item[cut:] + ["zz"] + item[:cut]
        block = decontaminate.Benchmark([(7, " ".join(item))], 5)
        got = list(block.hits(" ".join(doc)))
        want = brute_tiles(item, doc, 5)
        assert sum(want) == (round(got[0][1] * len(item)) if got else 0)


def test_decontamination(spark):
    item = " ".join(f"t{i}" for i in range(40))
    turned = " ".join(f"t{i}" for i in [*range(20, 40), *range(20)])
    docs = [(1, f"Before, {item.upper()}! after", "en"), (2, turned, "en"), (3, " ".join(f"t{i}" for i in range(12)), "en"), (4, None, None), (5, "", "en"), (None, item, "en"), (6, "clean words " * 3000, "en"), (6, "clean words " * 3000, "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(10, item), (11, None), (12, "too short"), (None, "x"), (13, "other words that no document holds at all")], "item_id long, text string")
    hits = decontaminate.benchmark_hits(df, bench, block_mb=1).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in hits) == [(0, 10), (1, 10), (2, 10)]
    assert all(r.coverage == 1.0 for r in hits)
    kept = decontaminate.drop_contaminated(df, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 6] and kept.columns == df.columns
    assert decontaminate.benchmark_hits(df, bench.limit(0)).count() == 0
    assert decontaminate.benchmark_hits(df.limit(0), bench).count() == 0


def test_decontamination_of_short_unspaced_and_long_items(spark):
    long = " ".join(f"w{i}" for i in range(450))
    question = "地球の直径はおよそ何キロメートルですか？"
    items = [(1, "Who wrote Hamlet?"), (2, question), (3, long), (4, "今何時"), (5, "?!")]
    docs = [
        (1, "Quiz: who wrote Hamlet? Answer below"), (2, "Hamlet, who wrote it"), (3, f"問題。「{question}」答え"), (4, " ".join(f"w{i}" for i in range(100, 220))),
        (5, " ".join(f"w{i}" for i in range(100, 120))), (6, "“Who wrote—Hamlet”"), (7, "今何時ですか"), (8, "?! 今、何を時"), (9, None),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    hits = {(r.doc_id, r.item_id): r for r in decontaminate.benchmark_hits(df, bench).collect()}
    assert sorted(hits) == [(1, 1), (3, 2), (4, 3), (6, 1), (7, 4)]
    assert hits[4, 3].coverage < 0.5 and hits[4, 3].longest_tile == 120
    assert all(hits[k].coverage == 1.0 for k in hits if k != (4, 3))
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(df, bench).collect()) == [2, 5, 8, 9]


def test_traversal_visits_the_cells_within_the_slack_in_order():
    import numpy as np
    from gridloom.llm.embedding_dedup import MultiIndex, _squared

    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = MultiIndex(x, 12, 0.93, 0.999)
    assert (np.diff(index.slack) >= 0).all() and (index.reach(np.array([0.0, index.theta])) == index.slack[[0, -1]]).all()
    some = x[:50]
    slack = rng.uniform(0, 0.5, len(some))
    rows, cells = index.traversal(some, slack)
    a, b = (_squared(h, book) for h, book in zip(index._halves(some), index.books))
    score = (a[:, :, None] + b[:, None, :]).reshape(len(some), -1)
    for r in range(len(some)):
        seen = cells[rows == r]
        assert (np.diff(score[r, seen]) >= -1e-9).all()
        assert set(seen) == set(np.flatnonzero(score[r] <= score[r].min() + slack[r] + 1e-12))


def test_a_passage_of_many_sets_is_no_key():
    """Sets that link share one of their rarest shingles; those of a common passage are not among them."""
    rng = np.random.default_rng(12)
    similarity = Fraction(4, 5)
    passage = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate((passage, rng.integers(0, 2**63, int(n), dtype=np.uint64)))) for n in rng.integers(40, 200, 300)]
    pairs = [(s, np.unique(np.concatenate((s[: int(s.size * rng.uniform(0.82, 1))], rng.integers(0, 2**63, int(rng.integers(0, 9)), dtype=np.uint64))))) for s in sets]
    counts = np.zeros(1 << 16, dtype=np.uint16)
    for s in [*sets, *[b for _, b in pairs]]:
        np.add.at(counts, jaccard_join._slots(s, counts.size), 1)
    linked = 0
    for a, b in pairs:
        both = np.intersect1d(a, b).size
        x, y = (jaccard_join.rarest(s, counts, similarity) for s in (a, b))
        if 5 * both >= 4 * (a.size + b.size - both):
            linked += 1
            assert np.intersect1d(x, y).size
    common = set(passage.astype(np.uint32).view(np.int32).tolist())
    assert linked > 100 and not any(common & set(jaccard_join.rarest(s, counts, similarity).tolist()) for s in sets)


def test_keys_of_passages_are_not_joined(spark, monkeypatch):
    """Documents with texts of their own around common passages share no key, so no row is kept for pairs."""
    rng = random.Random(3)
    passages = [" ".join("p%dx%d" % (k, i) for i in range(60)) for k in range(6)]
    texts = [" ".join([*rng.sample(passages, 2), *("d%dx%d" % (n, i) for i in range(90))]) for n in range(120)]
    seen = []
    real = jaccard_join._pairs_with_enough
    monkeypatch.setattr(jaccard_join, "_pairs_with_enough", lambda cold, *rest: seen.append(cold.count()) or real(cold, *rest))
    monkeypatch.setattr(jaccard_join, "_HOT", 1 << 20)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = jaccard_join.jaccard_components(df, 5, Fraction(4, 5)).collect()
    assert {r.doc_id: r.component_id for r in got} == {n: n for n in range(120)}
    assert seen == [0]
