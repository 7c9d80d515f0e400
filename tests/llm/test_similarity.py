"""The n-gram join, the embedding index and components against brute force."""

import collections
import random
import re

import numpy as np
import pytest

from martkit.llm import embedding_index, ngram_join
from martkit.llm.common import LOWER, UPPER
from martkit.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Groups:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(7, i) for i in range(50)], "none": [],
             "random": [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(120)] + [(5, 5), (900, 900)]}[shape]
    g = Groups()
    for a, b in edges:
        if a != b:
            g.join(a, b)
    got = connected_components(spark.createDataFrame(edges, "x long, y long")).collect()
    assert {r.node: r.component for r in got} == {x: g.root(x) for x in list(g.parent)} and len(got) == len(g.parent)


def shingle_set(text, k):
    words = WORD.findall((text or "").translate(str.maketrans(UPPER, LOWER)))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k, num, den):
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    found = collections.defaultdict(list)
    for at, (_, s) in enumerate(sets):
        for x in s:
            found[x].append(at)
    g = Groups()
    for at, (_, s) in enumerate(sets):
        common = collections.Counter(o for x in s for o in found[x] if o < at)
        for o, c in common.items():
            if den * c >= num * (len(s) + len(sets[o][1]) - c):
                g.join(at, o)
    low = {}
    for at, (i, _) in enumerate(sets):
        r = g.root(at)
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    return [(i, len(s), low[g.root(at)]) for at, (i, s) in enumerate(sets)]


def join_rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]

    def some(n):
        return [rng.choice(vocabulary) for _ in range(n)]
    docs, passage = [], some(60)
    for _ in range(12):
        base = some(rng.choice([3, 5, 8, 20, 60, 150, 400]))
        for _ in range(rng.choice([1, 2, 5, 20, 90])):
            x = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 8])):
                x[rng.randrange(len(x))] = rng.choice(vocabulary)
            docs.append(" ".join(x + (some(rng.randint(1, 6)) if rng.random() < 0.3 else [])))
    docs += [" ".join(some(rng.randint(0, 6)) + passage + some(rng.randint(0, 8))) for _ in range(80)]
    chain = some(100)
    for _ in range(40):
        chain = chain[2:] + some(2)
        docs.append(" ".join(chain))
    docs += ["", " \n ", None, None, "a", "A", "a b", "a  b", "É é", "É É", "x" * 70_000, "x" * 70_000 + " y"]
    rng.shuffle(docs)
    return list(enumerate(docs))


def check_join(spark, rows, k, num, den):
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, component_id string").repartition(5)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, k, num, den).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows, k, num, den), key=key)


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (3, 7, 10)])
def test_join_equals_brute_force(spark, k, num, den):
    check_join(spark, join_rows(), k, num, den)


def test_join_with_hot_shingles_and_split_work(spark, monkeypatch):
    """Small limits reach every path: settled shingles, several chunks and ranges, blocks."""
    for name, value in {"CHUNK_DOCS": 40, "LOCAL_HOT": 64, "SLICE_BYTES": 4_000, "RANGE_SHINGLES": 500,
                        "SMALL_GROUP": 2, "BLOCK": 16}.items():
        monkeypatch.setattr(ngram_join, name, value)
    check_join(spark, join_rows(), 5, 4, 5)


def test_join_settles_hot_shingles_in_their_chunk(spark):
    rng = random.Random(1)
    base = [f"b{i}" for i in range(40)]
    rows = [(i, " ".join(base + [f"u{i}"] * (i % 2) + [f"v{rng.randint(0, 3)}"])) for i in range(300)]
    check_join(spark, rows, 2, 85, 100)


def test_join_edges(spark):
    check_join(spark, [(1, None), (2, ""), (3, " ")], 4, 85, 100)
    check_join(spark, [(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (4, "z"), (4, "q")], 4, 85, 100)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.jaccard_components(empty).collect() == []
    with pytest.raises(ValueError):
        ngram_join.jaccard_components(empty, 5, 1, 2)


def test_one_per_component(spark):
    rows = [(3, "a b c d e f", "x"), (1, "a b c d e f", "y"), (2, "A b c d e f", "z"), (9, None, "n"), (8, "", "e"), (7, "q", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string")
    assert sorted(map(tuple, ngram_join.one_per_component(docs).collect())) == [rows[1], rows[5], rows[4], rows[3]]
    twice = spark.createDataFrame([*rows, rows[1]], "doc_id long, text string, _id string")
    assert sorted(r.doc_id for r in ngram_join.one_per_component(twice).collect()) == [1, 7, 8, 9]


@pytest.mark.parametrize("more", [[], [(2, "p q r s t u v", "m"), (2, "p q r s t u v", "m")]])
def test_one_per_component_repeats(spark, more):
    """Rows without words stay however often they come, whatever other rows do."""
    rows = [(9, None, "a"), (9, None, "a"), (1, "some text that has words", "b"), *more]
    docs = spark.createDataFrame(rows, "doc_id long, text string, comp string")
    assert sorted(map(tuple, ngram_join.one_per_component(docs).collect()), key=str) == sorted(rows[:3 + bool(more)], key=str)


def test_one_per_component_with_one_id(spark):
    """A group stays as one document also where ids repeat or are null."""
    base = [f"w{i}" for i in range(60)]
    near = [" ".join([*base[:59], x]) for x in ("x", "y", "z")]
    for ids in ((5, 5, 5), (None, None, None), (None, 3, 3)):
        rows = list(zip(ids, near, "abc", strict=True)) + [(7, "quite another text here now", "d")]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
        kept = [tuple(r) for r in ngram_join.one_per_component(docs).collect()]
        assert len(kept) == 2 and rows[3] in kept
        one = next(r for r in kept if r != rows[3])
        assert one in rows and one[0] == next((i for i in ids if i is not None), None)
    three = spark.createDataFrame([(1, near[0], "a"), (2, near[1], "b"), (3, near[2], "c"), (1, "one of that id but quite other", "d"),
                                   (1, "and yet one more that is alone", "e")], "doc_id long, text string, source string")
    assert sorted(r.source for r in ngram_join.one_per_component(three).collect()) == ["a", "d", "e"]


def near_vectors(rng, n, dims):
    base = rng.standard_normal((n // 4, dims))
    rows = [base]
    for spread in (0.02, 0.2, 0.45):
        rows.append(base + spread * rng.standard_normal(base.shape))
    hot = rng.standard_normal(dims)
    rows.append(hot + 0.05 * rng.standard_normal((150, dims)))
    rows.append(np.repeat(hot[None, :], 20, 0))
    return np.concatenate(rows).astype(np.float32)


@pytest.mark.parametrize("blocks", [(2048, 4096), (32, 50)])
def test_embeddings_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(embedding_index, "MEMBERS", blocks[0])
    monkeypatch.setattr(embedding_index, "QUERIES", blocks[1])
    rng = np.random.default_rng(3)
    x = near_vectors(rng, 1200, 24)
    ids = rng.permutation(len(x)).tolist()
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in zip(ids, x, strict=True)],
                               "vec_id long, embedding array<float>, n_links int").repartition(4)
    got = {r.vec_id: r for r in embedding_index.near_duplicates(df).collect()}
    assert len(got) == len(x)
    d = x.astype(np.float64)
    d /= np.linalg.norm(d, axis=1)[:, None]
    linked = d @ d.T >= 0.9
    np.fill_diagonal(linked, False)
    degree = linked.sum(1)
    found = np.array([got[i].n_links for i in ids])
    assert (found <= degree).all() and found.sum() >= 0.97 * degree.sum()
    g = Groups()
    for a, b in zip(*np.nonzero(linked), strict=True):
        g.join(ids[a], ids[b])
    same = sum(got[i].component_id == g.root(i) for i in ids)
    assert same >= 0.97 * len(ids)
    assert all(g.root(i) <= got[i].component_id <= i and got[i].kept == (got[i].component_id == i) for i in ids)


def test_embedding_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [1.0, nan]), (7, [inf, 0.0]),
            (8, [1.0, 0.0, 0.0]), (9, [1.0, 0.0]), (10, [0.0, -1.0]), (11, []), (12, [1.0, 0.1, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_index.near_duplicates(df).collect()}
    want = {i: (0, i, True) for i, _ in rows} | {1: (2, 1, True), 2: (2, 1, False), 9: (2, 1, False), 8: (1, 8, True), 12: (1, 8, False)}
    assert got == want
    assert embedding_index.near_duplicates(df.limit(0)).collect() == []
    assert embedding_index.near_duplicates(df.where("vec_id in (3, 4)")).count() == 2


def test_embedding_ids_that_repeat_or_are_null(spark):
    """Rows are told by their vectors, whatever their ids."""
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_index.near_duplicates(df).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]
    rows = [(None, [1.0, 0.0]), (5, [1.0, 0.01]), (None, [1.0, 0.02]), (4, [0.0, 1.0]), (None, [-1.0, 0.0]), (None, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_index.near_duplicates(df).collect())
    assert got == {(None, 2, 5, False): 2, (5, 2, 5, True): 1, (4, 0, 4, True): 1, (None, 1, None, True): 2}


def test_embedding_visits_grow_slowly():
    """Cells a vector visits, its own among them, from 2,000 vectors to 200,000."""
    rng = np.random.default_rng(5)
    x = embedding_index._unit(rng.standard_normal((4000, 64)))
    mean = []
    for n in (2_000, 20_000, 200_000):
        grid = embedding_index.Grid(x, n, 0.9, 0.995, 1)
        cells = [grid.traversal(p, q) for p, q in zip(*grid.distances(x[:200]), strict=True)]
        mean.append(np.mean([1 + sum(y > c[0] for y in c[1:]) for c in cells]))
    print(mean)
    assert mean[0] <= 10 and mean[2] <= 60


def test_traversal_is_in_order_and_complete():
    rng = np.random.default_rng(1)
    x = embedding_index._unit(rng.standard_normal((500, 8)))
    grid = embedding_index.Grid(x, 4000, 0.9, 0.95, 1)
    a, b = grid.distances(x[:40])
    for p, q in zip(a, b, strict=True):
        total = p[:, None] + q[None, :]
        got = grid.traversal(p, q)
        assert set(got) == set(np.flatnonzero(total.ravel() <= grid.gap)) and len(set(got)) == len(got)
        assert (np.diff(total.ravel()[got]) >= 0).all()
