"""Suffix-array dedup against every window of every text, and its parts against
plain versions."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from martkit.llm import suffix_repeats
from martkit.llm.repeat_anchors import anchors, gram_hashes, sliding_minimum

WIDTH = 60


def covered(texts, width):
    """Per text, the maximal runs of bytes covered by strings that start twice."""
    data = [(t or "").encode() for t in texts]
    starts = Counter(d[i:i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        hit = bytearray(len(d) + 1)
        for i in range(len(d) - width + 1):
            if starts[d[i:i + width]] > 1:
                hit[i:i + width] = b"\1" * width
        edges = [i for i in range(len(d) + 1) if hit[i] != (hit[i - 1] if i else 0)]
        out.append((len(d), tuple(zip(edges[::2], edges[1::2], strict=True)), bytes(x for x, h in zip(d, hit) if not h)))
    return out


def check(spark, rows, width=WIDTH, parts=3, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = Counter((r.doc_id, r.n_bytes, tuple((s.lo, s.hi) for s in r.spans), bytes(r.kept))
                  for r in suffix_repeats.without_repeats(docs, width, **kw).collect())
    want = Counter((i, *x) for (i, _), x in zip(rows, covered([t for _, t in rows], width), strict=True))
    assert got == want


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé ", k=rng.randrange(1, 9))) for _ in range(400)]
    make = lambda k: " ".join(rng.choices(words, k=k))
    passages = [make(rng.randrange(8, 40)) for _ in range(6)]
    texts = []
    for _ in range(n):
        kind = rng.randrange(6)
        if kind == 0 and texts:
            texts.append(rng.choice(texts))
        elif kind == 1 and texts:  # a near copy
            t = rng.choice(texts) or "x"
            at = rng.randrange(len(t))
            texts.append(t[:at] + rng.choice(["", "#", "é"]) + t[at + 1:])
        elif kind == 2:
            texts.append(make(rng.randrange(30)) + " ".join(rng.choices(passages, k=2)) + make(rng.randrange(30)))
        elif kind == 3:
            p = rng.choice(passages)
            texts.append(p[rng.randrange(20):] + make(5))
        else:
            texts.append(make(rng.randrange(60)))
    texts += [None, "", "a", "z" * 59, "q" * 60, "w" * 61, "ab" * 100, "y" * 300, "\0" * 80 + "end",
              "abcdefghij" * 30, make(20) + "abcdefghij" * 8, passages[0], passages[0][:-1]]
    ids = list(range(len(texts)))
    ids[3] = ids[4] = None
    ids[7] = ids[8]
    rows = list(zip(ids, texts, strict=True))
    return rows + rows[5:9]


@pytest.mark.parametrize("seed", range(3))
def test_against_all_windows(spark, seed):
    check(spark, corpus(seed))


def test_hot_anchors(spark):
    check(spark, corpus(7), hot=2)


def test_contract_width(spark):
    rng = random.Random(1)
    base = "".join(rng.choices("abcdefgh \n", k=5000))
    rows = [(1, base), (2, base[1000:1399]), (3, "x" + base[2000:2400] + "y"), (4, base[3000:3401] + base[3000:3401]),
            (5, "".join(rng.choices("abcdefgh", k=900))), (6, base[:450] + "-" + base[451:900])]
    check(spark, rows, 400)


def test_long_text_in_parts(spark, monkeypatch):
    rng = random.Random(2)
    big = "".join(rng.choices("abcd", k=suffix_repeats.SLICE_BYTES + 5000))
    at = suffix_repeats.SLICE_BYTES
    check(spark, [(1, big), (2, "?" + big[at - 300:at + 300] + "!"), (3, big[:700])], 400)


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_repeats.without_repeats(empty, WIDTH).collect() == []
    rows = corpus(4, 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS t1", "2 AS gram", "3 AS id", "4 AS ranges", "5 AS m", "6 AS kept")
    got = Counter((r.doc_id, bytes(r.kept)) for r in suffix_repeats.without_repeats(docs, WIDTH).collect())
    assert got == Counter((i, x[2]) for (i, _), x in zip(rows, covered([t for _, t in rows], WIDTH), strict=True))


def test_groups_have_all_occurrences(spark):
    rng = random.Random(9)
    p = "".join(rng.choices("abcdef", k=200))
    texts = [rng.choice("ghi") + p[:n] + "XYZ"[i % 3] + "".join(rng.choices("uvw", k=40)) for i, n in
             enumerate([200, 200, 150, 120, 120, 90])]
    occurrences, shared = suffix_repeats.repeat_groups(spark.createDataFrame([(t,) for t in texts], "text string"), WIDTH)
    rows = occurrences.collect()
    parents = {r.repeat: r.parent for r in rows}
    total = defaultdict(int)
    for r in rows:
        at = r.repeat
        while at is not None:
            total[at] += 1
            at = parents.get(at)
    assert rows and all(r.length >= WIDTH for r in rows) and all(total[r.repeat] > 1 for r in rows)
    assert {r.m for r in shared.collect()} <= {1, 2, 3, 4, 5, 6}


def plain_repeats(contexts, width):
    """Maximal repeats and all their places, from every substring."""
    places = defaultdict(set)
    for c, x in enumerate(contexts):
        for i in range(len(x)):
            for j in range(i + width, len(x) + 1):
                places[x[i:j]].add((c, i))
    out = {}
    for w, at in places.items():
        if len(at) < 2:
            continue
        right = [contexts[c][i + len(w):i + len(w) + 1] or None for c, i in at]
        left = [contexts[c][i - 1:i] if i else None for c, i in at]
        if all(None in x or len(set(x)) > 1 for x in (left, right)):
            out[w] = at
    return out


@pytest.mark.parametrize("seed", range(6))
def test_maximal_repeats(seed):
    rng = random.Random(seed)
    base = bytes(rng.choices(b"abcd", k=60))
    contexts = [bytes(rng.choices(b"xy", k=rng.randrange(3))) + base[rng.randrange(25):30 + rng.randrange(30)]
                + bytes(rng.choices(b"zw\0", k=rng.randrange(4))) for _ in range(12)]
    contexts = sorted(set(c for c in contexts if len(c) >= 8))
    got = list(suffix_repeats.maximal_repeats(contexts, 8))
    places = [set(x[4]) for x in got]
    for i, x in enumerate(got):  # own occurrences and those of the groups below
        at = x[3]
        while at >= 0:
            places[at] |= set(got[i][4])
            at = got[at][3]
    found = {contexts[c][p:p + n]: places[i] for i, (n, c, p, _, _) in enumerate(got)}
    assert found == plain_repeats(contexts, 8)


def test_anchor_parts():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 101, 500, dtype=np.uint8)
    x = rng.integers(0, 50, 200)
    assert sliding_minimum(x, 7).tolist() == [x[i:i + 7].min() for i in range(194)]
    h = gram_hashes(np.concatenate((data, data)), 32)
    assert (h[:469] == h[500:969]).all()
    one = anchors(data, np.array([0, 500]), 60)
    assert one["windows"].sum() == 441 and (one["times"] == 1).all()
    many = anchors(np.full(300, 97, np.uint8), np.array([0, 300]), 60)
    assert many["times"].tolist() == [241] and many["reach"].tolist() == [240]
