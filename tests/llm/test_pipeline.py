"""The pipeline, stage by stage, against a brute-force version on a small corpus."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from martkit.llm.common import LOWER, UPPER, WS, stored
from martkit.llm.queries import ORACLE, QUERIES, tokenizer_file

FOLD = str.maketrans(UPPER, LOWER)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    rows = []
    for i in range(240):
        words = [f"{rng.choice('abcdefgh')}{rng.randint(0, 900)}" for _ in range(rng.choice([5, 30, 30, 60, 200]))]
        if i % 9 == 0:
            words = words[:12] * 4  # repeats itself
        text = " ".join(words[:len(words) // 2]) + "\n" + " ".join(words[len(words) // 2:])
        if i % 4 == 0:
            text += "\n Subscribe NOW "
        rows.append([i, text, "en" if i % 3 else "de", f"s{rng.randint(0, 3)}" if i % 7 else "s0", len(text)])
    for i in range(240, 300):  # copies, some with a word changed
        text = rows[rng.randrange(200)][1]
        words = text.split(" ")
        if i % 2:
            words[rng.randrange(len(words))] = "changed"
        rows.append([i, " ".join(words), "en", "s1", None])
    rows += [[300, None, None, None, None], [301, "", "en", "s2", 0], [302, " \n", "fr", None, 2]]
    path = tmp_path_factory.mktemp("sf")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 9 > 0), 0) for i in range(0, 240, 2)], "doc_id long, quality int, toxic int") \
        .write.parquet(str(path / "labels.parquet"))
    return str(path)


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=lambda r: (r[0], r[1] or ""))


def quality_brute(rows):
    """Too few labels for any certified rule: the base rules alone."""
    kept = []
    for r in rows:
        words = WORD.findall(r[1] or "")
        seen = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        again = {j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
        if len(words) >= 20 and 100 * len(again) <= 30 * len(words):
            kept.append(r)
    return kept


def lines_brute(rows):
    key = lambda x: x.strip(WS).translate(FOLD)
    n = collections.Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")} if k)
    return [(r[0], r[1] and "\n".join(x for x in r[1].split("\n") if n[key(x)] < 10), *r[2:]) for r in rows]


def near_brute(rows):
    sets = []
    for r in rows:
        w = WORD.findall((r[1] or "").translate(FOLD))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 5 * o >= 4 * (len(sets[i]) + len(sets[j]) - o):
                a, b = part[i], part[j]
                part = [min(a, b) if p in (a, b) else p for p in part]
    low = {}
    for r, p in zip(rows, part, strict=True):
        low[p] = min(low.get(p, r[0]), r[0])
    return [r for r, p, s in zip(rows, part, sets, strict=True) if not s or low[p] == r[0]]


def mix_brute(rows):
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    per = collections.Counter()
    for r in rows:
        per[r[3]] += size[r[0]]
    names = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(names)}
    total, full = sum(per.values()) * 1.5, set()
    while True:
        left, free = total - sum(2 * per[s] for s in full), [s for s in names if s not in full]
        target = {s: weight[s] * left / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > 2 * per[s]}
        if not over:
            break
        full |= over
    target |= {s: 2.0 * per[s] for s in full}
    taken = {}
    for s in names:
        whole = int(target[s] // per[s]) if per[s] else 0
        rest = target[s] - whole * per[s]
        buckets = collections.defaultdict(list)
        for r in rows:
            if r[3] == s:
                h = hashlib.md5(f"7:{r[0]}".encode()).hexdigest()
                buckets[int(h[:6], 16)].append(r[0])
                taken[r[0]] = whole * size[r[0]]
        for b in sorted(buckets):
            own = sum(size[i] for i in buckets[b])
            for i in buckets[b]:
                taken[i] += size[i] if own <= rest else int(size[i] * max(0.0, rest) / own)
            rest -= own
            if rest < 0:
                break
    out = []
    for r in rows:
        n = size[r[0]]
        out += [r] * (taken[r[0]] // n if n else 0)
        if n and taken[r[0]] % n:
            out.append((r[0], " ".join(WORD.findall(r[1])[:taken[r[0]] % n]), *r[2:]))
    return out


def test_stages(spark, corpus):
    import sentencepiece
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "ngram_join", "mixing", "sentence_pieces"]
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    want = rows_of(docs)
    for (name, stage), brute in zip(corpus_pipeline.STAGES, [quality_brute, lines_brute, near_brute, mix_brute], strict=False):
        docs = stored(stage(spark, docs, corpus), "test")
        assert docs.columns == COLUMNS
        want = sorted(brute(want), key=lambda r: (r[0], r[1] or ""))
        assert rows_of(docs) == want, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, corpus)
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    key = lambda r: (r[0], r[2])
    pieces = [(r[0], len(sp.encode(r[1])), sp.encode(r[1])) for r in want]
    assert sorted(map(tuple, last.collect()), key=key) == sorted(pieces, key=key)
    assert sorted(map(tuple, corpus_pipeline.run(spark, corpus).collect()), key=key) == sorted(pieces, key=key)


def test_empty_corpus(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, corpus)
        assert docs.collect() == []


def test_registered():
    found = __spark_entry__.queries()
    names = [n for n in found if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in found
    assert set(names) == set(QUERIES) and set(ORACLE) <= set(__spark_entry__.oracle_sql())
    assert "pipeline" not in __spark_entry__.oracle_sql()
