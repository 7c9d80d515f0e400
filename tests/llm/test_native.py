"""Line dedup, mixing, quality rules and surrogates against plain Python."""

import collections
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from martkit.llm import line_dedup, mixing, pii_surrogates, quality_rules
from martkit.llm.common import LOWER, UPPER, WS

FOLD = str.maketrans(UPPER, LOWER)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(4)


def line_rows():
    rng = random.Random(3)
    common = ["Menu", " menu\t", "MENU", "Copyright X", "", "  ", "a | b"]
    rows = []
    for i in range(60):
        lines = [rng.choice(common) if rng.random() < 0.5 else f"own {i} {rng.randint(0, 3)}"
                 for _ in range(rng.randint(0, 12))]
        rows.append((i, "\n".join(lines)))
    return [*rows, (60, None), (61, ""), (62, "\n"), (63, "Menu\n" * 50), (None, "Menu\nx"), (None, None)]


@pytest.mark.parametrize("keep", ["none", "first"])
def test_line_dedup(spark, keep):
    rows = line_rows()
    key = lambda x: x.strip(WS).translate(FOLD)
    docs_of = collections.Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for x in (t or "").split("\n"):
            first.setdefault(key(x), i)
    got = line_dedup.keep_bitmaps(frame(spark, rows, "doc_id long, text string"), min_docs=10, keep=keep,
                                  with_text=True).collect()
    assert len(got) == len(rows)
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    for r in got:
        found = False
        for t in texts[r.doc_id]:
            lines, used, kept = t.split("\n"), set(), []
            for x in lines:
                k = key(x)
                spare = keep == "first" and first[k] == r.doc_id and k not in used
                used.add(k)
                if not k or docs_of[k] < 10 or spare:
                    kept.append(x)
            runs = [x for run in r.keep for x in lines[run.start:run.start + run.len]]
            found |= (r.n_lines, r.n_dropped, r.kept_text, runs) == (
                len(lines), len(lines) - len(kept), "\n".join(kept), kept)
        assert found, r


def test_line_dedup_keeps_columns_and_counts_repeated_rows(spark):
    schema = "doc_id long, text string, _dropped string, _h long, keep string"
    rows = [(1, "same\nother", "x", None, "k")] * 10 + [(2, "same", None, 5, None), (3, None, None, None, None)]
    out = line_dedup.deduped(frame(spark, rows, schema), min_docs=10)
    assert out.columns == ["doc_id", "text", "_dropped", "_h", "keep"]
    assert sorted(out.collect(), key=lambda r: r.doc_id) == [(1, "", "x", None, "k")] * 10 + [
        (2, "", None, 5, None), (3, None, None, None, None)]
    empty = line_dedup.keep_bitmaps(frame(spark, [], schema))
    assert empty.collect() == []


def water_fill(sizes, weights, share, epochs):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, clamped = sum(sizes.values()) * share[0] / share[1], set()
    while True:
        left = total - sum(epochs * sizes[s] for s in clamped)
        free = [s for s in names if s not in clamped]
        target = {s: w[s] * left / sum(w[x] for x in free) for s in free}
        over = {s for s in free if target[s] > epochs * sizes[s]}
        if not over:
            return target | {s: float(epochs * sizes[s]) for s in clamped}
        clamped |= over


def mix_rows(seed, n=400):
    rng = random.Random(seed)
    names = ["s0", "s1", "s2", "é", "Z", None, "s10"]
    return [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 40, 300]))) if rng.random() > 0.05 else None,
             "en", "s0" if rng.random() < 0.35 else rng.choice(names), i) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_mixing(spark, seed):
    rows = mix_rows(seed)
    docs = frame(spark, rows)
    sizes = mixing.document_sizes(docs).cache()
    got = mixing.mix_sizes(sizes, [3, 1, 2]).collect()
    size = {i: len(WORD.findall(t or "")) for i, t, *_ in rows}
    per = collections.Counter()
    for i, _, _, s, _ in rows:
        per[s] += size[i]
    want = water_fill(per, [3, 1, 2], (3, 2), 2)
    taken = collections.Counter()
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == per[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-12)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 3 for s in want)
    assert sorted(got) == sorted(mixing.mix_sizes(sizes, [3, 1, 2]).collect())
    # The rows of the mix hold the words taken.
    words = collections.Counter()
    for r in mixing.mixed(docs, [3, 1, 2]).collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    assert words == {r.doc_id: r.taken for r in got if r.taken}


def test_mixing_edges(spark):
    assert mixing.mix_sizes(mixing.document_sizes(frame(spark, [])), [1]).collect() == []
    rows = [(None, "a b", "en", None, 0)] * 3 + [(1, None, "en", "x", 0), (2, "", "en", "x", 0)]
    got = mixing.mix_sizes(mixing.document_sizes(frame(spark, rows)), [3, 1, 2]).collect()
    assert len(got) == 5 and {r.taken for r in got if r.source == "x"} == {0}
    assert abs(sum(r.taken for r in got) - 9) <= 3
    extra = frame(spark, [(1, "a b c", "en", "x", "t", 5)], "doc_id long, text string, lang string, source string, "
                                                            "_taken string, size long")
    assert mixing.mixed(extra, [1], (2, 1)).collect() == [(1, "a b c", "en", "x", "t", 5)] * 2


def base_stats(text):
    t = text or ""
    words = WORD.findall(t)
    seen, dup = set(), 0
    for x in t.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(covered))


def test_quality_features(spark):
    rng = random.Random(9)
    texts = [None, "", " \n\t", "a", "é ü ß\x0b日本", "x " * 7, "x " * 8, "x " * 9, "a b c d e f g h " * 2,
             "a b c d e f g h i " + "z " + "a b c d e f g h", "l\nl\nL\n\nl \nl", "#*$%&|<> #"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += ["\n".join(rng.choice(["p q", "p q ", "", "r"]) for _ in range(9)) for _ in range(10)]
    rows = [(i, t, None if i % 5 == 0 else "en", "s", 0) for i, t in enumerate(texts)]
    for r in quality_rules.features(frame(spark, rows)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_stats(texts[r.doc_id])


def test_binomial_bound(spark):
    cases = [(k, n) for n in (1, 10, 400, 3000) for k in (0, 1, 2, 7, 20, 400) if k <= n]
    df = spark.createDataFrame(cases, "k long, n long").select(
        "k", "n", quality_rules.binomial_cdf(F.col("k"), F.col("n"), 0.01).alias("p"))
    for k, n, p in df.collect():
        exact = sum(math.comb(n, i) * 0.01**i * 0.99**(n - i) for i in range(min(k, 60) + 1))
        assert p == 1.0 if k >= n * 0.01 else math.isclose(p, exact, rel_tol=1e-9)


def test_quality_certification(spark):
    """Cutoffs are the strictest before the first failure, by stratum."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(3000):
        good = i % 6 > 0
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(30)]
        if not good:
            words = [w + "%%" for w in words]
        elif rng.random() < 0.02:
            words[:8] = [w + "#" for w in words[:8]]  # 0.27 symbols a word
        rows.append((i, " ".join(words), "en" if i % 3 else None, "s", 0))
        labels.append((i, int(good), 0))
    rows += [(9000 + i, " ".join(f"v{rng.random()}%%" for _ in range(30)), "xx", "s", 0) for i in range(5)]
    labels += [(1, 1, 0), (None, 1, 0), (77777, 1, 0), (5, None, 0)]
    feats = quality_rules.features(frame(spark, rows)).cache()
    lab = frame(spark, labels, "doc_id long, quality int, toxic int")
    cuts = {(r.stratum, r.rule): r.cutoff for r in quality_rules.certified_cutoffs(feats, lab, alpha=0.06).collect()}
    assert cuts["en", "symbols_per_word"] is not None and cuts["en", "symbols_per_word"] <= 1.5
    good = {i for i, q, _ in labels if q == 1}
    table = {r.doc_id: r for r in feats.collect()}
    for stratum in ("en", None):
        docs = [r for r in table.values() if r.stratum == stratum and r.doc_id in good and r.n_words >= 20
                and 100 * r.n_repeat_words <= 30 * r.n_words]
        for rule, (top, bottom, grid) in quality_rules.RULES.items():
            want = None
            for c in grid:
                k = sum(getattr(r, top) / max(1, getattr(r, bottom)) > c for r in docs)
                p = sum(math.comb(len(docs), i) * 0.01**i * 0.99**(len(docs) - i) for i in range(k + 1))
                if p > 0.05 / (len(quality_rules.RULES) * 2) or k >= len(docs) * 0.01:
                    break
                want = c
            assert cuts[stratum, rule] == want, (stratum, rule)
    kept = {r.doc_id: r.kept for r in quality_rules.judged(feats, lab, alpha=0.06).collect()}
    assert len(kept) == len(rows)
    assert not any(kept[i] for i in range(0, 3000, 6) if rows[i][2] == "en")
    assert all(kept[9000 + i] for i in range(5))  # a stratum without labels loses nothing
    assert sum(not kept[i] for i in range(3000) if i % 6) <= 0.06 * 2500


def test_quality_joint_vectors(spark):
    """Few labels certify all rules together; a rule that suits no document of a
    language leaves the others, if there are labels enough."""
    rng = random.Random(8)
    rows, labels = [], []

    def add(lang, good, **kind):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(30)]
        if "long" in kind:
            words = [w + "x" * 25 for w in words]
        if "junk" in kind:
            n = 10 if "long" in kind else 30
            words[:n] = [w + kind["junk"] for w in words[:n]]
        if "some" in kind:
            words[:10] = [w + "!" for w in words[:10]]  # 0.33 marks a word
        rows.append((len(rows), " ".join(words), lang, "s", 0))
        labels.append((len(rows) - 1, int(good), 0))

    for i in range(400):
        add("de", True, **({"some": 1} if i < 2 else {}))
    for i in range(150):
        add("few", True)
    for i in range(4000):
        add("zh", True, long=1)
    for lang in ("de", "few", "zh"):
        for i in range(20):
            add(lang, False, junk="%%" if i % 2 else "!!", **({"long": 1} if lang == "zh" else {}))
    feats = quality_rules.features(frame(spark, rows)).cache()
    lab = frame(spark, labels, "doc_id long, quality int, toxic int")
    cuts = {r._stratum: r.asDict() for r in quality_rules.certified_vectors(feats, lab).collect()}
    table = {r.doc_id: r for r in feats.collect()}
    good = [table[i] for i, q, _ in labels if q and rows[i][2] == "de"]

    def score(r, rule):
        top, bottom, _ = quality_rules.RULES[rule]
        return getattr(r, top) / max(1, getattr(r, bottom))

    want = {}
    for rule, c in quality_rules.PATH:
        now = want | {rule: c}
        k = sum(any(score(r, x) > y for x, y in now.items()) for r in good)
        if sum(math.comb(400, i) * 0.02**i * 0.98**(400 - i) for i in range(k + 1)) > quality_rules.JOINT * 0.05 / 3:
            break
        want = now
    assert want["symbols_per_word"] < 1 and want["marks_per_word"] < 1
    assert {r: cuts["de"][f"_cut_{r}"] for r in quality_rules.RULES} == {r: want.get(r) for r in quality_rules.RULES}
    assert all(cuts["few"][f"_cut_{r}"] is None for r in quality_rules.RULES)
    assert cuts["zh"]["_cut_word_length"] is None and cuts["zh"]["_cut_symbols_per_word"] == 0.05
    kept = {r.doc_id: r.kept for r in quality_rules.judged(feats, lab).collect()}
    lost = collections.Counter((rows[i][2], q) for i, q, _ in labels if not kept[i])
    assert lost["de", 0] == lost["zh", 0] == 20 and lost["few", 0] == lost["few", 1] == lost["zh", 1] == 0
    assert lost["de", 1] <= 2


def test_quality_accepted(spark):
    rows = [(1, "a", "en", "s", 0), (1, " ".join(f"w{i}" for i in range(40)), "en", "s", 0), (None, None, None, None, None)]
    lab = frame(spark, [], "doc_id long, quality int, toxic int")
    out = quality_rules.accepted(frame(spark, rows), lab)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert out.collect() == [rows[1]]
    assert quality_rules.accepted(frame(spark, []), lab).collect() == []


PII = [
    (1, "Write to Jane.Doe@Mail.Example.com or jane.doe@mail.example.com, bob@mail.example.com.", "x"),
    (2, "call +1 (017) 555-7713 now; +1 (018) 555-7713", None),
    (3, "card 4111 1111 1111 1111 and 4111111111111111 and 9807915762804490", "y"),
    (4, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ip 97.51.17.173 x 1.2.3.4', None),
    (5, "Mr. John Smith met Mrs Smith; Mr John Smith. Frau Müller-Lüdenscheidt, г-н Иван Петров", "z"),
    (6, None, None), (7, "", None), (8, "nothing 12 here", None), (8, "nothing 12 here", None),
    (None, "ssn 123-45-6789 iban DE89 3704 0044 0532 0130 00", None),
]


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def test_surrogates(spark):
    docs = frame(spark, PII, "doc_id long, text string, _map string")
    out = pii_surrogates.with_surrogates(docs, "k", count_col="n")
    assert out.columns == ["doc_id", "text", "_map", "n"]
    rows = out.collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(PII) and sorted(r.n for r in rows) == [0, 0, 0, 0, 2, 2, 3, 3, 3, 5]
    a, b, c = re.findall(r"\S+@\S+[a-z]", got[1].text)
    assert a.lower() == b and a[0].isupper() and b != c and b.split("@")[1] == c.split("@")[1]
    assert re.fullmatch(r"call \+\d \(\d{3}\) \d{3}-\d{4} now; \+\d \(\d{3}\) \d{3}-\d{4}", got[2].text)
    x, y, z = re.match(r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{16}) and (\d{16})$", got[3].text).groups()
    assert x.replace(" ", "") == y and luhn(y) and y != z
    assert re.match(r'token = "[0-9a-f]{40}" ip (\d+\.){3}\d+ x (\d+\.){3}\d+$', got[4].text)
    male, again = re.findall(r"Mr\.? (\w+ \w+)", got[5].text)
    assert male == again and male.split()[0] in pii_surrogates.NAMES["latin", "m"].split()
    assert re.search(r"г-н (\w+)", got[5].text)[1] in pii_surrogates.NAMES["cyrillic", "m"].split()
    assert re.match(r"ssn \d{3}-\d{2}-\d{4} iban DE\d{2} \d{4} \d{4} \d{4} \d{4} \d{2}$", got[None].text)
    assert got[6].text is None and got[7].text == "" and got[8].text == "nothing 12 here"
    private = ["ane.doe", "555-7713", "1111", "9807915762804490", "04dbebab", "97.51", "Smith", "Müller", "Иван",
               "123-45", "3704"]
    assert not any(p in (r.text or "") for p in private for r in rows)
    assert out.collect() and {r.text for r in out.collect()} == {r.text for r in rows}
    other = pii_surrogates.with_surrogates(docs, "another key").collect()
    assert {r.text for r in other} != {r.text for r in rows}
    assert pii_surrogates.with_surrogates(frame(spark, [], "doc_id long, text string"), "k").collect() == []


def test_surrogates_of_names_said_again(spark):
    texts = ["Mr John Smith came. Yesterday John Smith left; SMITH, said John, and Smith's dog. Mr Smith and Mary Smith.",
             "Ms Mary Jones and Mr John Smith: John Jones, Mary Jones.", "John Smith without a form of address"]
    docs = frame(spark, list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii_surrogates.with_surrogates(docs, "k", count_col="n").collect()}
    m = re.fullmatch(r"Mr (\w+) (\w+) came. Yesterday \1 \2 left; (\w+), said \1, and \2's dog. Mr \2 and Mary \2.", got[0].text)
    assert m and m[3] == m[2].upper() and "Smith" not in got[0].text and got[0].n == 7
    f = re.fullmatch(r"Ms (\w+) (\w+) and Mr (\w+) (\w+): \3 \2, \1 \2.", got[1].text)
    assert f and (f[3], f[4]) == (m[1], m[2]) and got[2].text == texts[2] and got[2].n == 0
    many = [(i, f"Mr A{chr(97 + i // 26)}{chr(97 + i % 26)} Smith") for i in range(100)]
    found = pii_surrogates.entities(frame(spark, many, "doc_id long, text string"), "k").where("kind = 'name'").collect()
    assert len(found) == 101 == len({r.surrogate for r in found}) == 101
    assert len({r.surrogate.split()[-1] for r in found}) == 1


def test_surrogates_of_card_groups_and_ipv6(spark):
    cards = ["3782 822463 10005", "3782-822463-10005", "3056 930902 5904", "6304 0000 0000 0000 000"]
    ips = ["2001:db8::ff00:42:8329", "2001:0DB8:0:0:0:FF00:0042:8329", "::1", "fe80::1", "::ffff:192.0.2.1", "::ffff:c000:201"]
    docs = frame(spark, [(0, "; ".join(cards)), (1, "; ".join(ips)), (2, "at 12:30:45 std::vector a::b 00:1a:2b:3c:4d:5e")],
                 "doc_id long, text string")
    got = {r.doc_id: r for r in pii_surrogates.with_surrogates(docs, "k", count_col="n").collect()}
    new = got[0].text.split("; ")
    assert [re.sub("[0-9]", "0", x) for x in new] == [re.sub("[0-9]", "0", x) for x in cards]
    assert not set(new) & set(cards) and luhn(new[0]) and new[0].replace(" ", "-") == new[1]
    new = got[1].text.lower().split("; ")
    assert all(re.fullmatch("2[0-9a-f]{3}(:[0-9a-f]{1,4}){7}", x) for x in new)
    assert new[0] == new[1] and new[4] == new[5] and len(set(new)) == 4 and got[1].n == 6
    assert got[2].text == "at 12:30:45 std::vector a::b 00:1a:2b:3c:4d:5e" and got[2].n == 0


def test_hint_covers_every_pattern():
    import regex
    said = {"email": ["a@b.cd"], "secret": ["a" * 32, "F" * 32, "AKIA" + "A" * 16, *(f"gh{c}_" + "x" * 20 for c in "pousr"), "sk-" + "y" * 20],
            "iban": ["DE89370400440532013000"], "card": ["3782 822463 10005", "4" * 13], "ssn": ["123-45-6789"],
            "phone": ["+1 (017) 555-7713"], "ipv6": ["::1", "2001:db8::a"], "ip": ["1.2.3.4"],
            "name": [f"{t} Xy" for t in (*pii_surrogates.MALE_TITLES, *pii_surrogates.FEMALE_TITLES, *pii_surrogates.OTHER_TITLES)]}
    assert set(said) == set(pii_surrogates.PATTERNS)
    for kind, texts in said.items():
        for t in texts:
            assert regex.fullmatch(pii_surrogates.PATTERNS[kind], t) and regex.search(pii_surrogates.HINT, t), t


def test_surrogates_do_not_collide(spark):
    """Network addresses with two octets left to choose from collide often at first."""
    rows = [(i, f"from 10.{i // 250}.{i % 250}.7 and 10.{i // 250}.{i % 250}.8") for i in range(4000)]
    found = pii_surrogates.entities(frame(spark, rows, "doc_id long, text string"), "k").collect()
    real = {r.normal for r in found}
    assert len(found) == 8000 == len({r.surrogate for r in found})
    assert not real & {r.surrogate for r in found}
    ssn = [(i, f"id 123-4{i % 10}-{i // 10:04d}") for i in range(3000)]
    found = pii_surrogates.entities(frame(spark, ssn, "doc_id long, text string"), "k").collect()
    assert len({r.surrogate for r in found}) == 3000


def test_op6_digest(spark):
    """The hash of the query is that of the kept text in UTF-8."""
    docs = frame(spark, [(1, "é\nx")], "doc_id long, text string")
    r = line_dedup.keep_bitmaps(docs, with_text=True).select(F.sha2(F.col("kept_text").cast("binary"), 256)).first()
    assert r[0] == hashlib.sha256("é\nx".encode()).hexdigest()


def test_one_text_per_labelled_id(spark):
    """Of an id's texts the one of the least features is looked at, in any order of rows."""
    rows = [(i % 7, f"w{i} " * (21 + i), "en") for i in range(40)]
    got = set()
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        feats = quality_rules.features(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(seed + 2))
        got.add(tuple(sorted(map(str, quality_rules._one_per_id(feats).collect()))))
    assert len(got) == 1 and len(next(iter(got))) == 7


def test_few_mailboxes_of_one_letter_settle(spark):
    boxes = [*"abcdefghijklmnopqrstuvwxyz", "é", "ö"]
    rows = [(i, f"write to {b.upper() if i % 2 else b}@mail.example now", None, None, 1) for i, b in enumerate(boxes)]
    got = [r.text for r in pii_surrogates.with_surrogates(frame(spark, rows), "k").collect()]
    new = [re.fullmatch(r"write to (\S+@\S+) now", t)[1].lower() for t in got]
    assert len(set(new)) == len(boxes) and not set(new) & {f"{b}@mail.example" for b in boxes}
    assert len({x.split("@")[1] for x in new}) == 1



def test_mentions_are_searched_once_for_the_entities(spark, monkeypatch):
    """Full names bring family names along; the texts are not searched again for that."""
    plans, store = {}, pii_surrogates.stored

    def kept(df, name):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return store(df, name)
    monkeypatch.setattr(pii_surrogates, "stored", kept)
    docs = spark.createDataFrame([(1, "Mr Karl Maier wrote to a.b@example.com"), (2, None)], "doc_id long, text string")
    found = pii_surrogates.entities(docs, "k").collect()
    assert sorted((r.kind, r.normal) for r in found) == [("email", "a.b@example.com"), ("name", "karl maier"), ("name", "maier")]
    assert sum(p.count("regexp_extract_all(text") for p in plans.values()) == 1
