"""Token counts, pieces, toxicity and HTML against the libraries and plain expectations."""

import random
import time

import pytest
import sentencepiece
from pyspark.sql import functions as F

from martkit.llm import html_text, sentence_pieces, token_counts, toxicity
from martkit.llm.queries import tokenizer_file

WORD_FILE, PIECE_FILE = tokenizer_file("word_bpe_49k.json"), tokenizer_file("piece_bpe_32k.model")

ODD = [None, "", " ", "a", "Hello  World\n\n", "I'm can't WE'LL 'S", "<|endoftext|>", "x<|startoftext|>y<|ENDOFTEXT|>z",
       "ΣΑΣ Σ ΟΔΟΣ", "é ́x", "１２３ ４ Ⅷ", "日本語テキスト 中文", "🙂👍🏽 ok", "İstanbul ŞĞ", "a b c\u0085d",
       "\x00\x01 ab", "tab\tsep\x0bv\x0cf\rr", "1234567890", "!!!???...", "ﬁ ﬂ", "﻿bom", "▁under▁score", "a​b",
       "\n\n a \n  b", "     lead", "trail     ", "a          b", "x" * 3000 + " " + "ab" * 600, "same", "same"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    letters = "abAB '<|>\n\t é́ß中🙂0129.,!Σσ▁"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(400)]


def frame(spark, texts, extra="n_tokens string, piece_ids int"):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], f"doc_id long, text string, {extra}").repartition(3)


def test_token_counts(spark, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORD_FILE)
    got = token_counts.token_counts(frame(spark, texts), WORD_FILE).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), len(tok.encode(t, add_special_tokens=False).ids)), t
    assert token_counts.token_counts(frame(spark, []), WORD_FILE).collect() == []


def test_ascii_words_are_those_of_the_file():
    import re

    import regex
    for c in map(chr, range(128)):
        text = f"a{c}b 1{c}{c}'s".lower()
        assert re.findall(token_counts.ASCII_WORD, text) == regex.findall(token_counts.WORD, text), c


def test_token_counts_of_control_characters(spark):
    from tokenizers import Tokenizer
    tok, odd = Tokenizer.from_file(WORD_FILE), ["a\x1cb", "\x1d\x1e x", "q\x1f"]
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(frame(spark, odd), WORD_FILE).collect()}
    assert got == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in enumerate(odd)}


def test_null_ids_pass_through(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(r.n_tokens for r in token_counts.token_counts(df, WORD_FILE).collect()) == [0, 2]
    assert sorted(r.n_pieces for r in sentence_pieces.encode(df, PIECE_FILE).collect()) == [0, 2]


def test_pieces(spark, texts):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    encoded = sentence_pieces.encode(frame(spark, texts), PIECE_FILE).cache()
    got = {r.doc_id: r for r in encoded.collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i].piece_ids == sp.encode(t or ""), t
        assert got[i].n_pieces == len(got[i].piece_ids)
    for r in sentence_pieces.decode(encoded, PIECE_FILE).collect():
        assert r.text == sp.decode(got[r.doc_id].piece_ids) == (texts[r.doc_id] or "").replace("▁", " ")
    ok = {r.doc_id: r.decodes for r in sentence_pieces.round_trips(frame(spark, texts), PIECE_FILE).collect()}
    assert ok == {i: "▁" not in (t or "") for i, t in enumerate(texts)}
    assert sentence_pieces.encode(frame(spark, []), PIECE_FILE).collect() == []


def test_pieces_that_are_no_text(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    ids = [[sp.piece_to_id("<0xE4>"), sp.piece_to_id("<0xB8>")], [], None, [1, 2, 0 + 300]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "doc_id long, piece_ids array<int>")
    got = {r.doc_id: r.text for r in sentence_pieces.decode(df, PIECE_FILE).collect()}
    assert got[0] == sp.decode(ids[0]) and got[1] == got[2] == "" and got[3] == sp.decode(ids[3])


PAGES = {
    "<p>a<p>b<ul><li>x<li>y<ol><li>1<li>2</ol></ul>tail": "a\n\nb\n\n- x\n- y\n  1. 1\n  2. 2\n\ntail",
    "<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td>kiwi<td>12</table>after": "Name   Qty\napple  3\nkiwi   12\n\nafter",
    "<table><caption>Cap</caption><tr><td colspan=2>wide one<td>z<tr><td>a<td>b<td>c</table>": "Cap\nwide one  z\na  b      c",
    "<pre>\n a\n  b</pre>x": " a\n  b\n\nx",
    "<div>one<br>two<br><br>three</div><div hidden>no</div><span style='display: none'>no</span>yes": "one\ntwo\n\nthree\nyes",
    "<b>bo<i>ld</b> it</i> end": "bold it end",
    "a &amp; b &lt;c&gt; &#233;": "a & b <c> é",
    "<script>var t='</p>';</script>ok<!-- c --> fine<style>p{}</style><template>t</template>": "ok fine",
    "<title>T</title><body>b</body>": "b", "x < y and <3 <": "x < y and <3 <", "</p></div>stray": "stray",
    "<p>unclosed <a href='x>y'>l</a>": "unclosed l", "<ol start=5><li>five<li>six</ol>": "5. five\n6. six",
    "<blockquote>q1<p>q2</blockquote>z": "  q1\n\n  q2\n\nz", "<dl><dt>T<dd>D<dt>U<dd>E</dl>": "T\n  D\nU\n  E",
    "<ul><li><p>para</p><p>two</p></li><li></li><li>z</li></ul>": "- para\n\n  two\n\n- z",
    "<p aria-hidden=true>seen<p>yes": "seen\n\nyes", "<table><tr><td>é中<td>x<tr><td>abcd<td>y</table>": "é中   x\nabcd  y",
    "<table><tr><td rowspan=2>A<td>b<tr><td>c</table>": "A  b\n   c",
    "<table><tr><td colspan=2>wide one here<td>z<tr><td>a<td>b<td>c</table>": "wide one here  z\na  b           c",
    "<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b>no</div>z": "yes\nz",
    "<table style='visibility:hidden'><tr><td>no<td style='visibility: visible'>yes</table>": "  yes",
    "<svg><title>t</title><style>x</style><circle r=1/><text x=1>a <tspan>b</tspan></text><g><text>c</text></g></svg>d": "a b cd",
    "": "", None: "",
}


def test_html(spark):
    pages = [*PAGES, next(iter(PAGES))]
    df = spark.createDataFrame([(i, None, p, "t") for i, p in enumerate(pages)], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.html_text(df).collect()}
    assert got == {i: PAGES[p] for i, p in enumerate(pages)}
    assert html_text.html_text(df.limit(0)).collect() == []


def test_html_head_without_end_or_body():
    for page, text in {
            "<head><title>T</title><p>Hello": "Hello", "<html><head><meta charset=x>\n<style>p{}</style>\nHello<p>you": "Hello\n\nyou",
            "<head><title>T</title><noscript><style>p{}</style></noscript><script>x()</script><link rel=y><div>a</div>b": "a\nb",
            "<head><template><p>no</p></template><base href=x><h1>H</h1>": "H", "<head> <title>T</title> </head> <p>a": "a",
            "<!DOCTYPE html><head><title>T</title><body>b": "b"}.items():
        assert html_text.render(page) == text, page


def plain_grid(rows):
    """A table's text by a matrix of single places. ``rows``: (text, down, across) cells."""
    taken, at = {}, []
    for r, cells in enumerate(rows):
        at.append([])
        c = 0
        for text, down, across in cells:
            while (r, c) in taken:
                c += 1
            for i in range(r, min(r + down, len(rows))):
                for j in range(c, c + across):
                    taken[i, j] = True
            at[-1].append((c, across, text))
            c += across
    edges = sorted({e for line in at for c, across, _ in line for e in (c, c + across)})
    widths = dict.fromkeys(edges, 0)
    for c, across, text in sorted((x for line in at for x in line), key=lambda x: sum(x[0] <= e < x[0] + x[1] for e in edges)):
        own = [e for e in edges if c <= e < c + across]
        widths[own[-1]] += max(0, len(text) - sum(widths[e] for e in own) - 2 * (len(own) - 1))
    out = []
    for line in at:
        s = ""
        for c, _, text in line:
            if text:
                s = s.ljust(sum(widths[e] + 2 for e in edges if e < c)) + text
        out += [s] if s else []
    return "\n".join(out)


def test_table_grids():
    rng = random.Random(12)
    for _ in range(300):
        rows = [[("".join(rng.choices("abc", k=rng.randrange(7))), rng.choice([1, 1, 1, 2, 3]), rng.choice([1, 1, 1, 2, 4]))
                 for _ in range(rng.randrange(1, 6))] for _ in range(rng.randrange(1, 6))]
        # a cell may not lie over one that reaches down into its columns
        page = "<table>" + "".join("<tr>" + "".join(f"<td rowspan={d} colspan={a}>{t}</td>" for t, d, a in cells) for cells in rows)
        if not overlapping(rows):
            assert html_text.render(page + "</table>") == plain_grid(rows), rows


def overlapping(rows):
    taken = set()
    for r, cells in enumerate(rows):
        c = 0
        for _, down, across in cells:
            while (r, c) in taken:
                c += 1
            own = {(i, j) for i in range(r, min(r + down, len(rows))) for j in range(c, c + across)}
            if own & taken:
                return True
            taken |= own
            c += across
    return False


@pytest.mark.parametrize("page", [
    "<b>" * 100_000 + "<p>x" * 100_000, "<p><button>" + "<i>" * 80_000 + "<p>y" * 80_000, "<table><td>" + "<i>" * 80_000 + "</b>" * 80_000,
    "<table><tr><td>" * 30_000 + "x", "<ul><li>" * 40_000 + "x", "<table><tr>" + "<td colspan=1000 rowspan=9999>c" * 20_000,
    "<div>" * 150_000, "<table><tr><td rowspan=500>a" * 3_000])
def test_long_pages_take_their_length(page):
    began = time.process_time()
    assert isinstance(html_text.render(page), str)
    assert time.process_time() - began < 12


def test_html_of_any_shape_ends():
    for page in ("<div>" * 20_000 + "x", "<table><tr><td>" * 300 + "x", "<p>" + "<b>a" * 5_000, "<" * 50_000,
                 "<a " + "x='" * 20_000, "<ul><li>" * 3_000 + "x", "<!--" * 9_000, "<![CDATA[" * 3_000, "&#x110000; &bogus;"):
        assert isinstance(html_text.render(page), str)
    rng = random.Random(2)
    bits = ["<p>", "</p>", "<table>", "<tr>", "<td>", "</table>", "<li>", "<ul>", "</ul>", "x", " ", "<pre>", "</pre>", "<br>",
            "<b", "<!--", "-->", "<script>", "</script>", "&amp", "<td colspan=x>", "<ol start=-1>", "</"]
    for _ in range(400):
        html_text.render("".join(rng.choice(bits) for _ in range(30)))


def test_fold():
    assert toxicity.fold("1d10t ІDІΟT ｓｔｕｐｉｄ st­upid café ΣÀ 5cum!") == " idiot idiot stupid stupid cafe σa scum "
    assert toxicity.fold("").split() == []
    for odd, plain in (("𝐬𝐭𝐮𝐩𝐢𝐝", "stupid"), ("ⓢⓣⓤⓟⓘⓓ", "stupid"), ("ạssẹ", "asse"), ("ꜱtupid", "stupid"), ("ɡrub", "grub"),
                       ("!diot", "idiot"), ("6rubbel", "grubbel"), ("sh!p", "ship"), ("1234 56", ""), ("4pril 2024", "april"),
                       ("日本 слон", "日本 cлoh"), ("naïve Ångström", "naive angstrom"), ("what! Ever", "what ever")):
        assert toxicity.fold(odd).split() == plain.split(), odd


def test_matches_are_those_of_plain_search():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abc", k=rng.randrange(1, 5)))
    for _ in range(150):
        weights = {f" {word()}{rng.choice([' ', ''])}": rng.uniform(1, 3) for _ in range(6)}
        spared = tuple(f" {word()} {word()} " for _ in range(3))
        text = toxicity.fold(" ".join(word() for _ in range(40)))
        want = {}
        for k, w in weights.items():
            for at in range(len(text)):
                if text.startswith(k, at):
                    want[at] = max(w, want.get(at, 0))
        for k in spared:
            for at in range(len(text)):
                if text.startswith(k, at):
                    for i in range(at, at + len(k) - 1):
                        want.pop(i, None)
        assert toxicity._hits(toxicity.Model(weights, spared, (0, 0, 0)).automaton(), text) == want


def test_one_sample_row_per_labelled_id(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 20)
    seen = []
    monkeypatch.setattr(toxicity, "stored", lambda df, name: (seen.append(df.count()), df)[1])
    docs = spark.range(3000).selectExpr("0L AS doc_id", "'some words' AS text").union(
        spark.range(1, 60).selectExpr("id AS doc_id", "concat('text ', id) AS text"))
    toxicity.fit(docs, spark.range(60).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic"))
    assert seen == [20]


def toxic_rows():
    rng = random.Random(6)
    vocabulary = [f"{a}{b}{c}" for a in ("lo", "mi", "ter", "sa") for b in ("ka", "ne", "vo", "di") for c in ("n", "r", "s", "l")]
    rows, labels = [], []
    for i in range(1500):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([8, 30, 200]))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(1 + len(words) // 30):
                words.insert(rng.randrange(len(words)), rng.choice(["grubbel", "gruBBel", "gru88elein", "zorvak", "z0rvak"]))
        elif i % 7 == 0:
            words += ["zorvak", "lamp"]  # harmless in this phrase
        rows.append((i, " ".join(words).replace("8", "b") if i % 2 else " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None), (10**6, 0, 1)], "doc_id long, quality int, toxic int")
    train = lab.where(~toxicity.held_out())
    model = toxicity.fit(docs, train)
    assert " zorvak lamp " in model.exceptions and " zorvak " in model.weights
    truth = {i: t for i, _, t in labels}
    scored = toxicity.score(docs, model).withColumn("h", toxicity.held_out()).collect()
    assert all(0 <= r.score <= 1 for r in scored)
    wrong = [r.doc_id for r in scored if r.h and (r.score >= 0.5) != bool(truth[r.doc_id])]
    assert len(wrong) <= 0.02 * sum(r.h for r in scored)
    again = toxicity.fit(docs, train)
    assert again == model
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "  "), (2, "zorvak"), (3, "zorvak lamp")], "doc_id long, text string")
    s = [(r.doc_id, r.score) for r in toxicity.score(odd, model).collect()]
    assert len(s) == 5 and len({x for i, x in s if i != 2}) == 1
    assert max(x for i, x in s if i == 2) > 0.5 > min(x for i, x in s)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {round(r.score, 3) for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert {r.score < 0.01 for r in toxicity.score(docs, toxicity.fit(docs, one)).collect()} == {True}
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, one)).collect() == []


def test_held_out_is_by_crc(spark):
    import zlib
    df = spark.range(50).select(F.col("id").alias("doc_id"), toxicity.held_out().alias("h"))
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in df.collect())


def test_long_chunks_are_cut_where_no_piece_reaches():
    path = tokenizer_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(8)
    coder = sentence_pieces.Encoder(path)
    made = ["".join(rng.choices("ABCdefghij0123+/=", k=30_000)), "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(9_000)),
            rng.randbytes(9_000).hex(), "é" * 6_000, "word " * 3 + "x1" * 4_000 + "\n" + "ok " + "7" * 5_000]
    ids, n = coder.encode(made)
    assert ids.tolist() == [i for t in made for i in library.encode(t)] and n.tolist() == [len(library.encode(t)) for t in made]
    parts = sentence_pieces.parts_of(coder.model, " " + made[0])
    assert len(parts) > 20 and "".join(parts) == " " + made[0] and max(map(len, parts)) < 4 * sentence_pieces.PART


def test_chunks_of_the_slice_before_are_remembered(monkeypatch):
    """Slices of 4 MB have some 150,000 distinct chunks, most of them seen before."""
    coder, learned = sentence_pieces.Encoder(PIECE_FILE), []
    monkeypatch.setattr(coder, "_learn", lambda new: (learned.append(len(new)), coder.memo.update(
        (c, sentence_pieces.np.zeros(1, "i4")) for c in new)))
    text = " ".join(f"w{i}" for i in range(150_000))
    coder.encode([text])
    coder.encode([text, "one more"])
    assert learned == [150_000, 2]


def test_split_is_numpys():
    np = sentence_pieces.np
    for counts in ([3, 0, 2, 1], [0], [6]):
        ids, n = np.arange(sum(counts), dtype="i4"), np.array(counts)
        assert [x.tolist() for x in sentence_pieces._split(ids, n)] == [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    assert sentence_pieces._split(np.zeros(0, "i4"), np.zeros(0, "i8")) == []
