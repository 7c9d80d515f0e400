"""Token alignment against a byte-by-byte version over the libraries' tokens."""

import random
from collections import Counter
from hashlib import sha256

import duckdb
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers

from martkit.llm import queries, token_align

A_PATH, B_PATH = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("piece_bpe_32k.model")
COLS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def byte_tokens():
    a = tokenizers.Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    decode = token_align._byte_of_symbol()

    def of_a(text):
        return [(i, bytes(decode[c] for c in a.id_to_token(i)))
                for i in a.encode(" " + text, add_special_tokens=False).ids]

    def of_b(text):
        names = [(i, b.id_to_piece(i)) for i in b.encode(text)]
        return [(i, bytes([int(s[3:5], 16)]) if b.is_byte(i) else s.replace("▁", " ").encode()) for i, s in names]
    return of_a, of_b


def brute(texts):
    """Every byte belongs to one token of each side."""
    of_a, of_b = byte_tokens()
    rows, links = [], []
    for text in texts:
        sides = (of_a(text), of_b(text)) if text else ([], [])
        whole = [b"".join(x for _, x in s) for s in sides]
        if not text or any(w != (" " + text).encode() for w in whole):
            rows.append([0, 0, 0, ""])
            links.append(Counter())
            continue
        owner = [[k for k, (_, x) in enumerate(s) for _ in x] for s in sides]
        pairs = set(zip(*owner, strict=True))
        groups, now = [], ([], [])
        for at in range(len(whole[0])):
            last = [at + 1 == len(o) or o[at + 1] != o[at] for o in owner]
            for s in (0, 1):
                if last[s]:
                    now[s].append(str(sides[s][owner[s][at]][0]))
            if all(last):
                groups.append(",".join(now[0]) + "|" + ",".join(now[1]))
                now = ([], [])
        rows.append([len(sides[0]), len(sides[1]), len(groups), ";".join(groups)])
        links.append(Counter((sides[0][i][0], sides[1][j][0]) for i, j in pairs))
    total = sum(links, Counter())
    top = {}
    for (_, b), n in total.items():
        top[b] = max(top.get(b, 0), n)
    return [(r[0], r[1], r[2], sum(c.values()), sum(n for p, n in c.items() if total[p] == top[p[1]]),
             sum(n * total[p] for p, n in c.items()), r[3]) for r, c in zip(rows, links, strict=True)]


ODD = [None, "", " ", "  ", "a", "é", "日本語 text", "a\nb\r\n\tc", "<|endoftext|> x <s></s><unk>", "<0x0A>", "a▁b",
       "ends ", "  two  blanks", "don't we'll", "🙂🙂 ok", "é", "\u0000nul", "x" * 300, "a b", "１２３ ﬁ",
       "Zwölf Boxkämpfer jagen Viktor", "a" * 40 + " " + "b" * 40]


def corpus(n=60, seed=3):
    rng = random.Random(seed)
    real = [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    alphabet = "ab é\n ▁.日<>|s' \t"
    made = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(n)]
    return ODD + real + made + real[:5]


def found(df):
    return Counter(tuple(r[c] for c in ["doc_id", *COLS]) for r in df.collect())


@pytest.mark.parametrize("parts", [1, 5])
def test_against_bytes(spark, parts):
    texts = corpus()
    ids = [None, *range(1, len(texts) - 1), 3]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    expected = Counter((i, *row) for i, row in zip(ids, brute(texts), strict=True))
    assert found(token_align.align(docs.repartition(parts), A_PATH, B_PATH)) == expected


def test_digest_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string").selectExpr(
        "*", "7 AS slice", "'x' AS id", "3 AS doc", "4 AS pairs", "5 AS part")
    rows = {r.doc_id: r for r in token_align.align(docs, A_PATH, B_PATH, digest=True).collect()}
    assert rows[2].groups_sha256 == "" and rows[2].n_links == 0
    assert rows[1].groups_sha256 == sha256(brute(["one two"])[0][-1].encode()).hexdigest()


def test_empty_table(spark):
    assert token_align.align(spark.createDataFrame([], "doc_id long, text string"), A_PATH, B_PATH).collect() == []


def test_chunks():
    """Encoding chunk by chunk gives the library's tokens of the whole text."""
    rng = random.Random(5)
    words = " ".join(corpus(0)[len(ODD) + 3:len(ODD) + 60]).split(" ")
    long = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\n", " 's ", ". "]) for _ in range(30_000))
    texts = ["", long, "", "a b", "", " a b ", ""]
    parts, doc = token_align.chunks(token_align.spaced(pa.array(texts)).slice(0))
    assert len(parts) > 1000 and all(p.startswith(" ") for p in parts.to_pylist())
    coder = token_align.Coder(token_align.ByteLevel(A_PATH), token_align.Pieces(B_PATH))
    a, b = coder.sides
    got = [[[i for p, d in zip(x.to_pylist(), doc, strict=True) if d == k for i in p] for k in range(len(texts))]
           for x in coder.encode(parts)]
    assert got[0] == [a.tokenizer.encode(" " + t, add_special_tokens=False).ids if t else [] for t in texts]
    assert got[1] == [b.model.encode(t) for t in texts]
