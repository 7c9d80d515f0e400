"""Token counts by heap-and-linked-list byte-pair merging.

A word's symbols form a linked list; a heap holds its adjacent pairs by merge rank,
then position. The lowest-rank pair is merged again and again, and the count is the
number of initial symbols less the number of merges: no token identifiers are built
or kept. Texts come in Arrow batches, are cut at white space in Arrow, and each
distinct piece of a slice of a batch is counted once; a bounded memo carries counts
between slices.

The tokenizer file gives the vocabulary, the merges, the word-end suffix and the
special strings; its own normalizer rules are: NFC, white space as one blank, lower
case character by character. Special strings inside a text count one token each, as
is the library's default.

Defined results: a null or empty text has 0 bytes and 0 tokens; rows repeat as they
stand; null ids pass through; an empty table gives an empty table; further columns
are not read.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text handled at once, and pieces remembered between slices.
SLICE_BYTES, MEMO = 8 << 20, 400_000

#: The tokenizer file's word pattern.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the others follow from U+0100 on."""
    itself = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in itself else chr(next(others)) for b in range(256)]


class PairMerger:
    """Counts the symbols that are left of a word once no merge applies."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix, vocab = model.get("end_of_word_suffix") or "", model["vocab"]
        self.inner = [vocab[c] for c in byte_symbols()]
        self.last = [vocab[c + suffix] for c in byte_symbols()]
        self.left, self.right, self.made = [], [], []
        self.rank: dict[int, int] = {}  # left symbol << 32 | right symbol -> rank
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.left.append(vocab[a])
            self.right.append(vocab[b])
            self.made.append(vocab[a + b])
            self.rank[vocab[a] << 32 | vocab[b]] = rank
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split_special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.words: dict[str, int] = {}

    def count(self, word: bytes) -> int:
        n = len(word)
        if n < 2:
            return n
        inner, rank = self.inner, self.rank
        sym = [inner[b] for b in word]
        sym[-1] = self.last[word[-1]]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            r = rank.get(sym[i] << 32 | sym[i + 1])
            if r is not None:
                heap.append(r << 40 | i)
        heapq.heapify(heap)
        merges = 0
        while heap:
            top = heapq.heappop(heap)
            r, i = top >> 40, top & 0xFFFFFFFFFF
            j = after[i]
            # A pair that an earlier merge took apart no longer matches its rank.
            if j >= n or sym[i] != self.left[r] or sym[j] != self.right[r]:
                continue
            merges += 1
            sym[i], sym[j] = self.made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                s = rank.get(sym[i] << 32 | sym[k])
                if s is not None:
                    heapq.heappush(heap, s << 40 | i)
            h = before[i]
            if h >= 0:
                s = rank.get(sym[h] << 32 | sym[i])
                if s is not None:
                    heapq.heappush(heap, s << 40 | h)
        return n - merges


class TokenCounter:
    """Counts of texts, by their distinct pieces between ASCII white space."""

    def __init__(self, path: str):
        self.merger = PairMerger(path)
        self.word, self.ascii_word = regex.compile(WORD), re.compile(ASCII_WORD)
        self.pieces: dict[str, int] = {}
        self.words: dict[str, int] = {}

    def _plain(self, piece: str) -> int:
        if piece.isascii():
            found = self.ascii_word.findall(piece.lower())
        else:
            # Lower case goes character by character: no final-sigma rule.
            low = "".join(map(str.lower, unicodedata.normalize("NFC", piece)))
            found = self.word.findall(low)
        total, known = 0, self.words
        for w in found:
            c = known.get(w)
            if c is None:
                if len(known) >= MEMO:
                    known.clear()
                c = self.merger.count(w.encode())
                if len(w) <= 64:
                    known[w] = c
            total += c
        return total

    def piece(self, piece: str) -> int:
        c = self.pieces.get(piece)
        if c is None:
            if "<" in piece and self.merger.special:
                parts = self.merger.split_special.split(piece)
                c = len(parts) - 1 + sum(map(self._plain, parts))
            else:
                c = self._plain(piece)
            if len(self.pieces) >= MEMO:
                self.pieces.clear()
            if len(piece) <= 64:
                self.pieces[piece] = c
        return c

    def texts(self, column: pa.Array) -> np.ndarray:
        """Token counts of a string array without nulls."""
        cut = pc.ascii_split_whitespace(column)
        flat = cut.flatten()
        offsets = np.asarray(cut.offsets) - cut.offsets[0].as_py()
        coded = flat.dictionary_encode()
        each = np.fromiter((self.piece(p) for p in coded.dictionary.to_pylist()), np.int64,
                           len(coded.dictionary))
        total = np.concatenate(([0], np.cumsum(each[np.asarray(coded.indices)])))
        return total[offsets[1:]] - total[offsets[:-1]]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, of one row at least."""
    size = np.concatenate(([0], np.cumsum(np.asarray(pc.binary_length(column)), dtype=np.int64)))
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(size, size[at] + limit, "right")) - 1)
        yield at, end
        at = end


_COUNTERS: dict[str, TokenCounter] = {}  # one per worker and file, kept between tasks


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n_bytes`` (UTF-8) and ``n_tokens``. The
    tokenizer file is opened where the tasks run, so it must be installed there."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _COUNTERS:
            _COUNTERS[tokenizer_path] = TokenCounter(tokenizer_path)
        counter = _COUNTERS[tokenizer_path]
        for b in batches:
            text = pc.fill_null(b.column(1), "")
            n = [counter.texts(text.slice(i, j - i)) for i, j in slices(text)]
            yield pa.record_batch(
                [b.column(0), pc.binary_length(text).cast(pa.int64()),
                 pa.array(np.concatenate(n) if n else np.zeros(0, np.int64))],
                names=[id_col, "n_bytes", "n_tokens"])

    read = docs.select(F.col(id_col), F.col(text_col))
    kind = read.schema[0].dataType.simpleString()
    return read.mapInArrow(count, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
