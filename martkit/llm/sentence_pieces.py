"""SentencePiece encoding and decoding by suffix-array matching.

Texts come in Arrow batches. The distinct chunks of a batch (a run of blanks with
the word after it; no piece reaches across a chunk's end) are concatenated and
indexed by a suffix array, sorted to the length of the longest piece by prefix
doubling. Every vocabulary piece is binary-searched for its range of occurrences;
each occurrence is an edge from its first byte over its length. The edges are
sorted by position and then relaxed: all chunks at once, round by round, each
chunk takes the best-scored edge (leftmost on ties) that joins two of its current
neighbouring symbols, until none applies. That is the merge order of the byte-pair
model; characters outside the vocabulary fall back to byte pieces.

The model file gives the pieces and scores. Of its normalizer only "identity" with
a blank put before the text is supported, and anything else is refused (as are models
of more than 65,534 pieces).

Long chunks (text without blanks: base64, a language without spaces) are cut between
bytes that are neighbours in no piece; no piece can reach over such a place, so the
parts are encoded alone with the same result. A long run without such a place, of one
letter say, stays one chunk, with memory and time for all of it.

Defined results: a null or empty text has no pieces and decodes to an empty text;
decoding turns byte pieces that are no valid UTF-8 into U+FFFD, one per byte; the
character that stands for a blank in the vocabulary counts as a blank, as in the
library; rows repeat as they stand; empty tables give empty tables.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .token_counts import slices

BLANK = "▁"  # written for a blank in the vocabulary
SLICE_BYTES, INDEX_BYTES, MEMO, LONG = 4 << 20, 512 << 10, 600_000, 256  # a slice may have 150,000 chunks
LONG_CHUNK, PART = 4 << 10, 512   # bytes from which a chunk is cut, and of its parts at least

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceModel:
    """Pieces of a byte-pair model file, ready for search."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.encode("a  b ", out_type=str)[0] != BLANK + "a" or sp.decode(sp.encode("a  b ")) != "a  b ":
            raise ValueError("only the identity normalizer with a blank before the text is supported")
        ids = [i for i in range(sp.vocab_size())
               if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        text = [sp.id_to_piece(i).replace(BLANK, " ").encode() for i in ids]
        order = sorted(range(len(ids)), key=text.__getitem__)
        self.ids = np.array([ids[k] for k in order])
        self.text = [text[k] for k in order]
        self.length = np.array([len(t) for t in self.text])
        self.longest = 1 << int(self.length.max() - 1).bit_length()  # a power of two
        scores = np.array([sp.get_score(int(i)) for i in self.ids])
        if len(ids) > 65_534:
            raise ValueError("more pieces than the table of edges can number")
        self.joined = np.zeros((256, 256), bool)  # neighbours in a piece
        for t in text:
            b = np.frombuffer(t, np.uint8)
            self.joined[b[:-1], b[1:]] = True
        self.order = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.bytes = np.zeros(256, np.int64)
        for i in range(sp.vocab_size()):
            if sp.is_byte(i):
                self.bytes[int(sp.id_to_piece(i)[3:5], 16)] = i
        self.output = [b"" for _ in range(sp.vocab_size())]
        for i, t in zip(self.ids, self.text, strict=True):
            self.output[i] = t
        for b, i in enumerate(self.bytes):
            self.output[i] = bytes([b])
        # A chunk ends before a blank that follows no blank; also at line ends, if
        # no piece contains one.
        lines = all(b"\n" not in t for t in self.text)
        blank_inside = any(b" " in t.lstrip(b" ") for t in self.text)
        if blank_inside:
            raise ValueError("pieces that reach over a blank are not supported")
        self.chunk = re.compile(r" +[^ \n]*|[^ \n]+|\n" if lines else r" +[^ ]*|[^ ]+")
        head = b"".join(t[:8].ljust(8, b"\0") for t in self.text)
        self.head = np.frombuffer(head, ">u8").astype(np.uint64)


def parts_of(model: PieceModel, chunk: str) -> list[str]:
    """A long chunk in parts over whose ends no piece reaches."""
    data = chunk.encode()
    b = np.frombuffer(data, np.uint8)
    free = np.flatnonzero(~model.joined[b[:-1], b[1:]] & ((b[1:] & 0xC0) != 0x80)) + 1
    out, lo = [], 0
    while (k := int(np.searchsorted(free, lo + PART))) < len(free):
        out.append(data[lo:free[k]].decode())
        lo = int(free[k])
    return [*out, data[lo:].decode()] if lo < len(data) else out


def _words(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number."""
    padded = np.concatenate((buf, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(len(buf), np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k:k + len(buf)]
    return key


def suffix_array(buf: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``buf`` sorted by their next ``depth`` bytes (prefix doubling
    from eight bytes on), and the eight-byte keys by position."""
    key = _words(buf)
    sa = np.argsort(key)
    done = 8
    rank_of = key
    while done < depth:
        ordered = rank_of[sa]
        rank = np.empty(len(buf), np.uint64)
        rank[sa] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1]))).astype(np.uint64)
        later = np.zeros(len(buf), np.uint64)
        later[:-done] = rank[done:] + np.uint64(1) if len(buf) > done else 0
        rank_of = (rank << np.uint64(32)) | later
        sa = np.argsort(rank_of)
        done *= 2
    return sa, key


def occurrences(model: PieceModel, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (position, piece number), sorted by position. ``buf`` ends with zeros."""
    sa, key = suffix_array(buf, model.longest)
    padded = np.concatenate((buf, np.zeros(model.longest, np.uint8)))
    short = np.minimum(model.length, 8)
    shift = ((8 - short) * 8).astype(np.uint64)
    heads = key[sa]
    lo = np.searchsorted(heads, model.head, "left")
    hi = np.searchsorted(heads, model.head | ((np.uint64(1) << shift) - np.uint64(1)), "right")
    # Longer pieces: narrow the range byte by byte, for all of them at once.
    for at in range(8, int(model.length.max())):
        which = np.flatnonzero((model.length > at) & (lo < hi))
        if not len(which):
            break
        want = np.array([model.text[w][at] for w in which], np.int16)
        for side in (0, 1):
            a, b = lo[which].copy(), hi[which].copy()
            while (open_ := a < b).any():
                mid = (a + b) // 2
                byte = padded[sa[np.minimum(mid, len(sa) - 1)] + at].astype(np.int16)
                right = open_ & ((byte < want) if side == 0 else (byte <= want))
                a, b = np.where(right, mid + 1, a), np.where(open_ & ~right, mid, b)
            first = a if side == 0 else first
        lo[which], hi[which] = first, a
    count = np.maximum(hi - lo, 0)
    piece = np.repeat(np.arange(len(count)), count)
    start = np.repeat(lo - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    position = sa[start + np.arange(len(piece))]
    by = np.argsort(position)
    return position[by], piece[by]


def _relax_long(table: np.ndarray, order: np.ndarray, start: np.ndarray, length: np.ndarray) -> list[int]:
    """Symbol lengths of one long chunk, by a heap instead of rounds."""
    n, most = len(start), table.shape[1]
    size, after, before = length.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    at, heap = start.tolist(), []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and size[i] + size[j] <= most and (p := table[at[i], size[i] + size[j] - 1]):
            heapq.heappush(heap, (int(order[p - 1]), at[i], i, size[i], size[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if size[i] != a or j >= n or size[j] != b:
            continue
        size[i], size[j] = a + b, 0
        after[i] = k = after[j]
        if k < n:
            before[k] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return size


def encode_chunks(model: PieceModel, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all chunks one after the other, and how many each has."""
    buf = np.frombuffer(b"".join(chunks) + b"\0" * model.longest, np.uint8)
    size = np.fromiter(map(len, chunks), np.int64, len(chunks))
    ends = np.cumsum(size)
    position, piece = occurrences(model, buf)
    table = np.zeros((len(buf), model.longest), np.uint16)  # piece number + 1, 0: none
    inside = position + model.length[piece] <= np.append(ends, len(buf))[
        np.searchsorted(ends, position, "right")]
    position, piece = position[inside], piece[inside]
    table[position, model.length[piece] - 1] = piece + 1
    order = np.append(np.int32(2**31 - 1), model.order)  # by table entry; 0: no edge
    # Symbols: characters at first.
    start = np.flatnonzero((buf[:ends[-1]] & 0xC0) != 0x80)
    chunk = np.searchsorted(ends, start, "right")
    length = np.diff(np.append(start, ends[-1]))
    final_start, final_len = [], []
    symbols = np.bincount(chunk, minlength=len(chunks))
    long = np.flatnonzero(symbols > LONG)
    if len(long):
        for c in long:
            own = slice(*np.searchsorted(chunk, [c, c + 1]))
            got = np.array(_relax_long(table, model.order, start[own], length[own]))
            final_start.append(start[own][got > 0])
            final_len.append(got[got > 0])
        rest = symbols[chunk] <= LONG
        start, chunk, length = start[rest], chunk[rest], length[rest]
    while len(start):
        pair = np.append((chunk[1:] == chunk[:-1]) & (length[1:] + length[:-1] <= model.longest), False)
        best = np.full(len(start), order[0])
        at = np.flatnonzero(pair)
        best[at] = order[table[start[at], length[at] + length[at + 1] - 1]]
        first = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
        low = np.minimum.reduceat(best, first)
        group = np.cumsum(np.append(False, chunk[1:] != chunk[:-1]))
        over = low[group] == order[0]
        final_start.append(start[over])
        final_len.append(length[over])
        hit = np.flatnonzero((best == low[group]) & ~over)
        if not len(hit):
            break
        hit = hit[np.append(True, group[hit[1:]] != group[hit[:-1]])]  # the leftmost of each chunk
        length[hit] += length[hit + 1]
        stay = ~over
        stay[hit + 1] = False
        start, chunk, length = start[stay], chunk[stay], length[stay]
    start, length = np.concatenate(final_start), np.concatenate(final_len)
    by = np.argsort(start)
    start, length = start[by], length[by]
    number = np.where(length <= model.longest, table[start, np.minimum(length, model.longest) - 1], 0)
    number = number.astype(np.int64)
    known = number > 0
    out = np.where(known, 1, length)  # characters outside the vocabulary: a piece per byte
    ids = np.repeat(np.where(known, model.ids[number - 1], -1), out)
    within = np.arange(len(ids)) - np.repeat(np.cumsum(out) - out, out)
    fallback = ids < 0
    ids[fallback] = model.bytes[buf[(np.repeat(start, out) + within)[fallback]]]
    counts = np.bincount(np.searchsorted(ends, np.repeat(start, out), "right"), minlength=len(chunks))
    return ids.astype(np.int32), counts


def _split(ids: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """The ids of each of the rows that have ``counts`` of them (as ``np.split``, which is
    slow for many short rows)."""
    ends = np.cumsum(counts).tolist()
    return [ids[lo:hi] for lo, hi in zip([0, *ends][:-1], ends, strict=True)]


class Encoder:
    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.memo: dict[str, np.ndarray] = {}

    def _learn(self, new: list[str]) -> None:
        """Encode chunks in blocks of about INDEX_BYTES and remember them."""
        block, size = [], 0
        for i, c in enumerate(new):
            block.append(c.encode())
            size += len(block[-1])
            if size >= INDEX_BYTES or i + 1 == len(new):
                ids, counts = encode_chunks(self.model, block)
                got = _split(ids, counts)
                self.memo.update(zip(new[i + 1 - len(block):i + 1], got, strict=True))
                block, size = [], 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts one after the other, and how many each has."""
        per, flat = [], []
        for t in texts:
            found = self.model.chunk.findall(" " + t.replace(BLANK, " ")) if t else []
            if len(t) > LONG_CHUNK and max(map(len, found)) > LONG_CHUNK // 4:
                found = [p for c in found for p in (
                    parts_of(self.model, c) if len(c) > LONG_CHUNK // 4 and len(c.encode()) > LONG_CHUNK else [c])]
            per.append(len(found))
            flat += found
        if not flat:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        coded = pa.array(flat).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.memo) + len(distinct) > MEMO:
            self.memo.clear()
        self._learn([c for c in distinct if c not in self.memo])
        each = [self.memo[c] for c in distinct]
        if len(self.memo) > MEMO:
            self.memo.clear()
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        starts, pool = np.cumsum(sizes) - sizes, np.concatenate(each)
        which = np.asarray(coded.indices)
        n = sizes[which]
        total = np.concatenate(([0], np.cumsum(n)))
        ids = pool[np.repeat(starts[which] - total[:-1], n) + np.arange(total[-1])]
        ends = total[np.cumsum(per)]
        return ids, np.diff(np.concatenate(([0], ends)))

    def decode(self, ids: np.ndarray) -> str:
        joined = b"".join(map(self.model.output.__getitem__, ids.tolist()))
        return joined.decode("utf-8", "each_byte").removeprefix(" ")


_ENCODERS: dict[str, Encoder] = {}  # one per worker and file, kept between tasks


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _encoded(text: pa.Array, model_path: str) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    for i, j in slices(text, SLICE_BYTES):
        part = text.slice(i, j - i).to_pylist()
        yield part, *encoder(model_path).encode(part)
    encoder(model_path).memo.clear()  # idle workers keep the model only


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n_pieces`` and ``piece_ids``. The model file
    is opened where the tasks run, so it must be installed there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for part, ids, n in _encoded(pc.fill_null(b.column(1), ""), model_path):
                offsets = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
                yield pa.record_batch(
                    [b.column(0).slice(at, len(part)), pa.array(n.astype(np.int64)),
                     pa.ListArray.from_arrays(offsets, pa.array(ids))],
                    names=[id_col, "n_pieces", "piece_ids"])
                at += len(part)

    read = docs.select(F.col(id_col), F.col(text_col))
    kind = read.schema[0].dataType.simpleString()
    return read.mapInArrow(run, f"`{id_col}` {kind}, n_pieces long, piece_ids array<int>")


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id",
           ids_col: str = "piece_ids") -> DataFrame:
    """One row per row of piece ids: its id and ``text``. Null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [encoder(model_path).decode(np.array(x or [], np.int64)) for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    read = encoded.select(F.col(id_col), F.col(ids_col))
    kind = read.schema[0].dataType.simpleString()
    return read.mapInArrow(run, f"`{id_col}` {kind}, text string")


def round_trips(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n_pieces``, ``ids_sha256`` (of the ids as
    little-endian 32-bit numbers) and ``decodes`` (decoding gives the text again)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for part, ids, n in _encoded(pc.fill_null(b.column(1), ""), model_path):
                each = _split(ids.astype("<i4"), n)
                yield pa.record_batch(
                    [b.column(0).slice(at, len(part)), pa.array(n.astype(np.int64)),
                     pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in each], pa.string()),
                     pa.array([encoder(model_path).decode(x) == t
                               for x, t in zip(each, part, strict=True)], pa.bool_())],
                    names=[id_col, "n_pieces", "ids_sha256", "decodes"])
                at += len(part)

    read = docs.select(F.col(id_col), F.col(text_col))
    kind = read.schema[0].dataType.simpleString()
    return read.mapInArrow(run, f"`{id_col}` {kind}, n_pieces long, ids_sha256 string, decodes boolean")
