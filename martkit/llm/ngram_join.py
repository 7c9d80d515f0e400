"""N-gram Jaccard join by token-combination prefixes.

A document's set is its distinct word shingles (48-bit hashes). Equal sets are one
class from the start and work goes on between classes only.

1. Document frequencies of all shingles. Tasks pack sorted (shingle, class) pairs
   into blobs, range-partitioned by shingle; a shingle that a chunk of documents
   shares widely is settled inside that chunk and only a mark of it is shuffled.
   Shingles of one class alone can be in no intersection and end here; the others go
   back to their classes with a level, log2 of the frequency up to ``TOP``.
2. Sets whose shared shingles are fewer than the least overlap end here. The others
   order their shingles rarest first (level, then hash) and take a prefix of it: two
   sets that link differ in at most n - overlap shingles, so a prefix that destroying
   so many leaves something of has a signature in common with the partner's. Rare
   shingles are signatures alone. Frequent ones are only in combinations of 2 (or 3,
   in the most frequent class) of the same hashed subclass; t shingles of a subclass
   then count for t - k + 1, which is what extends the prefix. The number of
   subclasses follows the size band, so combinations stay in proportion to the prefix.
3. Each signature links its smallest class with all others of it as candidates, which
   are verified by intersecting the shared shingles. What is still in different
   components is compared pairwise in small signature groups, and block by block in
   numpy in large ones, without ever writing pairs out. Links inside a component
   change nothing, so no pair is left out that could.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text with
fewer words than a shingle is one shingle; null, empty and blank texts have no
shingles and link with nothing; repeated rows are equal sets; the smallest id of a
component names it, null ids last; an empty table gives an empty table; further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.session import shuffle_partitions

from .common import stored
from .components import connected_components
from .token_counts import slices

SLICE_BYTES = 1 << 20       # text tokenized at once
CHUNK_DOCS, CHUNK_SHINGLES = 60_000, 750_000   # documents and shingles packed at once
PART_SHINGLES = 2_000_000   # shingles of a partition that counts frequencies
RANGE_SHINGLES = 300_000    # shingles of it that are sorted at once
LOCAL_HOT = 64              # classes of a chunk from which a shingle is settled in it
TOP = 6                     # level of frequencies from 2**TOP on; LOCAL_HOT is in it
COMBINE = (1, 1, 1, 2, 2, 2, 3)  # shingles a signature combines, by level
TINY = 12                   # sets up to this size use single shingles only
SMALL_GROUP, BLOCK = 32, 256

U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = np.arange(256, dtype=np.uint8)
_BYTE[65:91] += 32  # lower case of A-Z
_BYTE_HASH = _mix((_BYTE.astype(U) + U(1)) * U(0x9E3779B97F4A7C15))
_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, *range(9, 14)]] = False
_BASE = U(0xD1342543DE82EF95)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, U)
    out[:1] = 1
    return np.cumprod(out, dtype=U)


def shingles(text: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, 48-bit hash) of every shingle of a string array without nulls."""
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    data = text.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.int64), np.zeros(0, U)
    buf = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    at = np.flatnonzero(_IS_WORD[buf])
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, U)
    row_start = np.zeros(len(buf) + 1, bool)
    row_start[offsets[:-1]] = True
    first = np.append(True, (at[1:] != at[:-1] + 1)) | row_start[at]
    begin = np.flatnonzero(first)
    size = np.diff(np.append(begin, len(at)))
    within = np.arange(len(at)) - np.repeat(begin, size)
    h = np.add.reduceat(_BYTE_HASH[buf[at]] * _powers(int(size.max()))[within], begin)
    word = _mix(h + size.astype(U) * U(0xA0761D6478BD642F))
    row = np.searchsorted(offsets, at[begin], "right") - 1
    n = np.bincount(row, minlength=len(text))
    start = np.cumsum(n) - n
    place = _mix(np.arange(1, k + 1, dtype=U)) | U(1)
    padded = np.concatenate((word, np.zeros(k, U)))
    total = np.zeros(len(word), U)
    for j in range(k):
        # Shorter texts: the whole sequence, from their first word.
        inside = np.arange(len(word)) + j < (start + n)[row]
        total += np.where(inside, padded[j:j + len(word)], U(0)) * place[j]
    order = np.arange(len(word)) - start[row]
    keep = (order <= n[row] - k) | ((order == 0) & (n[row] < k))
    return row[keep], _mix(total[keep]) >> U(16)


def _sets(text: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row << 48 | shingle) of the distinct shingles, sorted; and the size and the
    64-bit class (never 0) of each row's set."""
    row, sh = shingles(text, k)
    own = np.sort((row.astype(U) << U(48)) | sh)
    own = own[np.append(True, own[1:] != own[:-1])] if len(own) else own
    n = np.bincount((own >> U(48)).astype(np.int64), minlength=len(text))
    some = np.flatnonzero(n)
    key = np.zeros(len(text), U)
    if len(some):
        starts = (np.cumsum(n) - n)[some]
        total = np.add.reduceat(_mix((own & U(2**48 - 1)) + U(0x9E3779B97F4A7C15)), starts)
        key[some] = np.maximum(_mix(total + n[some].astype(U)), U(1))
    return own, n, key


def _pieces(text: pa.Array, size: int, rows: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes and at most ``rows`` rows."""
    for i, j in slices(text, size):
        for x in range(i, j, rows):
            yield x, min(j, x + rows)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _unsigned(x: pa.Array) -> np.ndarray:
    return np.asarray(x).view(U)


# Blobs: two columns of 64-bit numbers, the first sorted.

def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _pack(a: np.ndarray, b: np.ndarray, names: np.ndarray | None = None) -> bytes:
    """``names``: b holds numbers of these values instead."""
    if names is not None:
        used, b = np.unique(b, return_inverse=True)
        names = names[used]
    parts = [_planes(np.diff(a, prepend=U(0))), _planes(b), _planes(names) if names is not None else b""]
    head = np.array([len(a), 0 if names is None else len(names)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, m = np.frombuffer(raw[:8], "<u4").tolist()
    a, b = np.cumsum(_unplanes(raw[8:8 + 8 * n]), dtype=U), _unplanes(raw[8 + 8 * n:8 + 16 * n])
    return a, _unplanes(raw[8 + 16 * n:])[b.astype(np.int64)] if m else b


def _unpacked(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    got = [_unpack(x) for x in blobs]
    none = np.zeros(0, U)
    return (np.concatenate([none, *(a for a, _ in got)]), np.concatenate([none, *(b for _, b in got)]))


#: Kinds of blobs: (shingle, class) pairs; (class, level and shingle); (class, set size).
PAIRS, SETTLED, SIZES = 0, 1, 2
_BLOB_TYPE = "part int, kind int, blob binary"


def _blob_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, blob = zip(*rows, strict=True)
    return pa.record_batch([pa.array(part, pa.int32()), pa.array(kind, pa.int32()),
                            pa.array(blob, pa.binary())], names=["part", "kind", "blob"])


def _cut(a: np.ndarray, bits: int, parts: int) -> Iterator[tuple[int, slice]]:
    """Slices of the sorted numbers of ``bits`` bits that fall into each of ``parts`` ranges."""
    limits = np.array([(i << bits) // parts for i in range(1, parts)], U)
    ends = [0, *np.searchsorted(a, limits, "left").tolist(), len(a)]
    for p in range(parts):
        if ends[p] < ends[p + 1]:
            yield p, slice(ends[p], ends[p + 1])


def _by_class(kind: int, key: np.ndarray, value: np.ndarray, parts: int) -> list[tuple[int, int, bytes]]:
    by = np.lexsort((value, key))
    key, value = key[by], value[by]
    return [(p, kind, _pack(key[s], value[s])) for p, s in _cut(key, 64, parts)]


def _chunk_blobs(own: np.ndarray, n: np.ndarray, key: np.ndarray, parts: int) -> list[tuple[int, int, bytes]]:
    """The blobs of one chunk of documents: ``own`` is (row << 48 | shingle)."""
    some = np.flatnonzero(n)
    _, once = np.unique(key[some], return_index=True)  # one row of each class
    some = some[once]
    rows = _by_class(SIZES, key[some], n[some].astype(U), parts)
    first = np.zeros(len(n), bool)
    first[some] = True
    row = (own >> U(48)).astype(np.int64)
    own = own[first[row]]
    pair = np.sort((own << U(16)) | (own >> U(48)))  # by shingle, then row
    sh, row = pair >> U(16), (pair & U(0xFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.append(True, sh[1:] != sh[:-1])) if len(sh) else np.zeros(0, np.int64)
    df = np.diff(np.append(starts, len(sh)))
    hot = np.repeat(df >= LOCAL_HOT, df)
    if hot.any():
        rows += _by_class(SETTLED, key[row[hot]], (U(TOP) << U(48)) | sh[hot], parts)
        # A mark (class 0) tells the other chunks.
        marks = sh[starts[df >= LOCAL_HOT]]
        rest_sh, rest_row = sh[~hot], row[~hot]
        sh, row = np.concatenate((rest_sh, marks)), np.concatenate((rest_row, np.full(len(marks), len(key))))
        by = np.argsort(sh, kind="stable")
        sh, row = sh[by], row[by]
    names = np.append(key, U(0))
    return rows + [(p, PAIRS, _pack(sh[s], row[s].astype(U), names)) for p, s in _cut(sh, 48, parts)]


def _grouped(kind_blobs: dict[int, list[bytes]], parts: int) -> list[tuple[int, int, bytes]]:
    """Counts the classes of each shingle of a partition; blobs for the classes."""
    out = []
    for kind in (SETTLED, SIZES):  # repeated where classes are in several chunks
        key, value = _unpacked(kind_blobs.get(kind, []))
        if len(key):
            by = np.lexsort((value, key))
            key, value = key[by], value[by]
            new = np.append(True, (key[1:] != key[:-1]) | (value[1:] != value[:-1]))
            out += _by_class(kind, key[new], value[new], parts)
    pairs = [_unpack(x) for x in kind_blobs.pop(PAIRS, [])]
    total = sum(len(sh) for sh, _ in pairs)
    if not total:
        return out
    low = min(int(sh[0]) for sh, _ in pairs if len(sh))
    high = max(int(sh[-1]) for sh, _ in pairs if len(sh)) + 1
    ranges = total // RANGE_SHINGLES + 1
    for r in range(ranges):
        limits = np.array([low + (high - low) * r // ranges, low + (high - low) * (r + 1) // ranges], U)
        cut = [slice(*np.searchsorted(sh, limits)) for sh, _ in pairs]
        sh = np.concatenate([sh[c] for (sh, _), c in zip(pairs, cut, strict=True)])
        key = np.concatenate([key[c] for (_, key), c in zip(pairs, cut, strict=True)])
        if len(sh):
            out += _by_class(SETTLED, *_shared_of(sh, key), parts)
    return out


def _shared_of(sh: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class, level and shingle) of the shingles that several classes have."""
    names, number = np.unique(key, return_inverse=True)
    bits, base = int(len(names)).bit_length(), sh.min()
    if int(sh.max() - base).bit_length() + bits <= 64:
        pair = np.sort(((sh - base) << U(bits)) | number.astype(U))
        pair = pair[np.append(True, pair[1:] != pair[:-1])]
        sh, number = (pair >> U(bits)) + base, (pair & U((1 << bits) - 1)).astype(np.int64)
    else:
        by = np.lexsort((number, sh))
        sh, number = sh[by], number[by]
        new = np.append(True, (sh[1:] != sh[:-1]) | (number[1:] != number[:-1]))
        sh, number = sh[new], number[new]
    key = names[number]
    starts = np.flatnonzero(np.append(True, sh[1:] != sh[:-1]))
    df = np.diff(np.append(starts, len(sh)))
    marked = key[starts] == 0  # class 0 sorts first
    level = np.where(marked, TOP, np.minimum(TOP, np.log2(np.maximum(df, 1)).astype(np.int64)))
    take = np.repeat((df > 1) | marked, df) & (key != 0)
    entry = (np.repeat(level, df).astype(U) << U(48)) | sh
    return key[take], entry[take]


def _least_overlap(n, num: int, den: int):
    """The least intersection with any set that links."""
    return -(-num * n // den)


def shared_shingles(docs: DataFrame, k: int, num: int, den: int, parts: int, text_col: str) -> DataFrame:
    """``key, n, entries`` of the classes that can link: the set's size and the
    shingles it shares with other classes (level << 48 | hash), in order."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        docs_held = shingles_held = 0

        def flush():
            n, key = (np.concatenate([x[i] for x in held]) for i in (1, 2))
            before = np.cumsum([0, *(len(x[1]) for x in held[:-1])])
            own = np.concatenate([x[0] + (U(b) << U(48)) for x, b in zip(held, before, strict=True)])
            return _chunk_blobs(own, n, key, parts)

        for b in batches:
            text = pc.fill_null(b.column(0), "")
            for i, j in _pieces(text, SLICE_BYTES, CHUNK_DOCS // 4):
                held.append(_sets(text.slice(i, j - i), k))
                docs_held, shingles_held = docs_held + j - i, shingles_held + len(held[-1][0])
                if docs_held > CHUNK_DOCS * 3 // 4 or shingles_held > CHUNK_SHINGLES:
                    if rows := flush():
                        yield _blob_rows(rows)
                    held, docs_held, shingles_held = [], 0, 0
        if held and (rows := flush()):
            yield _blob_rows(rows)

    def gathered(batches: Iterator[pa.RecordBatch]) -> dict[int, list[bytes]]:
        found: dict[int, list[bytes]] = {}
        for b in batches:
            for kind, blob in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                found.setdefault(kind, []).append(blob)
        return found

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if rows := _grouped(gathered(batches), parts):
            yield _blob_rows(rows)

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = gathered(batches)
        key, size = _unpacked(found.get(SIZES, []))
        of, entry = _unpacked(found.get(SETTLED, []))
        if not len(of):
            return
        key, first = np.unique(key, return_index=True)
        size = size[first].astype(np.int64)
        by = np.lexsort((entry, of))
        of, entry = of[by], entry[by]
        new = np.append(True, (of[1:] != of[:-1]) | (entry[1:] != entry[:-1]))
        of, entry = of[new], entry[new]
        starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        count = np.diff(np.append(starts, len(of)))
        n = size[np.searchsorted(key, of[starts])]
        can = np.flatnonzero(count >= _least_overlap(n, num, den))
        for c in np.array_split(can, max(1, len(can) // 2000)):
            if len(c):
                rows = np.repeat(starts[c] - np.cumsum(count[c]) + count[c], count[c]) + np.arange(count[c].sum())
                offsets = pa.array(np.concatenate(([0], np.cumsum(count[c]))).astype(np.int32))
                yield pa.record_batch(
                    [_signed(of[starts[c]]), pa.array(n[c]),
                     pa.ListArray.from_arrays(offsets, _signed(entry[rows]))], names=["key", "n", "entries"])

    # part numbers are partition numbers: hashed, some partitions would hold several
    blobs = docs.select(F.col(text_col)).mapInArrow(chunks, _BLOB_TYPE).repartitionById(parts, F.col("part").cast("int"))
    back = blobs.mapInArrow(frequencies, _BLOB_TYPE).repartitionById(parts, F.col("part").cast("int"))
    return back.mapInArrow(classes, "key long, n long, entries array<long>")


def set_classes(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """``id, text_hash, n, key`` per document: size and class of its set (0: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pc.fill_null(b.column(2), "")
            for i, j in _pieces(text, SLICE_BYTES, CHUNK_DOCS):
                _, n, key = _sets(text.slice(i, j - i), k)
                yield pa.record_batch([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                                       pa.array(n.astype(np.int64)), _signed(key)],
                                      names=["id", "text_hash", "n", "key"])

    read = docs.select(F.col(id_col), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.col(text_col))
    kind = read.schema[0].dataType.simpleString()
    return read.mapInArrow(run, f"id {kind}, text_hash long, n long, key long")


_M = (1 << 64) - 1


def _signature(*parts: int) -> int:
    x = 0x5851F42D4C957F2D
    for p in parts:
        x = ((x ^ p) * 0xD6E8FEB86659FD93) & _M
        x ^= x >> 32
    x = (x * 0xD6E8FEB86659FD93) & _M
    return (x ^ (x >> 29)) - (1 << 63)


def signatures_of(n: int, entries: np.ndarray, num: int, den: int) -> set[int]:
    """The signatures of a set of size ``n`` whose shared shingles are ``entries``
    (sorted); all others are in no other set and stand first in its order. From
    thresholds of 0.7 on, combinations over a whole set always reach what is needed."""
    need = n - _least_overlap(n, num, den) + 1 - (n - len(entries))
    if need <= 0:
        return set()
    rare = int(np.searchsorted(entries, COMBINE.index(2) << 48))
    order, found = entries.tolist(), set()
    if n <= TINY:
        found.update(_signature(1, e) for e in order[:need])
    if n < 5:  # all that it can link with are tiny as well
        return found
    found.update(_signature(2, e) for e in order[:min(rare, need)])
    if need <= rare:
        return found
    # Sizes of sets that link are in the same band or in neighbouring ones.
    ratio = den / num if num < den else 1.25
    band = int(np.floor(np.log(n) / np.log(ratio) + 1e-9))
    for shared_band in (band, band + 1):
        # Subclasses such that about four shingles of a prefix meet in one.
        subclasses = max(1, int((1 - num / den) * ratio ** shared_band / 4))
        groups: dict[tuple[int, int], list[int]] = {}
        credit = rare
        for e in order[rare:]:
            c = COMBINE[e >> 48]
            members = groups.setdefault((c, ((e * 0x9E3779B97F4A7C15) & _M) % subclasses), [])
            members.append(e)
            credit += len(members) >= c
            if credit >= need:
                break
        for (c, _), members in groups.items():
            found.update(_signature(3, shared_band, *x) for x in combinations(members, c))
    return found


def _signatures(shared: DataFrame, num: int, den: int) -> DataFrame:
    """``sig, key, n, s``: s shared shingles of n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes = b.column(0).to_pylist(), b.column(1).to_pylist()
            lists = b.column(2)
            offsets, flat = np.asarray(lists.offsets), _unsigned(lists.values)
            rows: list[tuple[int, int, int, int]] = []
            for r, (key, n) in enumerate(zip(keys, sizes, strict=True)):
                own = flat[offsets[r]:offsets[r + 1]]
                rows += [(x, key, n, len(own)) for x in signatures_of(n, own, num, den)]
                if len(rows) > 50_000 or (r + 1 == len(keys) and rows):
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                          names=["sig", "key", "n", "s"])
                    rows = []

    return shared.select("key", "n", "entries").mapInArrow(run, "sig long, key long, n long, s long")


def _can_link(n1, s1, n2, s2, num: int, den: int):
    """Whether the sizes and numbers of shared shingles of two sets allow a link."""
    return F.least(s1, s2) * (num + den) >= (n1 + n2) * num


def _verified(pairs: DataFrame, shared: DataFrame, num: int, den: int) -> DataFrame:
    x = shared.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("entries").alias("ea"))
    y = shared.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("entries").alias("eb"))
    both = pairs.select("a", "b").join(x, "a").join(y, "b")
    both = both.select("a", "b", "na", "nb", F.size(F.array_intersect("ea", "eb")).alias("o"))
    return both.where((F.col("na") + F.col("nb") - F.col("o")) * num <= F.col("o") * den).select("a", "b")


def _open_groups(sigs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the signature groups that are in several components, with ``comp``,
    the group's size ``m`` and smallest class ``low``."""
    named = sigs.join(labels, F.col("key") == F.col("node"), "left").select(
        *sigs.columns, F.coalesce("component", "key").alias("comp"))
    split = named.groupBy("sig").agg(F.count("*").alias("m"), F.min("key").alias("low"),
                                     F.min("comp").alias("c1"), F.max("comp").alias("c2"))
    return named.join(split.where("c1 < c2").select("sig", "m", "low"), "sig")


def _pairs_in(groups: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs of small groups between components; pairs with the smallest
    class of a group have been verified before."""
    a = groups.where("key <> low").select(
        "sig", F.col("key").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"), F.col("comp").alias("ca"))
    b = groups.select("sig", F.col("key").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"),
                      F.col("comp").alias("cb"))
    return (a.join(b, "sig").where("a < b AND ca <> cb")
            .where(_can_link(F.col("na"), F.col("sa"), F.col("nb"), F.col("sb"), num, den))
            .select("a", "b").distinct())


def _block_links(groups: DataFrame, shared: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) that join the components of large groups: groups that share a
    class are one cluster, whose classes are verified block against block in numpy;
    a task holds two blocks and returns a spanning forest of their links."""
    clusters = connected_components(groups.select("low", "key"))
    member = (groups.select("key", "comp").distinct()
              .join(clusters, F.col("key") == F.col("node")).select("component", "key", "comp"))
    count = member.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    member = (member.join(count, "component").join(shared, "key")
              .withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                      "key", "comp", "n", "entries"))

    def links(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        key, comp, n = (np.asarray(t[c]) for c in ("key", "comp", "n"))
        lists = t["entries"].combine_chunks()
        size = np.diff(np.asarray(lists.offsets))
        row = np.repeat(np.arange(len(key)), size)
        _, token = np.unique(np.asarray(lists.flatten()), return_inverse=True)
        overlap = np.zeros((len(key), len(key)), np.float32)
        by = np.argsort(token, kind="stable")
        row, token = row[by], token[by]
        for lo in range(0, int(token.max()) + 1, 8192):
            s = slice(*np.searchsorted(token, [lo, lo + 8192]))
            m = np.zeros((len(key), 8192), np.float32)
            m[row[s], token[s] - lo] = 1
            overlap += m @ m.T
        o = overlap.astype(np.int64)
        linked = (o * den >= (n[:, None] + n[None, :] - o) * num) & (comp[:, None] != comp[None, :])
        found, seen = [], np.zeros(len(key), bool)
        for root in range(len(key)):
            if seen[root]:
                continue
            seen[root], queue = True, [root]
            while queue:
                x = queue.pop()
                for y in np.flatnonzero(linked[x] & ~seen):
                    seen[y] = True
                    queue.append(y)
                    found.append((key[x], key[y]))
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return member.groupBy("component", "i", "j").applyInArrow(links, "a long, b long")


def linked_classes(shared: DataFrame, num: int, den: int) -> DataFrame:
    """``node, component`` of the classes that link with another. ``shared`` is a
    stored table."""
    sigs = stored(_signatures(shared, num, den), "jaccard-signatures")
    low = sigs.groupBy("sig").agg(F.min(F.struct("key", "n", "s")).alias("p"), F.count("*").alias("m"))
    star = (sigs.join(low.where("m > 1").select("sig", "p"), "sig").where("key <> p.key")
            .where(_can_link(F.col("n"), F.col("s"), F.col("p.n"), F.col("p.s"), num, den))
            .select(F.col("p.key").alias("a"), F.col("key").alias("b")).distinct())
    links = stored(_verified(star, shared, num, den), "jaccard-links")
    labels = stored(connected_components(links), "jaccard-components")

    groups = stored(_open_groups(sigs, labels).where(f"m <= {SMALL_GROUP}"), "jaccard-groups")
    more = stored(_verified(_pairs_in(groups, num, den), shared, num, den), "jaccard-links")
    if not more.isEmpty():
        labels = stored(connected_components(labels.toDF("a", "b").union(more)), "jaccard-components")

    groups = stored(_open_groups(sigs, labels).where(f"m > {SMALL_GROUP}"), "jaccard-groups")
    if not groups.isEmpty():
        more = stored(_block_links(groups, shared, num, den), "jaccard-links")
        if not more.isEmpty():
            labels = stored(connected_components(labels.toDF("a", "b").union(more)), "jaccard-components")
    return labels


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``text_hash``, ``n_shingles``,
    ``component_id``, the smallest id reachable over links: pairs of sets whose
    Jaccard similarity is ``num/den`` (0.7 at least) or more, and ``comp``, the same for
    all documents of a component whatever their ids (null: linked with none)."""
    if not 0.7 <= num / den <= 1:
        raise ValueError("thresholds from 0.7 to 1 are supported")
    spark = docs.sparkSession
    sets = stored(set_classes(docs, k, id_col, text_col), "jaccard-sets")
    total = sets.agg(F.sum("n")).first()[0] or 0
    parts = max(shuffle_partitions(spark), total // PART_SHINGLES + 1)
    shared = stored(shared_shingles(docs, k, num, den, parts, text_col), "jaccard-shared")
    labels = linked_classes(shared, num, den)
    own = sets.where("n > 0").groupBy("key").agg(F.min("id").alias("low"), F.count("*").alias("m"))
    named = own.join(labels, F.col("key") == F.col("node"), "left").select(
        "key", "low", "m", F.coalesce("component", "key").alias("comp"))
    comps = named.groupBy("comp").agg(F.min("low").alias("component_id"), F.sum("m").alias("m"))
    # Only documents with a copy or a link take part in the join by class.
    several = stored(named.select("key", "comp").join(comps.where("m > 1"), "comp")
                     .select(F.col("key").alias("_key"), "comp", "component_id", F.lit(True).alias("_several")), "jaccard-classes")
    return sets.join(several, (F.col("key") == F.col("_key")) & (F.col("n") > 0), "left").select(
        F.col("id").alias(id_col), "text_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("_several"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"), "comp")


def one_per_component(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The documents with one of each component: the one of the smallest (id, hash of
    the text), null ids last. Of rows that share id and text and have words one stays
    (the least by a hash of all its columns); documents without words all stay."""
    found = stored(jaccard_components(docs, k, num, den), "jaccard-verdicts").where("n_shingles > 0")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = found.where("comp IS NOT NULL").groupBy(F.col("comp").alias("_comp")).agg(F.min(place).alias("best"))
    keys = found.groupBy("doc_id", "text_hash", "comp").agg(F.count("*").alias("times"))
    told = keys.join(best, F.col("comp") == F.col("_comp"), "left")
    lost = F.col("best").isNotNull() & ~place.eqNullSafe(F.col("best"))
    told = stored(told.where(lost | (F.col("times") > 1)).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th"), lost.alias("_lost")), "jaccard-told")
    rows = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").alias("_i"),
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_t"))
    same = F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_th"))
    single = rows.join(told, same, "left_anti").select("_doc.*")
    again = rows.join(told.where("NOT _lost"), same).groupBy("_i", "_t").agg(
        F.min_by("_doc", F.xxhash64("_doc")).alias("_doc")).select("_doc.*")
    return single.unionByName(again)
