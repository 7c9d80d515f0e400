"""Suffix-array dedup: the byte strings of a corpus that occur more than once, with all
their occurrences, and the texts without them.

Anchors (``repeat_anchors``) cut the work: equal strings of ``width`` bytes lie in
contexts whose anchors have one hash, so suffixes need sorting only among those. Two
light passes over the texts count contexts by (anchor hash, context hash), which shows
what is unique, and what is a whole copy. Only anchors with several different contexts,
one of them single, are looked at in bytes, one copy of each context.

Over the contexts of such anchors an enhanced suffix array is built: the suffixes with
a partner of ``width`` bytes, sorted, and their common prefix lengths. A stack scan of
the lengths gives the tree of common-prefix intervals; those whose suffixes are
preceded by different bytes (or by none: the context begins) are maximal repeats. Every
occurrence is in the deepest such interval, intervals name their parent, so a group's
occurrences are those of its subtree, and nested groups repeat nothing. An anchor with
more than ``HOT`` different contexts is not gathered: Spark groups the windows of these
contexts by their 128-bit hashes, and its groups are of ``width`` bytes each.

Texts are equal by two 64-bit hashes, contexts by two (of the anchor's 32 bytes and of
the whole).

Defined results: a null text is an empty one; matches stay inside documents; a document
that comes twice is a copy; overlapping occurrences count; texts shorter than ``width``
stay whole; ids may be null or repeat; an empty table gives no rows; further columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .repeat_anchors import anchors, gram_hashes
from .token_counts import slices

SEEN = 100_000          # texts remembered against their copies
SLICE_BYTES = 2 << 20   # text of one pass of the anchors
ARRAY_BYTES = 2 << 20   # contexts under one suffix array (whole anchors, so up to HOT contexts more)
SORT_ROWS = 8_192       # suffixes sorted together
HOT = 16_384            # different contexts of an anchor that one task takes

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``common.stored``; the shuffle files go when the table is there."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return common.stored(df, name)
    finally:
        conf.set(_CLEANUP, before)


def _texts(docs: DataFrame, text_col: str, *more: Column) -> DataFrame:
    """``t1, t2`` (hashes), ``text``, and ``more``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2"), text.alias("text"), *more)


def _sliced(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """Rows, their bytes one after the other, where each begins, and what was before a
    text cut by its length (its windows come once, whichever part they are in)."""
    for b in batches:
        text = b.column("text").cast(pa.binary())
        for lo, hi in slices(text, SLICE_BYTES):
            x = text.slice(lo, hi - lo)
            offsets = np.frombuffer(x.buffers()[1], np.int32, len(x) + 1, 4 * x.offset).astype(np.int64)
            data = np.frombuffer(x.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
            offsets -= offsets[0]
            if hi - lo > 1:
                yield b.slice(lo, hi - lo), data, offsets, 0
                continue
            for at in range(0, len(data), SLICE_BYTES):
                part = data[at:at + SLICE_BYTES + width - 1]
                yield b.slice(lo, 1), part, np.array([0, len(part)]), at


def _anchor_rows(docs: DataFrame, text_col: str, width: int) -> DataFrame:
    """``gram, context, times, t1, t2, at, windows, reach`` of every anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets, base in _sliced(batches, width):
            x = anchors(data, offsets, width)
            which = pa.array(x["text"])
            yield pa.record_batch(
                [pa.array(x["gram"]), pa.array(x["context"]), pa.array(x["times"]), part.column("t1").take(which),
                 part.column("t2").take(which), pa.array((x["start"] - offsets[x["text"]] + base).astype(np.int32)),
                 pa.array(x["windows"].astype(np.int32)), pa.array(x["reach"].astype(np.int32))],
                names=["gram", "context", "times", "t1", "t2", "at", "windows", "reach"])

    texts = _texts(docs, text_col).where(F.octet_length("text") >= width)
    return texts.mapInArrow(run, "gram long, context long, times long, t1 long, t2 long, at int, windows int, reach int")


def _shared_anchors(docs: DataFrame, text_col: str, width: int) -> DataFrame:
    """The anchors whose context comes again (``m`` times in all) or shares its anchor
    hash with ``k`` different contexts, one of them single; the others are unique."""
    contexts = _stored(_anchor_rows(docs, text_col, width).groupBy("gram", "context").agg(F.sum("times").alias("m")),
                       "repeat-contexts")
    grams = contexts.groupBy("gram").agg(F.count("*").alias("k"), F.min("m").alias("least"))
    grams = grams.where("k > 1 AND least = 1").select(F.col("gram").alias("_g"), "k")
    known = contexts.join(grams, F.col("gram") == F.col("_g"), "left").where("m > 1 OR k IS NOT NULL").select(
        F.col("gram").alias("_g"), F.col("context").alias("_c"), "m", F.coalesce("k", F.lit(0)).alias("k"))
    known = _stored(known, "repeat-known")
    rows = _anchor_rows(docs, text_col, width).drop("times")
    return _stored(rows.join(known, (F.col("gram") == F.col("_g")) & (F.col("context") == F.col("_c"))).drop("_g", "_c"),
                   "repeat-anchors")


def _context_bytes(docs: DataFrame, shared: DataFrame, text_col: str, width: int) -> DataFrame:
    """``gram, context, k, bytes`` of one copy (or a few) of every contested context."""
    place = F.struct("t1", "t2", "at", "windows")
    one = shared.where("k > 0").groupBy("gram", "context", "k").agg(F.min(place).alias("p"))
    need = one.groupBy(F.col("p.t1").alias("_t1"), F.col("p.t2").alias("_t2")).agg(F.collect_list(F.struct(
        "gram", "context", "k", F.col("p.at").alias("at"), F.col("p.windows").alias("windows"))).alias("need"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()  # copies of a text are neighbours, mostly
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("gram", "context", "k", "bytes")}
            texts = b.column("text").cast(pa.binary())
            for i, key in enumerate(zip(b.column("t1").to_pylist(), b.column("t2").to_pylist(), strict=True)):
                if key in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
                text = texts[i].as_py()
                for x in b.column("need")[i].as_py():
                    for c in ("gram", "context", "k"):
                        out[c].append(x[c])
                    out["bytes"].append(text[x["at"]:x["at"] + x["windows"] + width - 1])
            kinds = {c: pa.binary() if c == "bytes" else pa.int64() for c in out}
            yield pa.record_batch([pa.array(v, kinds[c]) for c, v in out.items()], names=list(out))

    texts = _texts(docs, text_col)
    found = texts.join(need, (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")))
    return found.select("t1", "t2", "text", "need").mapInArrow(run, "gram long, context long, k long, bytes binary")


# ---------------------------------------------------------------- enhanced suffix array
def suffix_order(data: np.ndarray, starts: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``starts`` in the order of their suffixes (``rest``: their lengths), and each
    one's common prefix with the one before it."""
    longest = int(rest.max())
    padded = np.concatenate((data, np.zeros(longest, np.uint8)))
    rows = np.lib.stride_tricks.sliding_window_view(padded, longest)[starts]
    rows[np.arange(longest)[None, :] >= rest[:, None]] = 0
    order = np.argsort(rows.view(f"S{longest}").ravel(), kind="stable")
    rows, rest = rows[order], rest[order]
    differ = rows[1:] != rows[:-1]
    equal = np.where(differ.any(axis=1), differ.argmax(axis=1), longest)
    common_prefix = np.zeros(len(starts), np.int64)
    common_prefix[1:] = np.minimum(equal, np.minimum(rest[1:], rest[:-1]))
    return starts[order], common_prefix


def intervals(common_prefix: np.ndarray, before: np.ndarray, least: int) -> tuple[list[tuple], np.ndarray]:
    """The maximal repeats of a suffix order, by a stack scan of its common prefixes:
    ``(length, first, last, parent)`` of each common-prefix interval of ``least`` or more
    whose suffixes have different bytes ``before`` them (-1: none, differs from all), and
    the deepest of these of every suffix (-1: none). ``parent``: the next such interval
    around (-1: none)."""
    n = len(common_prefix)
    found: list[list] = []
    deepest = np.full(n, -1, np.int64)
    # On the stack: length, first suffix, what is before (None: several), inner repeats.
    stack: list[list] = []

    def close(top: list, last: int) -> int | None:
        length, first, left, inner = top
        if left is not None:
            return None
        here = len(found)
        found.append([length, first, last, -1])
        for x in inner:
            found[x][3] = here
        own = deepest[first:last + 1]
        own[own < 0] = here
        return here

    def joined(a: int | None, b: int | None) -> int | None:
        return a if a == b and a != -1 else None

    prefix, left = common_prefix.tolist() + [0], before.tolist()
    for i in range(1, n + 1):
        length = prefix[i] if prefix[i] >= least else 0
        first, bytes_before, inner = i - 1, left[i - 1], []
        while stack and stack[-1][0] > length:
            top = stack.pop()
            top[2] = joined(top[2], bytes_before)
            top[3] += inner
            here = close(top, i - 1)
            inner = top[3] if here is None else [here]
            first, bytes_before = top[1], top[2]
        if not length:
            continue
        if stack and stack[-1][0] == length:
            stack[-1][2] = joined(stack[-1][2], bytes_before)
            stack[-1][3] += inner
        else:
            stack.append([length, first, bytes_before, inner])
    return [tuple(x) for x in found], deepest


def maximal_repeats(contexts: list[bytes], width: int) -> Iterator[tuple]:
    """Of contexts, ``(length, first context, first place, parent, occurrences)`` of each
    maximal repeat of ``width`` bytes or more; ``parent`` is the number of a repeat in
    this order, or -1, and ``occurrences`` are the (context, place) in no inner one."""
    size = np.array([len(c) for c in contexts], np.int64)
    ends = np.cumsum(size)
    begins = ends - size
    data = np.frombuffer(b"".join(contexts), np.uint8)
    of = np.repeat(np.arange(len(contexts)), size)
    starts = np.flatnonzero(np.arange(len(data)) + width <= ends[of])
    h = gram_hashes(data, width)[starts]
    order = np.argsort(h, kind="stable")
    h, starts = h[order], starts[order]
    # Bytes before a suffix; a place at a context's begin differs from all others.
    at_begin = begins[of[starts]] == starts
    before = np.where(at_begin, -1, data[starts - 1].astype(np.int64))
    cut = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1], [True])))
    lo, hi = cut[:-1], cut[1:]
    several = hi - lo > 1
    lo, hi = lo[several], hi[several]
    if not len(lo):
        return
    # Suffixes whose partners all have one byte before them continue a longer repeat.
    both = np.column_stack((lo, hi)).ravel()
    bounded = np.append(before, 0)
    low, high = np.minimum.reduceat(bounded, both)[::2], np.maximum.reduceat(bounded, both)[::2]
    diverse = (low != high) | (low == -1)
    lo, hi = lo[diverse], hi[diverse]
    number, at = 0, 0
    while at < len(lo):
        end = max(at + 1, int(np.searchsorted(hi, lo[at] + SORT_ROWS, "right")))
        taken = np.concatenate([np.arange(a, b) for a, b in zip(lo[at:end].tolist(), hi[at:end].tolist(), strict=True)])
        own = starts[taken]
        sorted_starts, common_prefix = suffix_order(data, own, ends[of[own]] - own)
        left = np.where(begins[of[sorted_starts]] == sorted_starts, -1, data[sorted_starts - 1].astype(np.int64))
        found, deepest = intervals(common_prefix, left, width)
        members: list[list] = [[] for _ in found]
        for s, d in zip(sorted_starts.tolist(), deepest.tolist(), strict=True):
            if d >= 0:
                members[d].append((int(of[s]), int(s - begins[of[s]])))
        for (length, first, _, parent), inside in zip(found, members, strict=True):
            s = int(sorted_starts[first])
            yield length, int(of[s]), int(s - begins[of[s]]), parent if parent < 0 else number + parent, inside
        number += len(found)
        at = end


_OCCURRENCES = "repeat long, parent long, length int, gram long, context long, place int"


def _repeats(rows: DataFrame, width: int) -> DataFrame:
    """Occurrences of the maximal repeats of contexts (``gram, context, bytes``), each in
    the deepest one: ``repeat`` (a hash of its bytes and anchor), ``parent`` (the next one
    around it, null: none), ``length``, ``gram, context`` and the ``place`` there."""
    def solve(grams: list[int], names: list[int], contexts: list[bytes]) -> pa.RecordBatch:
        found = list(maximal_repeats(contexts, width))
        ids = [xxhash.xxh3_64_intdigest(contexts[c][p:p + n], seed=grams[c] & 0xFFFFFFFF) >> 1 for n, c, p, _, _ in found]
        out = [(ids[i], None if parent < 0 else ids[parent], n, grams[c], names[c], p)
               for i, (n, _, _, parent, inside) in enumerate(found) for c, p in inside]
        cols = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
        return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                               names=["repeat", "parent", "length", "gram", "context", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, names, contexts, size = [], [], [], 0
        for b in batches:
            for g, c, x in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if grams and g == grams[-1] and c == names[-1]:
                    continue  # another copy
                if size >= ARRAY_BYTES and g != grams[-1]:
                    yield solve(grams, names, contexts)
                    grams, names, contexts, size = [], [], [], 0
                grams.append(g)
                names.append(c)
                contexts.append(x)
                size += len(x)
        if contexts:
            yield solve(grams, names, contexts)

    return rows.select("gram", "context", "bytes").repartition("gram").sortWithinPartitions("gram", "context").mapInArrow(
        run, _OCCURRENCES)


def _hot_repeats(rows: DataFrame, width: int) -> DataFrame:
    """The same columns for contexts of anchors too frequent for one task: the repeats
    are the strings of ``width`` bytes."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g, c, x in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                n = len(x) - width + 1
                found = [xxhash.xxh3_128_intdigest(x[i:i + width]) for i in range(n)]
                w = np.array([(y >> 64, y & (1 << 64) - 1) for y in found], np.uint64).view(np.int64)
                yield pa.record_batch([pa.array([g] * n, pa.int64()), pa.array([c] * n, pa.int64()),
                                       pa.array(np.arange(n, dtype=np.int32)), pa.array(w[:, 0]), pa.array(w[:, 1])],
                                      names=["gram", "context", "place", "w1", "w2"])

    spread = rows.select("gram", "context", "bytes").dropDuplicates(["gram", "context"])
    each = _stored(spread.mapInArrow(windows, "gram long, context long, place int, w1 long, w2 long"), "repeat-windows")
    several = each.groupBy(F.col("w1").alias("_w1"), F.col("w2").alias("_w2")).agg(F.count("*").alias("n")).where("n > 1")
    hits = each.join(several, (F.col("w1") == F.col("_w1")) & (F.col("w2") == F.col("_w2")))
    return hits.select(F.col("w1").alias("repeat"), F.lit(None).cast("long").alias("parent"),
                       F.lit(width).alias("length"), "gram", "context", "place")


def repeat_groups(docs: DataFrame, width: int = 400, text_col: str = "text", hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """``(occurrences, anchors)``, two stored tables. Occurrences: ``repeat, parent,
    length, gram, context, place`` (the group of equal strings of ``width`` bytes or more,
    where it is in which context; the occurrences of a group are its own and those of
    the groups below it). Anchors: where these contexts, and those that are whole copies
    (``m`` > 1), are: ``gram, context, m, t1, t2`` (hashes of the text), ``at, windows,
    reach``."""
    shared = _shared_anchors(docs, text_col, width)
    rows = _stored(_context_bytes(docs, shared, text_col, width), "repeat-bytes")
    found = _repeats(rows.where(F.col("k") <= hot), width)
    if not rows.where(F.col("k") > hot).isEmpty():
        found = found.unionByName(_hot_repeats(rows.where(F.col("k") > hot), width))
    return _stored(found, "repeat-groups"), shared


def repeated_ranges(occurrences: DataFrame, shared: DataFrame, width: int = 400) -> DataFrame:
    """``t1, t2, ranges``: the byte ranges (``lo``, ``hi``) that repeats cover, by text."""
    cover = occurrences.groupBy(F.col("gram").alias("_g"), F.col("context").alias("_c")).agg(
        F.collect_set(F.struct("place", "length")).alias("parts"))
    whole = shared.where("m > 1").select(
        "t1", "t2", F.col("at").alias("lo"), (F.col("at") + F.col("reach") + F.col("windows") + (width - 1)).alias("hi"))
    single = shared.where("m = 1").join(cover, (F.col("gram") == F.col("_g")) & (F.col("context") == F.col("_c")))
    single = single.select("t1", "t2", "at", F.explode("parts").alias("p")).select(
        "t1", "t2", (F.col("at") + F.col("p.place")).alias("lo"), (F.col("at") + F.col("p.place") + F.col("p.length")).alias("hi"))
    return whole.unionByName(single).groupBy("t1", "t2").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))


def merged(ranges: np.ndarray) -> np.ndarray:
    """The union of ranges (rows lo, hi) as maximal runs; touching ones are one."""
    if not len(ranges):
        return ranges
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ranges[:, 1])
    new = np.flatnonzero(np.concatenate(([True], ranges[1:, 0] > reach[:-1])))
    return np.column_stack((ranges[new, 0], reach[np.append(new[1:], len(ranges)) - 1]))


def without_repeats(docs: DataFrame, width: int = 400, id_col: str = "doc_id", text_col: str = "text",
                    hot: int = HOT) -> DataFrame:
    """One row per document: its id, ``n_bytes``, ``spans`` (``lo``, ``hi``: the maximal
    runs of bytes that repeated strings of ``width`` bytes cover) and ``kept`` (the other
    bytes, which need not be whole characters)."""
    ranges = _stored(repeated_ranges(*repeat_groups(docs, width, text_col, hot), width), "repeat-ranges")
    ranges = ranges.select(F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column("ranges").flatten()
            both = np.column_stack([np.asarray(flat.field(c)) for c in ("lo", "hi")]).astype(np.int64)
            count = pc.fill_null(pc.list_value_length(b.column("ranges")), 0).to_pylist()
            kept, spans, n_spans, at = [], [], [], 0
            for x, n in zip(b.column("text").cast(pa.binary()).to_pylist(), count, strict=True):
                cut = merged(both[at:at + n])
                at += n
                edges = [0, *cut.ravel().tolist(), len(x)]
                kept.append(b"".join(x[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)))
                spans.append(cut)
                n_spans.append(len(cut))
            cut = np.concatenate([np.zeros((0, 2), np.int64), *spans]).astype(np.int32)
            yield pa.record_batch(
                [b.column("id"), pc.binary_length(b.column("text")).cast(pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_spans))).astype(np.int32)),
                                          pa.StructArray.from_arrays([pa.array(cut[:, 0]), pa.array(cut[:, 1])], names=["lo", "hi"])),
                 pa.array(kept, pa.binary())], names=[id_col, "n_bytes", "spans", "kept"])

    rows = _texts(docs, text_col, F.col(id_col).alias("id"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.join(ranges, (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")), "left")
    return found.select("id", "text", "ranges").mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes long, spans array<struct<lo: int, hi: int>>, kept binary")
