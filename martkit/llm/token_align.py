"""Cross-tokenizer alignment of texts: which tokens of one vocabulary cover the same
bytes as which tokens of another.

Arrow all the way. A slice of texts is encoded with both tokenizers; flattened lists
with parent indices give one row per token, and running sums of token bytes, begun
anew in every document, its end. An Acero full outer join of the two sides on
(document, end) cuts the bytes at every end of either: each piece between two cuts is
one pair of overlapping tokens, the next ones that end. Where both sides end, a group
ends. ``Table.group_by`` counts the pairs of a slice, and Spark adds up the partial
counts. A slice keeps its distinct pairs once and its documents as numbers into them,
so that corpus-wide counts come back as one row per slice and pair, not per link.

Texts are cut, for encoding only, at single spaces between visible Latin characters,
where neither tokenizer joins anything across (checked for the pieces when a file is
read): the library encodes each distinct chunk once while a bounded memo has it. The alignment takes whole texts, so memory grows with the longest text of a table.

Defined results: texts that are null or empty, or whose token bytes on either side
are not the text with a space before it, have no tokens; documents are rows, so
repeated rows count again; a null id is a value like any other; an empty table gives
no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .token_counts import slices

SLICE_BYTES = 2 << 20   # text of one slice
MEMO = 200_000          # chunks remembered at most
MEMO_TOKENS = 2_000_000 # and their tokens
BLANK = "▁"
_LATIN = 0xC3  # the first UTF-8 byte of U+00C0..U+00FF, of which none is white space


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write a printable Latin-1 byte as itself and the others,
    in order, as the code points from 256 on."""
    shown = {b for r in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)) for b in range(r[0], r[1] + 1)}
    hidden = (b for b in range(256) if b not in shown)
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _vocabulary(pairs: Iterator[tuple[int, bytes]]) -> pa.Array:
    found = dict(pairs)
    return pa.array([found.get(i, b"") for i in range(max(found) + 1)], pa.binary())


class ByteLevel:
    """A byte-level tokenizer file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = _byte_of_symbol()
        added = {t["id"] for t in spec.get("added_tokens", ())}
        self.bytes = _vocabulary((i, s.encode() if i in added or any(c not in byte for c in s)
                                  else bytes(byte[c] for c in s)) for s, i in spec["model"]["vocab"].items())

    def encode(self, parts: list[str]) -> list[list[int]]:
        """Of texts that begin with a space."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]


class Pieces:
    """A piece model of the ``sentencepiece`` library that puts a blank first."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [(i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())]
        if any(BLANK in s.lstrip(BLANK) for _, s in names):
            raise ValueError(f"{path}: a piece has a blank behind another character")
        self.bytes = _vocabulary((i, bytes([int(s[3:5], 16)]) if self.model.is_byte(i)
                                  else s.replace(BLANK, " ").encode()) for i, s in names)

    def encode(self, parts: list[str]) -> list[list[int]]:
        """Of texts that begin with a space, which the model puts there itself."""
        return self.model.encode([p[1:] for p in parts], num_threads=1)


_LOADED: dict[tuple, object] = {}  # one per worker and file, kept between tasks


def _load(kind: type, path: str):
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]


def spaced(texts: pa.Array) -> pa.Array:
    """Texts with a space before them; empty ones stay empty."""
    text = pc.binary_join_element_wise("", texts, " ")
    return pc.if_else(pc.equal(pc.binary_length(texts), 0), "", text)


def chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The parts of ``spaced`` texts, each beginning with a space, and whose they are."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, n + 1, 4 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[:offsets[-1]]
    at = np.flatnonzero(data[2:-1] == 0x20) + 2
    before, after = data[at - 1], data[at + 1]
    seen = ((before > 0x20) & (before < 0x80)) | (data[at - 2] == _LATIN)
    at = at[seen & (((after > 0x20) & (after < 0x80)) | (after == _LATIN))]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = cut[offsets] = True
    cuts = np.flatnonzero(cut[offsets[0]:]) + offsets[0]
    parts = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data))
    return parts, np.searchsorted(offsets, cuts[:-1], "right") - 1


class Coder:
    """Both tokenizers behind one memo of chunks."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.sides = (a, b)
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}  # places in the pools
        self.pools = [pa.array([], pa.list_(pa.int32()))] * 2

    def encode(self, parts: pa.Array) -> list[pa.ListArray]:
        """Of either side, the token ids of every part."""
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.memo) + len(distinct) > MEMO:
            self.forget()
        new = [c for c in distinct if c not in self.memo]
        if new:
            self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new)), strict=True))
            self.pools = [pa.concat_arrays([pool, pa.array(side.encode(new), pool.type)])
                          for pool, side in zip(self.pools, self.sides, strict=True)]
        at = pa.array([self.memo[c] for c in distinct], pa.int64()).take(coded.indices)
        found = [pool.take(at) for pool in self.pools]
        if max(len(pool.values) for pool in self.pools) > MEMO_TOKENS:
            self.forget()
        return found


def _tokens(nested: pa.ListArray, doc_of_part: pa.Array, vocabulary: pa.Array) -> pa.Table:
    """``doc, id, end``: a row per token in order, its end in bytes within its text."""
    ids, doc = pc.list_flatten(nested), doc_of_part.take(pc.list_parent_indices(nested))
    size = pc.binary_length(vocabulary).take(ids).cast(pa.int64())
    running = pc.cumulative_sum(size)
    return pa.table({"doc": doc, "id": ids, "end": _restart(running, size, doc)})


def _restart(running: pa.Array, size: pa.Array, doc: pa.Array) -> pa.Array:
    """A running sum made to begin anew with every document."""
    if not len(running):
        return running
    new = pc.not_equal(doc, pa.concat_arrays([pa.array([-1], doc.type), doc.slice(0, len(doc) - 1)]))
    before = pc.if_else(new, pc.subtract(running, size), pa.scalar(None, pa.int64()))
    return pc.subtract(running, pc.fill_null_forward(before))


def _kept(tokens: pa.Table, vocabulary: pa.Array, texts: pa.Array) -> pa.Array:
    """Which ``spaced`` texts have the bytes of their tokens, and any."""
    if not tokens.num_rows:
        return pa.array([False] * len(texts), pa.bool_())
    joined = memoryview(vocabulary.take(tokens["id"].combine_chunks()).buffers()[2]).cast("B")
    size = np.zeros(len(texts), np.int64)
    np.maximum.at(size, np.asarray(tokens["doc"]), np.asarray(tokens["end"]))
    ends = np.cumsum(size)
    return pa.array([bool(t) and joined[e - n:e] == t for t, n, e in
                     zip(texts.cast(pa.binary()).to_pylist(), size.tolist(), ends.tolist(), strict=True)], pa.bool_())


def _nested(values: pa.Array, parents: np.ndarray, n: int) -> pa.ListArray:
    """Lists of values by ascending parent number; some of the n may be empty."""
    offsets = np.concatenate(([0], np.cumsum(np.bincount(parents, minlength=n))))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def aligned(texts: pa.Array, coder: Coder) -> dict:
    """Of a slice: arrays by document (``n_a``, ``n_b``, ``n_groups``, ``n_links`` and
    ``groups``, text), and ``links``: ``doc, a, b``, a row per overlapping pair."""
    texts = spaced(texts)
    parts, doc_of_part = chunks(texts)
    doc_of_part = pa.array(doc_of_part)
    sides = []
    for side, nested in zip(coder.sides, coder.encode(parts), strict=True):
        t = _tokens(nested, doc_of_part, side.bytes)
        sides.append((t, _kept(t, side.bytes, texts)))
    keep = pc.and_(sides[0][1], sides[1][1])
    ta, tb = (t.filter(keep.take(t["doc"])) for t, _ in sides)
    cuts = ta.rename_columns(["doc", "a", "end"]).join(
        tb.rename_columns(["doc", "b", "end"]), ["doc", "end"], join_type="full outer", use_threads=False)
    cuts = cuts.sort_by([("doc", "ascending"), ("end", "ascending")]).combine_chunks()
    both = pc.and_(pc.is_valid(cuts["a"]), pc.is_valid(cuts["b"])).combine_chunks()
    # The group of a cut: how many groups end before it.
    ends = np.asarray(both.to_numpy(zero_copy_only=False), np.int64)
    group = np.cumsum(ends) - ends
    doc = np.asarray(cuts["doc"])
    n, n_groups = len(texts), int(ends.sum())
    per_doc = {"n_groups": np.bincount(doc, weights=ends, minlength=n).astype(np.int64),
               "n_links": np.bincount(doc, minlength=n)}
    shown = []
    for side in ("a", "b"):
        has = np.asarray(pc.is_valid(cuts[side]).combine_chunks().to_numpy(zero_copy_only=False))
        per_doc[f"n_{side}"] = np.bincount(doc[has], minlength=n)
        ids = pc.drop_null(cuts[side]).combine_chunks().cast(pa.string())
        shown.append(pc.binary_join(_nested(ids, group[has], n_groups), ","))
    groups = pc.binary_join_element_wise(*shown, "|")
    per_doc["groups"] = pc.binary_join(_nested(groups, doc[ends == 1], n), ";")
    links = pa.table({"doc": cuts["doc"], "a": _next(cuts["a"]), "b": _next(cuts["b"])})
    return per_doc | {"links": links}


def _next(column: pa.ChunkedArray) -> pa.ChunkedArray:
    """The token that ends here or next; a text's last cut ends both sides."""
    return pc.fill_null_backward(column)


_ENCODED = "slice long, doc long, id {id}, n_a long, n_b long, n_groups long, n_links long, " \
    "groups string, at array<int>, times array<int>, pairs array<long>, totals array<long>"


def alignments(docs: DataFrame, byte_level_path: str, piece_path: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """A row per document: ``slice``, ``doc`` (its place there), ``id``, ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``, ``groups`` (``a1,a2|b1;a3|b2``: the token ids of every
    group), and how often (``times``) it links which pair (``at``: a place in the
    slice's pairs). The first row of a slice has its distinct ``pairs`` (a << 32 | b)
    and how often it links each (``totals``). The files are opened where the tasks run."""
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(_load(ByteLevel, byte_level_path), _load(Pieces, piece_path))
        number = 0
        for batch in batches:
            text = pc.fill_null(batch.column(1), "")
            for lo, hi in slices(text, SLICE_BYTES):
                n = hi - lo
                got = aligned(text.slice(lo, n), coder)
                links = got["links"]
                pair = pc.bit_wise_or(pc.shift_left(links["a"].cast(pa.int64()), 32), links["b"].cast(pa.int64()))
                own = pa.table({"doc": links["doc"], "pair": pair})
                total = own.group_by("pair", use_threads=False).aggregate([([], "count_all")])
                per = own.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
                per = per.append_column("at", pc.index_in(per["pair"], total["pair"].combine_chunks()))
                per = per.sort_by([("doc", "ascending"), ("at", "ascending")]).combine_chunks()
                of = np.asarray(per["doc"])
                head = np.zeros(n, np.int64)
                head[0] = total.num_rows
                where = np.repeat(np.arange(n), head)
                part = batch.column(2)[0].as_py()
                yield pa.record_batch(
                    [pa.array(np.full(n, part << 32 | number)), pa.array(np.arange(n)), batch.column(0).slice(lo, n),
                     *(pa.array(got[c].astype(np.int64)) for c in ("n_a", "n_b", "n_groups", "n_links")),
                     got["groups"],
                     _nested(per["at"].combine_chunks().cast(pa.int32()), of, n),
                     _nested(per["count_all"].combine_chunks().cast(pa.int32()), of, n),
                     _nested(total["pair"].combine_chunks(), where, n),
                     _nested(total["count_all"].combine_chunks().cast(pa.int64()), where, n)],
                    names=["slice", "doc", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "at", "times",
                           "pairs", "totals"])
                number += 1

    return read.mapInArrow(run, _ENCODED.format(id=read.schema["id"].dataType.simpleString()))


def pair_counts(rows: DataFrame) -> DataFrame:
    """Of stored alignments: ``pair``, ``a``, ``b``, ``n`` (links of the pair in all
    texts) and ``best`` (no other A id links that B id more often)."""
    flat = rows.where("doc = 0").select(F.explode(F.arrays_zip("pairs", "totals")).alias("x"))
    counts = stored(flat.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.totals").alias("n")), "pair-counts")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    top = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    named = counts.select("pair", F.shiftright("pair", 32).alias("a"), b.alias("_b"), "n")
    return named.join(top, F.col("_b") == F.col("b")).select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, byte_level_path: str, piece_path: str, id_col: str = "doc_id",
          text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per document: its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best`` (links whose pair is its B id's most frequent one), ``count_sum`` (links
    of the pairs in all texts, added over the document's links) and ``groups``; with
    ``digest``, ``groups_sha256`` instead of ``groups``."""
    found = alignments(docs, byte_level_path, piece_path, id_col, text_col)
    shown = "groups"
    if digest:
        shown = "groups_sha256"
        found = found.withColumn("groups", F.when(F.col("groups") == "", "").otherwise(
            F.sha2(F.col("groups").cast("binary"), 256)))
    rows = stored(found, "alignments")
    counts = stored(pair_counts(rows).select("pair", "n", "best"), "pair-best")
    own = rows.where("doc = 0").select("slice", F.posexplode("pairs").alias("at", "p"))
    need = own.join(counts, F.col("p") == F.col("pair")).select(F.col("slice").alias("of"), "at", "n", "best")

    kept = ["id", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("at").combine_chunks()
        n = np.asarray(right["n"])
        best = np.asarray(right["best"].combine_chunks().to_numpy(zero_copy_only=False)) if len(n) else np.zeros(0, bool)
        left = left.combine_chunks()
        at = np.asarray(pc.list_flatten(left["at"]).combine_chunks())
        times = np.asarray(pc.list_flatten(left["times"]).combine_chunks()).astype(np.int64)
        doc = np.asarray(pc.list_parent_indices(left["at"]).combine_chunks())
        sums = []
        for x in (times * best[at], times * n[at]):
            total = np.zeros(left.num_rows, np.int64)
            np.add.at(total, doc, x)
            sums.append(pa.array(total))
        return pa.table([*(left[c] for c in kept), *sums], names=[*kept, "n_best", "count_sum"])

    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.drop("doc", "pairs", "totals").groupBy("slice").cogroup(need.groupBy("of")).applyInArrow(
        score, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long")
    return scored.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                         F.col("groups").alias(shown))
