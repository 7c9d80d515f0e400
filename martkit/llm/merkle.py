"""Merkle manifest of a dataset: a digest of every row, a root, and a proof per row.

Rows are leaves, in trees by group (ascending by id); the groups' roots are the leaves
of one more tree. While more than one node remains, each two consecutive nodes become
their hash, a last lone one the hash of itself.

Time-forward processing: nodes are numbered level by level, and a priority queue by
node number hands each digest forward in time to the parent; the reversed sweep, with
the numbers descending, hands each node's proof down to its children, which put their
sibling before it. Inside a block of ``BLOCK`` neighbouring nodes the queue is a heap;
between blocks it is Spark's sorted shuffle, which spills: the blocks' top nodes are
the nodes of the next round. A tree of n leaves takes log(n) / log(BLOCK) rounds, each
spread over all its blocks, so that a group with a third of all rows is many tasks.

Defined results: a null field is ``-``, any other its UTF-8 byte count, ``:`` and the
value; null ids come first, rows of one id ascend by digest, and equal rows may swap
their proofs; a null group is the first group; an empty table gives no rows; columns
that are not among ``fields`` are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BLOCK = 1_024   # nodes of a block, a power of two
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<sibling: string, left: boolean>>"

_PROOF_TYPE = pa.list_(pa.struct([("sibling", pa.string()), ("left", pa.bool_())]))


def row_digest(values: Sequence[Column]) -> Column:
    """Hex SHA-256 of the values, each ``-`` or its length and itself."""
    texts = [v.cast("string") for v in values]
    parts = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
             for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    def step(digest: Column, s: Column) -> Column:
        other = F.coalesce(s["sibling"], F.lit(""))
        return F.sha2(F.when(s["left"], F.concat(other, digest)).otherwise(F.concat(digest, other)), 256)
    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    """Hex SHA-256 of the siblings of a proof, one after the other."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: s["sibling"]), ""), 256)


# ---------------------------------------------------------------- one block
def _levels(n: int, size: int) -> int:
    """How many levels a block climbs when its tree has n nodes at its foot."""
    return (min(n, size) - 1).bit_length()


def climb(digests: Sequence[str], levels: int) -> list[list[str]]:
    """The nodes of a block, level by level: a queue of (level, place, digest) gives
    every node its children's digests when its number is due."""
    queue = [(0, i, d) for i, d in enumerate(digests)]  # sorted, so a heap
    tree: list[list[str]] = [[] for _ in range(levels + 1)]
    while queue:
        level, i, digest = heapq.heappop(queue)
        tree[level].append(digest)
        if level == levels:
            continue
        if queue and queue[0][:2] == (level, i + 1):  # i is even: its sibling is next
            right = heapq.heappop(queue)[2]
            tree[level].append(right)
            digest += right
        heapq.heappush(queue, (level + 1, i // 2, sha256(digest.encode()).hexdigest()))
    return tree


def descend(tree: list[list[str]], above: list[tuple]) -> list[list[tuple]]:
    """The proofs of a block's lowest nodes, ``above`` being that of its top."""
    queue = [(1 - len(tree), 0, above)]
    proofs = []
    while queue:
        level, i, proof = heapq.heappop(queue)
        if level == 0:
            proofs.append(proof)
            continue
        below = tree[-level - 1]
        for child in range(2 * i, min(2 * i + 2, len(below))):
            other = child ^ 1
            sibling = below[other] if other < len(below) else None
            heapq.heappush(queue, (level + 1, child, [(sibling, other < child), *proof]))
    return proofs


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole blocks out of a stream sorted by group and block, several at a time."""
    rest = None
    for b in batches:
        t = pa.table(b) if rest is None else pa.concat_tables([rest, pa.table(b)])
        if not t.num_rows:
            continue
        g, block, at = t["g"], t["block"], t.num_rows - 1
        last = (g[at].as_py(), block[at].as_py())
        while at and (g[at - 1].as_py(), block[at - 1].as_py()) == last:
            at -= 1
        rest = t.slice(at)
        if at:
            yield t.slice(0, at)
    if rest is not None and rest.num_rows:
        yield rest


def _runs(t: pa.Table) -> Iterator[tuple[int, int]]:
    keys = list(zip(t["g"].to_pylist(), t["block"].to_pylist(), strict=True))
    at = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[at]:
            yield at, i
            at = i


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("g", "block").sortWithinPartitions("g", "block", "idx")


# ---------------------------------------------------------------- rounds
def _placed(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``idx``, the place in the group ``g`` by ``order``, and ``n``, the
    group's size; stored. Ranges are cut by the whole order and a tie number, and only
    a row per range and group is looked at to number the ranges."""
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    cols = ["g", *order, "_tie"]
    ranges = stored(tied.repartitionByRange(*cols).sortWithinPartitions(*cols).drop("_tie")
                    .withColumn("_part", F.spark_partition_id())
                    .withColumn("_seq", F.monotonically_increasing_id()), name)
    first = ranges.groupBy("g", "_part").agg(F.min("_seq").alias("_first"), F.count("*").alias("_rows"))
    w = Window.partitionBy("g")
    before = w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = stored(first.select(
        F.col("g").alias("_g"), F.col("_part").alias("_p"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(w).alias("n")), f"{name}-ranges")
    joined = ranges.join(first, (F.col("g") == F.col("_g")) & (F.col("_part") == F.col("_p")))
    return stored(joined.withColumn("idx", F.col("_seq") + F.col("_shift"))
                  .drop("_g", "_p", "_part", "_seq", "_shift"), f"{name}-placed")


def _up(nodes: DataFrame, size: int) -> DataFrame:
    """The top nodes of all blocks: the nodes of the next round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches):
            digest, n, out = t["digest"].to_pylist(), t["n"].to_pylist(), []
            runs = list(_runs(t))
            for lo, hi in runs:
                out.append(climb(digest[lo:hi], _levels(n[lo], size))[-1][0])
            first = pa.array([lo for lo, _ in runs])
            yield pa.record_batch(
                [t["g"].take(first).combine_chunks(), t["block"].take(first).combine_chunks(),
                 pa.array([-(-n[lo] // size) for lo, _ in runs], pa.int64()), pa.array(out, pa.string())],
                names=["g", "idx", "n", "digest"])

    rows = nodes.select("g", F.expr(f"idx DIV {size}").alias("block"), "idx", "n", "digest")
    return _in_blocks(rows).mapInArrow(run, "g string, idx long, n long, digest string")


def _down(nodes: DataFrame, tops: DataFrame, size: int, carry: Sequence[str] = ()) -> DataFrame:
    """``tops`` (g, idx, subroot, root, proof) for the nodes one round below; columns
    ``carry`` of the nodes go along."""
    kinds = {c: nodes.schema[c].dataType.simpleString() for c in carry}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches):
            digest, n = t["digest"].to_pylist(), t["n"].to_pylist()
            took, proofs, marks = [], [], []
            for lo, hi in _runs(t):  # the block's top comes first
                above = [(s["sibling"], s["left"]) for s in t["proof"][lo].as_py()]
                found = descend(climb(digest[lo + 1:hi], _levels(n[lo + 1], size)), above)
                proofs += found
                took += range(lo + 1, hi)
                marks += [lo] * len(found)
            ends = [0]
            for p in proofs:
                ends.append(ends[-1] + len(p))
            steps = [s for p in proofs for s in p]
            proof = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                [pa.array([s for s, _ in steps], pa.string()), pa.array([x for _, x in steps], pa.bool_())],
                names=["sibling", "left"])).cast(_PROOF_TYPE)
            own, mark = t.take(pa.array(took, pa.int64())), t.take(pa.array(marks, pa.int64()))
            cols = [own["g"], own["idx"], mark["subroot"], mark["root"], *[own[c] for c in carry]]
            yield pa.record_batch([*(c.combine_chunks() for c in cols), proof],
                                  names=["g", "idx", "subroot", "root", *carry, "proof"])

    null = {"n": "long", "digest": "string", **kinds}
    rows = nodes.select("g", F.expr(f"idx DIV {size}").alias("block"), "idx", *null,
                        *[F.lit(None).cast(k).alias(c) for c, k in
                          (("subroot", "string"), ("root", "string"), ("proof", PROOF))])
    marks = tops.select("g", F.col("idx").alias("block"), F.lit(-1).cast("long").alias("idx"),
                        *[F.lit(None).cast(k).alias(c) for c, k in null.items()], "subroot", "root", "proof")
    extra = "".join(f"`{c}` {k}, " for c, k in kinds.items())
    return _in_blocks(rows.unionByName(marks)).mapInArrow(
        run, f"g string, idx long, subroot string, root string, {extra}proof {PROOF}")


def _rounds(nodes: DataFrame, size: int, name: str) -> list[DataFrame]:
    """The nodes of every round, the last with one node per group."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds = [nodes]
    while most > 1:
        rounds.append(stored(_up(rounds[-1], size), name))
        most = -(-most // size)
    return rounds


def proofs(leaves: DataFrame, order: Sequence[str], carry: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """``idx`` (place in the group), ``subroot``, ``root``, the columns ``carry`` and
    ``proof`` of every row of ``leaves`` (``g``, ``digest`` and the columns of ``order``
    and ``carry``; no null ``g``). A proof goes from the leaf's level up to the root; a
    node without a sibling is a step with a null sibling. ``block``: a power of two."""
    trees = _rounds(_placed(leaves, order, "merkle-leaves"), block, "merkle-nodes")
    subroots = trees[-1].select(F.lit("").alias("g"), F.col("g").alias("group"), "digest")
    top = _rounds(_placed(subroots, ["group"], "merkle-groups"), block, "merkle-top")
    tops = top[-1].select("g", "idx", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
                          F.array().cast(PROOF).alias("proof"))
    for i in range(len(top) - 2, 0, -1):
        tops = stored(_down(top[i], tops, block), "merkle-top-proofs")
    if len(top) > 1:
        tops = _down(top[0], tops, block, ["group", "digest"])
    else:  # one group at most: its root is the root
        tops = top[0].select("group", "digest", F.col("digest").alias("root"), F.array().cast(PROOF).alias("proof"))
    tops = stored(tops.select(F.col("group").alias("g"), F.lit(0).cast("long").alias("idx"),
                              F.col("digest").alias("subroot"), "root", "proof"), "merkle-group-proofs")
    for i in range(len(trees) - 2, 0, -1):
        tops = stored(_down(trees[i], tops, block), "merkle-proofs")
    if len(trees) > 1:
        return _down(trees[0], tops, block, list(carry)).select("idx", "subroot", "root", *carry, "proof")
    rows = trees[0].select(F.col("g").alias("_g"), *carry)
    return rows.join(tops, F.col("_g") == F.col("g")).select("idx", "subroot", "root", *carry, "proof")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id",
             group_col: str = "lang", also: dict[str, Column] | None = None, block: int = BLOCK) -> DataFrame:
    """One row per document: its id, ``leaf``, ``position`` (in its group), ``subroot``
    (of its group), ``root``, ``proof``, and ``also`` (name -> column over the documents)."""
    also = also or {}
    group = F.col(group_col).cast("string")
    rows = stored(docs.select(
        F.col(id_col).alias("id"), F.when(group.isNull(), "0").otherwise(F.concat(F.lit("1"), group)).alias("g"),
        row_digest([F.col(f) for f in fields]).alias("digest"),
        *[c.alias(f"also_{i}") for i, c in enumerate(also.values())]), "merkle-rows")
    names = [f"also_{i}" for i in range(len(also))]
    found = proofs(rows.withColumn("leaf", F.col("digest")), ["id", "digest"], ["id", "leaf", *names], block)
    return found.select(F.col("id").alias(id_col), "leaf", F.col("idx").alias("position"), "subroot", "root",
                        "proof", *[F.col(f"also_{i}").alias(c) for i, c in enumerate(also)])
