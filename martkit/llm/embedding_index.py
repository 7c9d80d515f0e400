"""Embedding near-dedup with an inverted multi-index.

Unit vectors are cut into halves; an own codebook for each half, fitted by k-means on
a bounded sample, spans a product grid of cells, and every vector is in the cell of
its two nearest codes. A query visits cells by multi-sequence traversal: the two
sorted lists of distances to the codes are combined nearest sum first, up to a gap
over the nearest cell. The gap is calibrated on the sample, at the hardest place: for
sample vectors turned away by exactly the threshold's angle, it is the quantile that
reaches ``recall``. All found candidates are verified by their cosine in double
precision; all vectors are queries and all are indexed.

A vector visits cells of higher number than its own, and its own: of two vectors in
different cells the one in the lower visits the other, so every pair is looked at
once, and counts for both. Visits are stored as numbers (cell, class); vectors are
joined to them on the way to the cells' blocks only. Equal vectors are one class
throughout, known by a number of its own, so ids may repeat or be null. The work of a
cell is split into blocks of members and of queries, so that a cell with a third of
all vectors is many small matrix products; blocks return counts and the edges of a
spanning star per linked group, never the pairs.

A code is fitted on eight sample vectors or more, so there are at most
(SAMPLE / 8)^2 cells; with more than PER_CELL times as many vectors (10^9), cells, and
the work per vector, grow with the table.

Defined results: null vectors, zero vectors, and those with null or non-finite
components link with nothing; vectors link only with vectors of their length; an
empty table gives an empty table; rows with the same id and vector are two rows that
link with each other, and those with the same id and other vectors are as different as
any; rows with a null id link like others, are smaller than no id, and where a
component has no id at all, its id is null; ``kept`` is true where ``id <=>
component_id``; further columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import connected_components

SAMPLE = 20_000     # vectors that fit the codebooks at most
PER_CELL = 160      # vectors that a cell has on average
MEMBERS, QUERIES = 2_048, 4_096   # rows of a block


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def _square_distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ codes.T) + (codes * codes).sum(1)[None, :], 0)


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    codes = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _square_distances(x, codes).argmin(1)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(codes)
        np.add.at(total, near, x)
        codes = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], codes)
    return codes


class Grid:
    """The two codebooks, and how far a query goes beyond its nearest cell."""

    def __init__(self, sample: np.ndarray, n: int, cosine: float, recall: float, seed: int):
        rng = np.random.default_rng(seed)
        k = int(max(1, min(len(sample) // 8, np.sqrt(n / PER_CELL))))
        self.half = max(1, sample.shape[1] // 2)
        parts = (sample[:, :self.half], sample[:, self.half:])
        self.codes = tuple(_codebook(p, min(k, len(np.unique(p, axis=0))), rng) for p in parts)
        # Neighbours at the threshold: turned by its angle in a random direction.
        turned = rng.standard_normal(sample.shape)
        turned -= (turned * sample).sum(1)[:, None] * sample
        size = np.linalg.norm(turned, axis=1)[:, None]
        near = cosine * sample + np.sqrt(1 - cosine * cosine) * turned / np.where(size > 0, size, 1)
        i, j = self.cell(near)
        self.gap = float(np.quantile(self.beyond(sample, i, j), recall))

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """To the codes of each half, over the nearest one's."""
        d = [_square_distances(p, c) for p, c in
             zip((x[:, :self.half], x[:, self.half:]), self.codes, strict=True)]
        return d[0] - d[0].min(1)[:, None], d[1] - d[1].min(1)[:, None]

    def cell(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.distances(x)
        return a.argmin(1), b.argmin(1)

    def beyond(self, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How far cells (i, j) are over the nearest cells of x."""
        a, b = self.distances(x)
        at = np.arange(len(x))
        return a[at, i] + b[at, j]

    def number(self, i, j):
        return i * len(self.codes[1]) + j

    def traversal(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Cells of one query, nearest first, while within the gap."""
        p, q = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        heap, found = [(0.0, 0, 0)], []
        while heap:
            d, i, j = heapq.heappop(heap)
            if d > self.gap:
                break
            found.append(int(self.number(p[i], q[j])))
            if i + 1 < len(p) and j == 0:  # each cell has one predecessor
                heapq.heappush(heap, (float(a[p[i + 1]] + b[q[0]]), i + 1, 0))
            if j + 1 < len(q):
                heapq.heappush(heap, (float(a[p[i]] + b[q[j + 1]]), i, j + 1))
        return found


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dims)


def _links(classes: DataFrame, dims: int, cosine: float, recall: float, seed: int) -> DataFrame:
    """``key, n, other``: counts of links by class, and edges that connect linked classes
    (n null). ``classes``: ``key, m, v``, a stored table of vectors of one length."""
    n = classes.count()
    picked = classes.orderBy(F.xxhash64("key", F.lit(seed)), "key").limit(SAMPLE).select("v").toArrow()
    grid = Grid(_unit(_matrix(picked["v"].combine_chunks(), dims)), n, cosine, recall, seed)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _unit(_matrix(b.column(1), dims))
            for lo in range(0, len(x), 1024):
                a, c = grid.distances(x[lo:lo + 1024])
                rows, cells, home = [], [], []
                for i, (p, q) in enumerate(zip(a, c, strict=True)):
                    own, *others = grid.traversal(p, q)
                    seen = [own, *(y for y in others if y > own)]
                    rows += [lo + i] * len(seen)
                    cells += seen
                    home += [True] + [False] * (len(seen) - 1)
                yield pa.record_batch([pa.array(cells, pa.int64()), pa.array(home, pa.bool_()),
                                       b.column(0).take(pa.array(rows, pa.int64()))], names=["cell", "home", "key"])

    kind = classes.schema["v"].dataType.simpleString()
    visits = stored(classes.select("key", "v").mapInArrow(probes, "cell long, home boolean, key long"), "embedding-visits")
    size = visits.groupBy("cell").agg(
        F.ceil(F.count_if("home") / MEMBERS).cast("int").alias("mb"),
        F.ceil(F.count("*") / QUERIES).cast("int").alias("qb"))
    size = stored(size.where("mb > 0").withColumnRenamed("cell", "_cell"), "embedding-cells")
    h = F.xxhash64("key", F.lit(seed))
    rows = visits.join(size, F.col("cell") == F.col("_cell"))
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    members = rows.where("home").select(
        "cell", F.pmod(h, F.col("mb")).cast("int").alias("x"), F.explode(upto("qb")).alias("y"),
        F.lit(True).alias("member"), "home", "key")
    queries = rows.select("cell", F.explode(upto("mb")).alias("x"), F.pmod(h, F.col("qb")).cast("int").alias("y"),
                          F.lit(False).alias("member"), "home", "key")
    vectors = classes.select(F.col("key").alias("_key"), "m", "v")
    blocks = members.union(queries).join(vectors, F.col("key") == F.col("_key")).drop("_key")

    def verify(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        flags = [np.asarray(t[c].combine_chunks().to_numpy(zero_copy_only=False)) for c in ("member", "home")]
        key, m = np.asarray(t["key"]), np.asarray(t["m"])
        raw = _matrix(t["v"].combine_chunks(), dims)
        norm = np.linalg.norm(raw, axis=1)
        left, right = np.flatnonzero(~flags[0]), np.flatnonzero(flags[0])
        pairs = []
        for lo in range(0, len(left), 512):
            q = left[lo:lo + 512]
            near = (raw[q] @ raw[right].T) / (norm[q][:, None] * norm[right][None, :]) >= cosine
            # of two members the one of the smaller key asks; visitors ask all
            near &= ~flags[1][q][:, None] | (key[q][:, None] < key[right][None, :])
            i, j = np.nonzero(near)
            pairs.append((q[i].astype(np.int32), right[j].astype(np.int32)))
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (zip(*pairs, strict=True) if pairs else ([], [])))
        count = np.bincount(i, weights=m[j], minlength=len(key)) + np.bincount(j, weights=m[i], minlength=len(key))
        linked = np.flatnonzero(count)
        low = _lowest(key, i, j)
        star = linked[low[linked] != key[linked]]
        return pa.table({
            "key": pa.array(np.concatenate((key[linked], key[star]))),
            "n": pa.array(count[linked].astype(np.int64).tolist() + [None] * len(star), pa.int64()),
            "other": pa.array([None] * len(linked) + low[star].tolist(), pa.int64())})

    return blocks.select("cell", "x", "y", "member", "home", "key", "m", "v").groupBy("cell", "x", "y").applyInArrow(
        verify, "key long, n long, other long")


def _lowest(key: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest key that links (i, j) lead to, of every row; a key may have two rows."""
    _, node = np.unique(key, return_inverse=True)
    low = np.sort(np.unique(key))
    label = np.arange(len(low))
    i, j = node[i], node[j]
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            return low[label][node]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    cosine: float = 0.9, recall: float = 0.995, seed: int = 11) -> DataFrame:
    """One row per vector: its id, ``n_links``, ``component_id`` and ``kept``."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    classes = rows.where("good").groupBy("v").agg(F.min("id").alias("low"), F.count("*").alias("m"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("key"), "low", "m", "v",
                                    F.size("v").alias("dims")), "embedding-classes")
    lengths = [r[0] for r in classes.select("dims").distinct().collect()]
    found = None
    for d in lengths:  # in practice one
        part = _links(stored(classes.where(F.col("dims") == d), "embedding-classes"), d, cosine, recall, seed)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = stored(found, "embedding-links")
    counts = found.where("n IS NOT NULL").groupBy(F.col("key").alias("_k")).agg(F.sum("n").alias("n"))
    comps = connected_components(found.where("n IS NULL").select("key", "other"))
    named = classes.join(counts, F.col("key") == F.col("_k"), "left").join(comps, F.col("key") == F.col("node"), "left")
    named = named.where("m > 1 OR n IS NOT NULL").withColumn("comp", F.coalesce("component", "key"))
    low = named.groupBy(F.col("comp").alias("_comp")).agg(F.min("low").alias("component_id"))
    linked = stored(named.join(low, F.col("comp") == F.col("_comp")).select(
        F.col("v").alias("_v"), (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id",
        F.lit(True).alias("_linked")), "embedding-named")
    out = rows.join(linked, F.col("good") & (F.col("v") == F.col("_v")), "left")
    component = F.when(F.col("_linked"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
