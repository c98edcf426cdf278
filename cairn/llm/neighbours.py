"""Nearest neighbours by an inverted multi-index: two halves of a vector are quantised apart, and cells are pairs of centroids.

Nearness is the inner product.  What a cell promises a query is a sum of two numbers, one for each half: the
inner product of the query's half with the centroid, and SPREAD times its standard deviation over the
vectors that the centroid stands for.  A heap gives the pairs of centroids in falling order of these sums.
Each query first visits pairs until they hold FIRST vectors; the WANTED-th best of these, by inner product,
is its mark.  Then it goes on down the heap as long as a pair promises the mark; what scores less than the mark leaves no row.  So the way ends early where
neighbours stand out, and goes far where all vectors are alike; nothing is cut at a number of cells.

Cells are kept in bins of about BIN vectors; larger cells are split over several bins.  Queries meet bins in chunks of at most
CHUNK, and each meeting leaves WANTED rows a query.  Centroids are fitted to at most MAX_SAMPLE vectors (the
first by a hash of vec_id), every vector is indexed.  Their number grows with the table up to MAX_CENTROIDS a half.

Equal vectors are one entry: of its ids the WANTED + 1 smallest are enough for any query, as ties go to the smaller id.
Vectors that are null, zero, hold a null or a number that is not finite, or whose length is not the most common one (the
smaller at ties), take no part, nor do rows without vec_id.  Of rows that repeat a vec_id the least vector counts.
Other columns are not read, whatever their names.  An empty table, or one without queries, gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import Scratch

WANTED = 20
EVERY = 20
SPREAD = 2.3
FIRST = 512
BIN = 4096
CHUNK = 2048
#: queries compared at once, and what a matrix product may be off by
SLICE = 32
ROUNDING = 1e-9
MAX_SAMPLE = 32_768
MAX_CENTROIDS = 512
CELL = 16
ROUNDS = 10
SEED = 12


def usable(vectors: DataFrame) -> DataFrame:
    """(id, v): the vectors that take part, as doubles."""
    v = F.col("embedding").cast("array<double>")
    sound = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").alias("id"), v.alias("v")).filter(sound & F.col("id").isNotNull())
    size = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    return rows.filter(F.size("v") == (size["size"] if size else 0)).groupBy("id").agg(F.min("v").alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


class Codebook:
    """Centroids of one half of the dimensions, and how far the vectors of each lie from it."""

    def __init__(self, sample: np.ndarray, k: int, rng: np.random.Generator):
        distinct = np.unique(sample, axis=0)
        self.centroids = distinct[rng.permutation(len(distinct))[:k]].copy()
        for _ in range(ROUNDS):
            nearest = self.assign(sample)
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, nearest, sample)
            n = np.bincount(nearest, minlength=len(sums))
            self.centroids[n > 0] = sums[n > 0] / n[n > 0, None]
        gap = ((sample - self.centroids[self.assign(sample)]) ** 2).sum(axis=1)
        nearest = self.assign(sample)
        n = np.bincount(nearest, minlength=k)[: len(self.centroids)]
        mean = np.bincount(nearest, weights=gap, minlength=k)[: len(self.centroids)] / np.maximum(n, 1)
        # a centroid with few vectors of the sample does not tell how far others may lie
        self.spread = np.sqrt((mean * n + gap.mean() * 4) / (n + 4) / sample.shape[1])

    def assign(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), np.int64)
        norms = (self.centroids**2).sum(axis=1)
        for at in range(0, len(x), 8192):
            out[at : at + 8192] = np.argmin(norms - 2 * x[at : at + 8192] @ self.centroids.T, axis=1)
        return out

    def promise(self, queries: np.ndarray) -> np.ndarray:
        return queries @ self.centroids.T + SPREAD * np.linalg.norm(queries, axis=1)[:, None] * self.spread


class Index:
    """The two codebooks, and how many entries each cell has: all that tasks are sent, of bounded size."""

    def __init__(self, sample: np.ndarray, n: int):
        k = int(np.clip(round((n / CELL) ** 0.5), 1, MAX_CENTROIDS))
        rng = np.random.default_rng(SEED)
        self.cut = (sample.shape[1] + 1) // 2
        self.halves = [Codebook(x, k, rng) for x in (sample[:, : self.cut], sample[:, self.cut :]) if x.shape[1]]
        self.width = len(self.halves[1].centroids) if len(self.halves) > 1 else 1
        self.n_cells = len(self.halves[0].centroids) * self.width

    def cells(self, x: np.ndarray) -> np.ndarray:
        first = self.halves[0].assign(x[:, : self.cut]) * self.width
        return first + self.halves[1].assign(x[:, self.cut :]) if len(self.halves) > 1 else first

    def count(self, counts: np.ndarray) -> None:
        """Take the numbers of entries; deal cells to bins in order, and a large cell to several bins of its own."""
        self.counts = counts
        self.blocks = np.maximum(1, -(-counts // BIN))
        self.bins = np.cumsum(np.where(self.blocks > 1, 0, counts)) // BIN
        large = np.flatnonzero(self.blocks > 1)
        self.bins[large] = self.bins.max(initial=0) + 1 + np.concatenate(([0], np.cumsum(self.blocks[large])[:-1])).astype(np.int64)

    def promises(self, queries: np.ndarray) -> list[np.ndarray]:
        out = [self.halves[0].promise(queries[:, : self.cut])]
        return [*out, self.halves[1].promise(queries[:, self.cut :]) if len(self.halves) > 1 else np.zeros((len(queries), 1))]


def traverse(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) of all pairs by falling sum: a pair enters the heap when the pairs before it in both orders have left."""
    i_order, j_order = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    a, b = first[i_order].tolist(), second[j_order].tolist()
    reached = [0] * len(a)  # of each row, how many pairs have left
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        down, i, j = heapq.heappop(heap)
        yield -down, i_order[i], j_order[j]
        reached[i] = j + 1
        if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (-(a[i + 1] + b[j]), i + 1, j))


def probes(index: Index, first: np.ndarray, second: np.ndarray, mark: float | None) -> list[int]:
    """Cells that a query visits: without a mark those of the first turn, with one those of the second."""
    held, out = 0, []
    for promise, i, j in traverse(first, second):
        cell = i * index.width + j
        if held < FIRST:
            held += int(index.counts[cell])
            if mark is None and index.counts[cell]:
                out.append(cell)
        elif mark is None or promise < mark:
            break
        elif index.counts[cell]:
            out.append(cell)
    return out


def _probe_rows(queries: DataFrame, index: Index) -> DataFrame:
    """(bin, id, v, mark, cells): each bin that a query (id, v, mark) visits, with the cells that it visits there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            first, second = index.promises(_matrix(batch.column(1)))
            at, bins, cells = [], [], []
            for r, mark in enumerate(batch.column(2).to_pylist()):
                by_bin: dict[int, list[int]] = {}
                for cell in probes(index, first[r], second[r], mark):
                    for part in range(int(index.blocks[cell])):
                        by_bin.setdefault(int(index.bins[cell]) + part, []).append(cell)
                at += [r] * len(by_bin)
                bins += by_bin.keys()
                cells += by_bin.values()
            where = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.int64()), batch.column(0).take(where), batch.column(1).take(where), batch.column(2).take(where), pa.array(cells, pa.list_(pa.int32()))], ["bin", "id", "v", "mark", "cells"])

    return queries.select("id", "v", "mark").mapInArrow(run, "bin long, id long, v array<double>, mark double, cells array<int>")


def _entry_rows(groups: DataFrame, index: Index) -> DataFrame:
    """(bin, cell, ids, v): each entry (ids, v) in its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = index.cells(_matrix(batch.column(1)))
                lead = pc.list_element(batch.column(0), 0).to_numpy(zero_copy_only=False)
                part = (lead.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % index.blocks[cell]
                yield pa.RecordBatch.from_arrays([pa.array(index.bins[cell] + part), pa.array(cell.astype(np.int32)), batch.column(0), batch.column(1)], ["bin", "cell", "ids", "v"])

    return groups.select("ids", "v").mapInArrow(run, "bin long, cell int, ids array<long>, v array<double>")


def meet(queries: pa.Table, entries: pa.Table) -> pa.Table:
    """The WANTED nearest entries of each query among those of one bin, in the cells that it visits, if they score its mark."""
    names = ["query_id", "vec_id", "score"]
    empty = pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names)
    if not queries.num_rows or not entries.num_rows:
        return empty
    q, x = _matrix(queries["v"]), _matrix(entries["v"])
    cell, place = np.unique(entries["cell"].to_numpy(), return_inverse=True)
    ids = entries["ids"].combine_chunks()
    flat, offsets = ids.flatten().to_numpy(), ids.offsets.to_numpy() - ids.offsets[0].as_py()
    visited = queries["cells"].combine_chunks()
    owner = np.repeat(np.arange(len(q)), np.diff(visited.offsets.to_numpy()))
    seen = np.zeros((len(q), len(cell)), bool)
    of = np.searchsorted(cell, visited.flatten().to_numpy())
    held = of < len(cell)
    held[held] = cell[of[held]] == visited.flatten().to_numpy()[held]
    seen[owner[held], of[held]] = True
    mark = queries["mark"].to_numpy()
    mark = np.where(np.isnan(mark), -np.inf, mark)
    out: list[list[np.ndarray]] = [[], [], []]
    nth = max(0, len(x) - WANTED - 1)  # one more than wanted, as one may be the query itself
    for at in range(0, len(q), SLICE):
        near = np.where(seen[at : at + SLICE][:, place], q[at : at + SLICE] @ x.T, -np.inf)
        bar = np.maximum(np.partition(near, nth, axis=1)[:, nth : nth + 1], mark[at : at + SLICE, None])
        slack = ROUNDING * (1 + np.where(np.isfinite(bar), np.abs(bar), 0))
        row, e = np.nonzero((near >= bar - slack) & (near > -np.inf))
        # the matrix product only preselects: here every pair is summed alike, and ties are ties
        score = (q[at + row] * x[e]).sum(axis=1)
        n = np.diff(offsets)[e]
        row, score = np.repeat(row, n), np.repeat(score, n)
        vec = flat[np.repeat(offsets[e] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
        own = queries["id"].to_numpy()[at + row]
        other = (vec != own) & (score >= mark[at + row])
        row, score, vec, own = row[other], score[other], vec[other], own[other]
        order = np.lexsort((vec, -score, row))
        row = row[order]
        begins = np.searchsorted(row, row)
        order = order[np.arange(len(row)) - begins < WANTED]
        for k, column in enumerate((own, vec, score)):
            out[k].append(column[order])
    return pa.table([pa.array(np.concatenate(c)) for c in out], names)


def _visit(queries: DataFrame, entries: DataFrame, index: Index, scratch: Scratch, name: str) -> DataFrame:
    """(query_id, vec_id, score): the nearest of each bin that the queries visit."""
    rows = scratch.save(_probe_rows(queries, index), f"{name}-probes")
    chunks = scratch.save(rows.groupBy("bin").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), f"{name}-chunks")
    left = rows.join(chunks, "bin").withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks").cast("int")).select("bin", "chunk", "id", "v", "mark", "cells")
    right = entries.join(chunks, "bin").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("bin", "chunk", "cell", "ids", "v")
    met = left.groupBy("bin", "chunk").cogroup(right.groupBy("bin", "chunk")).applyInArrow(meet, "query_id long, vec_id long, score double")
    return scratch.save(met, f"{name}-met")


def _best(met: DataFrame) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= WANTED)


def search(vectors: DataFrame, is_query) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of each vector whose id `is_query` (a condition on "id") takes."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    rows = scratch.save(usable(vectors), "vectors")
    # equal vectors have one hash; the window drops all but the smallest ids before the shuffle
    place = F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))
    kept = rows.withColumn("h", F.xxhash64("v")).withColumn("place", place).filter(F.col("place") <= WANTED + 1)
    groups = scratch.save(kept.groupBy("h", "v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "groups")
    n = groups.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = groups.orderBy(F.xxhash64(F.get("ids", 0)), F.get("ids", 0)).limit(MAX_SAMPLE).select("v").toArrow()
    index = Index(_matrix(sample["v"]), n)
    codes = index
    of_batches = lambda batches: (pa.RecordBatch.from_arrays([pa.array(index.cells(_matrix(b.column(0))))], ["cell"]) for b in batches if b.num_rows)
    counts = np.zeros(index.n_cells, np.int64)
    for r in groups.select("v").mapInArrow(of_batches, "cell long").groupBy("cell").count().collect():
        counts[r["cell"]] = r["count"]
    index.count(counts)
    entries = scratch.save(_entry_rows(groups, index), "entries")
    queries = rows.filter(is_query)
    near = _visit(queries.withColumn("mark", F.lit(None).cast("double")), entries, index, scratch, "first")
    marks = _best(near).groupBy("query_id").agg(F.when(F.count("*") >= WANTED, F.min("score")).otherwise(F.lit(float("-inf"))).alias("mark"))
    again = queries.join(marks, F.col("id") == F.col("query_id"), "left").select("id", "v", F.coalesce("mark", F.lit(float("-inf"))).alias("mark"))
    far = _visit(scratch.save(again, "marked"), entries, index, scratch, "second")
    return _best(near.unionByName(far)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op12_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % EVERY == 0)
