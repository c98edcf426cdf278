r"""Exact removal of repeated 100-byte strings with a logarithmic index family (operator 2).

The index holds a sparse suffix array: only suffixes at anchors are entered, the positions whose
GRAM-byte hash is least in some LENGTH-byte window (the leftmost if several are).  Equal windows
have equal anchors, so no match is lost.  An anchor's entry is (g, c): the hash of its first GRAM
bytes, and the hash of its context, all bytes of the windows that it is the anchor of.  Entries are
ordered by these hashes; all a scan needs is that equal prefixes lie together.

Documents come in batches by doc_id.  A batch gets its array, is merge-scanned against the levels of
the family for equal contexts, and what is new becomes a level of size 1; equal-sized levels merge,
so n batches leave at most log2(n) + 1 levels.  All earlier documents are in the levels, so a context
found there, or earlier in its batch, repeats in every window.

Contexts that share an anchor but differ may still share windows, at the ends of a match.  These few
are cut into pieces of PIECE starts, by distance from the anchor, and go through the same once more:
a piece's core, the bytes that all its windows hold, in place of the anchor, and all its bytes in
place of the context.  Only where pieces of one core differ are the windows themselves compared.

All keys are 128 bits of hash, spread evenly whatever the text; a passage that a third of all
documents hold meets in partial aggregations and in joins that adaptive execution can split.

Defined results: texts are UTF-8 bytes, null is empty; texts under 100 bytes lose nothing.  Rows are
told apart by doc_id and text: repeated rows are one document and get the same result; a null
doc_id is the smallest.  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytekit import U, Prefix, blocks, mix
from .scratch import Scratch

LENGTH, GRAM, BATCHES = 100, 24, 4
WINDOWS = LENGTH - GRAM + 1
PIECE = 8


def anchors(block) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor: document, first start `lo` in it, count `n`, and the hashes g and c."""
    buf, total = block.buf, len(block.buf)
    m = total - LENGTH + 1
    if m <= 0:
        return {k: np.zeros(0, U if k in "gc" else np.int64) for k in ("doc", "lo", "n", "g", "c")}
    first, second = Prefix(buf, 0), Prefix(buf, 1)
    at = np.arange(total - GRAM + 1)
    h = first(at, at + GRAM)
    rows = np.concatenate((h, np.full((-len(h)) % WINDOWS, ~U(0)))).reshape(-1, WINDOWS)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[:m], ahead[WINDOWS - 1 : WINDOWS - 1 + m])
    doc = block.doc_of(at[:m])
    starts = np.flatnonzero(block.offs[doc + 1] - at[:m] >= LENGTH)
    if not len(starts):
        return {k: np.zeros(0, U if k in "gc" else np.int64) for k in ("doc", "lo", "n", "g", "c")}
    value, d = least[starts], doc[starts]
    # a new run: another least hash, another document, or the anchor was the window's first byte
    new = np.ones(len(starts), bool)
    new[1:] = (value[1:] != value[:-1]) | (d[1:] != d[:-1]) | (starts[1:] != starts[:-1] + 1) | (h[starts[:-1]] == value[:-1])
    i = np.flatnonzero(new)
    lo = starts[i]
    n = np.diff(np.append(i, len(starts)))
    return {"doc": d[i], "lo": lo - block.offs[d[i]], "n": n, "g": value[i], "c": second(lo, lo + n + LENGTH - 1)}


def _key():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    """(k, t, text): `t` tells apart documents of one doc_id; it is 0, which costs no space, if no doc_id repeats."""
    ids = docs.groupBy(_key().alias("k")).count().filter("count > 1")
    t = F.xxhash64("text") if ids.limit(1).count() else F.lit(0).cast("long")
    return docs.select(*more, _key().alias("k"), t.alias("t"), F.col("text").cast("string").alias("text"))


def entries(keyed: DataFrame) -> DataFrame:
    """(k, t, lo, n, g, c) of every anchor."""
    names = ["lo", "n", "g", "c"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                got = anchors(block)
                index = pa.array(got["doc"] + block.first)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(1).take(index), *(pa.array(got[x].view(np.int64)) for x in names)], ["k", "t", *names])

    return keyed.mapInArrow(run, "k long, t long, lo long, n long, g long, c long")


class IndexFamily:
    """Levels of sorted entries (g, c, k, t, lo, n); each context once, at its first place."""

    def __init__(self, scratch: Scratch):
        self.scratch = scratch
        self.levels: list[tuple[int, DataFrame]] = []

    def all(self) -> DataFrame:
        out = self.levels[0][1]
        for _, level in self.levels[1:]:
            out = out.unionByName(level)
        return out

    def add(self, batch: DataFrame) -> DataFrame:
        """Enter a batch of documents, later than all before; the runs (k, t, lo, n) of its windows that repeat."""
        own = self.scratch.save(entries(batch), "entries")
        place = F.struct("k", "t", "lo")
        array = own.groupBy("g", "c").agg(F.min(place).alias("m"), F.max(place).alias("last"), F.first("n").alias("n"))
        if self.levels:
            array = array.join(self.all().select("g", "c", F.lit(True).alias("old")), ["g", "c"], "left")
        else:
            array = array.withColumn("old", F.lit(None).cast("boolean"))
        array = self.scratch.save(array.select("g", "c", "n", "m", (F.col("m") != F.col("last")).alias("twice"), F.coalesce("old", F.lit(False)).alias("old")), "array")
        recurring = array.filter("old or twice").select("g", "c", "m", "old")
        found = own.join(recurring, ["g", "c"]).filter(F.col("old") | (place != F.col("m"))).select("k", "t", "lo", "n")
        found = self.scratch.save(found, "found")
        fresh = array.filter("not old").select("g", "c", F.col("m.k").alias("k"), F.col("m.t").alias("t"), F.col("m.lo").alias("lo"), "n")
        self._push(1, self.scratch.save(fresh.sortWithinPartitions("g", "c"), "level"))
        self.scratch.drop(own, array)
        return found

    def _push(self, size: int, level: DataFrame) -> None:
        while self.levels and self.levels[-1][0] == size:
            _, other = self.levels.pop()
            merged = self.scratch.save(other.unionByName(level).sortWithinPartitions("g", "c"), "level")
            self.scratch.drop(other, level)
            size, level = 2 * size, merged
        self.levels.append((size, level))

    def disputed(self) -> DataFrame:
        """(k, t, lo, n) of the contexts whose anchor has others too."""
        index = self.all()
        shared = index.groupBy("g").agg(F.count("*").alias("f")).filter("f > 1").select("g")
        return index.join(shared, "g", "left_semi").select("k", "t", "lo", "n")


def _listed(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Blocks of (k, t, text, los, ns), with the rows' index in the batch, first byte and starts of each listed run."""
    for block in blocks(batch.column(2)):
        lists = [batch.column(i).slice(block.first, block.n) for i in (3, 4)]
        doc = np.repeat(np.arange(block.n), lists[0].value_lengths().to_numpy())
        lo, n = (x.flatten().to_numpy() for x in lists)
        yield block, doc, block.offs[doc], lo + block.offs[doc], n


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, t, lo, n, g, c) of the pieces of each listed context: g hashes the core, c all bytes."""
    for batch in batches:
        for block, doc, base, lo, n in _listed(batch):
            first, second = Prefix(block.buf, 0), Prefix(block.buf, 1)
            anchor = np.zeros(len(lo), np.int64)
            step = np.arange(WINDOWS)
            for i in range(0, len(lo), 1024):
                part = slice(i, i + 1024)
                at = lo[part, None] + step
                h = first(at, at + GRAM)
                # the leftmost least gram that all windows of the context hold
                h[step < n[part, None] - 1] = ~U(0)
                anchor[part] = lo[part] + h.argmin(1)
            low, high = (anchor - lo - n + 1) // PIECE, (anchor - lo) // PIECE
            each = np.repeat(np.arange(len(lo)), high - low + 1)
            q = low[each] + np.arange(len(each)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
            last = anchor[each] - PIECE * q
            start, end = np.maximum(lo[each], last - PIECE + 1), np.minimum((lo + n)[each], last + 1)
            g = mix(first(last, last - PIECE + 1 + LENGTH) + q.astype(U))
            c = second(start, end + LENGTH - 1)
            rows = pa.array(doc[each] + block.first)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(start - base[each]), pa.array(end - start), pa.array(g.view(np.int64)), pa.array(c.view(np.int64))], ["k", "t", "lo", "n", "g", "c"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, t, lo, w0, w1): two hashes of each window of the listed pieces."""
    for batch in batches:
        for block, doc, base, lo, n in _listed(batch):
            each = np.repeat(np.arange(len(lo)), n)
            start = lo[each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            hashes = [pa.array(Prefix(block.buf, i)(start, start + LENGTH).view(np.int64)) for i in range(2)]
            rows = pa.array(doc[each] + block.first)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(start - base[each]), *hashes], ["k", "t", "lo", "w0", "w1"])


def _with_text(runs: DataFrame, keyed: DataFrame) -> DataFrame:
    """(k, t, text, los, ns) of the documents that have runs."""
    lists = runs.groupBy("k", "t").agg(F.collect_list(F.struct("lo", "n")).alias("r"))
    lists = lists.select("k", "t", F.col("r.lo").alias("los"), F.col("r.n").alias("ns"))
    return keyed.join(lists, ["k", "t"]).dropDuplicates(["k", "t"]).select("k", "t", "text", "los", "ns")


def repeated_runs(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(k, t, runs): of each document (k, t) the runs {lo, n} of window starts whose window starts earlier too."""
    scratch = Scratch(docs.sparkSession, "substrings")
    keyed = _keyed(docs)
    cuts = keyed.agg(F.percentile_approx("k", [i / batches for i in range(1, batches)], 10_000)).first()[0] or []
    family, found = IndexFamily(scratch), []
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = keyed if low is None else keyed.filter(F.col("k") > low)
        found.append(family.add(part if high is None else part.filter(F.col("k") <= high)))

    place = F.struct("k", "t", "lo")
    texts = _with_text(family.disputed(), keyed)
    pieces = scratch.save(texts.mapInArrow(_pieces, "k long, t long, lo long, n long, g long, c long"), "pieces")
    scratch.drop(*(level for _, level in family.levels))
    kinds = scratch.save(pieces.groupBy("g", "c").agg(F.min(place).alias("m"), F.first("n").alias("n"), F.count("*").alias("f")), "kinds")
    found.append(pieces.join(kinds.filter("f > 1").select("g", "c", "m"), ["g", "c"]).filter(place != F.col("m")).select("k", "t", "lo", "n"))
    several = kinds.groupBy("g").agg(F.count("*").alias("f")).filter("f > 1").select("g")
    open_ = kinds.join(several, "g", "left_semi").select("m.*", "n")
    windows = scratch.save(_with_text(open_, keyed).mapInArrow(_windows, "k long, t long, lo long, w0 long, w1 long"), "windows")
    first = windows.groupBy("w0", "w1").agg(F.min(place).alias("m"), F.count("*").alias("f")).filter("f > 1").select("w0", "w1", "m")
    late = windows.join(first, ["w0", "w1"]).filter(place != F.col("m")).select("k", "t", "lo", F.lit(1).cast("long").alias("n"))
    for more in found:
        late = late.unionByName(more)
    runs = late.groupBy("k", "t").agg(F.collect_list(F.struct("lo", "n")).alias("runs"))
    return scratch.save(runs.select("k", "t", F.expr("transform(runs, r -> r.lo)").alias("los"), F.expr("transform(runs, r -> r.n)").alias("ns")), "runs")


def _covered(size: int, los, ns) -> np.ndarray:
    """Which bytes the windows that start in the runs cover."""
    step = np.zeros(size + 1, np.int64)
    if los is not None:
        lo, n = np.array(los, np.int64), np.array(ns, np.int64)
        np.add.at(step, lo, 1)
        np.add.at(step, np.minimum(lo + n + LENGTH - 1, size), -1)
    return np.cumsum(step[:-1]) > 0


def remove_repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that stay) of each row."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    runs = repeated_runs(docs, batches)
    src = _keyed(docs, "doc_id").join(runs, ["k", "t"], "left").select("doc_id", "text", "los", "ns")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for row in range(0, whole.num_rows, 512):
                batch = whole.slice(row, 512)
                out: list[list] = [[] for _ in names[1:]]
                for text, los, ns in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    gone, kept = 0, raw
                    spans = 0
                    if los is not None:
                        mask = _covered(len(raw), los, ns)
                        gone, spans = int(mask.sum()), int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(mask[0])
                        kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
                    for x, y in zip(out, (len(raw), gone, spans, hashlib.sha256(kept).hexdigest(), kept), strict=True):
                        x.append(y)
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, ty) for x, ty in zip(out, types, strict=True))], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op2_index_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, doc_id AS r, encode(coalesce(text, '')) AS b FROM documents),
p AS (SELECT doc_id, r, octet_length(b) AS n, unnest(range(0, octet_length(b)::BIGINT)) AS i, b FROM d),
w AS (SELECT doc_id, r, n, i, CASE WHEN i + 100 <= n THEN array_slice(b, i + 1, i + 100) END AS s, array_slice(b, i + 1, i + 1) AS x FROM p),
m AS (SELECT doc_id, r, i, x, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS again FROM w),
c AS (SELECT doc_id, r, i, x, max(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM m),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), false) AS begins FROM c),
t AS (SELECT r, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans, string_agg(CASE WHEN gone THEN '' ELSE hex(x) END, '' ORDER BY i) AS h FROM e GROUP BY r)
SELECT d.doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(h, ''))) AS kept_sha256 FROM d LEFT JOIN t ON t.r = d.r
"""
