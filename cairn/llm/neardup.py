r"""MinHash near-duplicates with tensored banding (operator 9).

Two small collections of band hashes are computed per document, `SIDE` each of `ROWS` minimums.
A table key is a pair, one hash of either collection, so SIDE * SIDE tables of 2 * ROWS rows cost
only 2 * SIDE * ROWS minimums instead of 2 * ROWS * SIDE**2.  With SIDE 10 and ROWS 2, a pair of
similarity 0.75 shares a key with probability 0.9995, one of 0.8 with 0.99993.

1. Documents with equal shingle sets form a class; only its smallest doc_id goes on.
2. Each key's members are compared with its smallest member: linear in the members, so a key that
   a third of all rows share makes no pairs among them.  Links are confirmed on full shingle sets.
3. Keys whose members are not yet one component are taken up again: an exact prefix join over the
   rarest quarter of their members' shingles finds every remaining link between components.

Defined results: words are `[^\x20\x09-\x0D]+` of the text with A-Z lowered.  Null, empty and
blank texts have no shingle and no link.  A text of 1 to 4 words is one shingle.  Rows that repeat
a doc_id count as one document, that with the larger set of shingles; the result has one row per
distinct doc_id, and `keep_one` keeps or drops its rows together.  Rows without a doc_id are never
linked.  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bytekit import LOWER, SPACE, U, Prefix, blocks, mix, ngrams, repeats, stream
from .columns import foreign_names_kept
from .graph import components
from .scratch import Scratch
from .sieve import bit_map, may_be_in, without

SHINGLE, NUMERATOR, DENOMINATOR = 5, 75, 100
SIDE, ROWS = 10, 2
_MULTIPLIERS, _SHIFTS = stream(21, 2 * SIDE * ROWS) | U(1), stream(22, 2 * SIDE * ROWS)


def shingles(block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, and the document of each."""
    starts, ends, docs = block.spans(~SPACE[block.buf])
    words = Prefix(LOWER[block.buf])(starts, ends)
    h, at = ngrams(words, docs, SHINGLE)
    d = docs[at]
    count = np.bincount(docs, minlength=block.n)
    firsts = np.searchsorted(docs, np.arange(block.n))
    for n in range(1, SHINGLE):
        few = firsts[count == n]
        if len(few):
            value = np.zeros(len(few), U)
            for k in range(n):
                value = mix(value + words[few + k] + U(k))
            h, d = np.concatenate((h, mix(value + U(n)))), np.concatenate((d, docs[few]))
    later, _ = repeats(h, d)
    h, d = h[~later], d[~later]
    order = np.argsort(d, kind="stable")
    return h[order], d[order]


def digests(h: np.ndarray, d: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and digests (two words) of the sets of so many documents."""
    n = np.bincount(d, minlength=docs)
    some, out = np.flatnonzero(n), np.zeros((docs, 2), U)
    if len(some):
        at = np.searchsorted(d, some)
        out[some, 0], out[some, 1] = np.add.reduceat(mix(h), at), np.add.reduceat(mix(h ^ U(0x5851F42D4C957F2D)), at)
    return n, out


def sketch_block(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set sizes, set digests (two words) and the 2 * SIDE band hashes of each document."""
    h, d = shingles(block)
    n, digest = digests(h, d, block.n)
    some, bands = np.flatnonzero(n), np.zeros((block.n, 2 * SIDE), U)
    if len(some):
        at = np.searchsorted(d, some)
        for j in range(2 * SIDE):
            value = np.full(len(some), j % SIDE, U)
            for r in range(ROWS):
                k = j * ROWS + r
                value = mix(value * U(0x9E3779B97F4A7C15) + np.minimum.reduceat(h * _MULTIPLIERS[k] + _SHIFTS[k], at))
            bands[some, j] = value
    return n, digest, bands


def _longs(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def _rows(docs: DataFrame, run, schema: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, d0, d1, a, b): set size, digest, and the two collections of band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for block in blocks(batch.column(1)):
                n, digest, bands = sketch_block(block)
                offs = pa.array(np.arange(block.n + 1, dtype=np.int32) * SIDE)
                sides = [pa.ListArray.from_arrays(offs, _longs(bands[:, i : i + SIDE].reshape(-1))) for i in (0, SIDE)]
                yield pa.RecordBatch.from_arrays([ids.slice(block.first, block.n), pa.array(n), _longs(digest[:, 0]), _longs(digest[:, 1]), *sides], ["doc_id", "n", "d0", "d1", "a", "b"])

    return _rows(docs, run, "doc_id long, n long, d0 long, d1 long, a array<long>, b array<long>")


def sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n, d0, d1, s): size and digest of each document's shingle set, and the sorted set, eight bytes a shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for block in blocks(batch.column(1)):
                h, d = shingles(block)
                ends = np.searchsorted(d, np.arange(block.n + 1))
                packed = [np.sort(h[ends[i] : ends[i + 1]]).tobytes() for i in range(block.n)]
                n, digest = digests(h, d, block.n)
                yield pa.RecordBatch.from_arrays([ids.slice(block.first, block.n), pa.array(n), _longs(digest[:, 0]), _longs(digest[:, 1]), pa.array(packed, pa.binary())], ["doc_id", "n", "d0", "d1", "s"])

    return _rows(docs, run, "doc_id long, n long, d0 long, d1 long, s binary")


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        keep = []
        for p, q in zip(x, y, strict=True):
            both = np.concatenate((np.frombuffer(p, U), np.frombuffer(q, U)))
            both.sort(kind="stable")
            inter = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(DENOMINATOR * inter >= NUMERATOR * (len(both) - inter))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keep, pa.bool_())], ["a", "b", "linked"])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = max(1, (1 << 17) // max(1, batch.num_rows and batch.column(3).nbytes // batch.num_rows // 8))
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            packed = part.column(3).to_pylist()
            index = pa.array(np.repeat(np.arange(len(packed)), [len(p) // 8 for p in packed]))
            yield pa.RecordBatch.from_arrays([*(part.column(i).take(index) for i in range(3)), pa.array(np.frombuffer(b"".join(packed), np.int64))], ["doc_id", "n", "c", "h"])


def _size_fits(m: str, n: str):
    """Sets of these sizes can reach the similarity at all."""
    return (DENOMINATOR * F.least(m, n) >= NUMERATOR * F.greatest(m, n)) & (F.least(m, n) > 0)


def _needed(m, n):
    """Shared shingles that sets of these sizes need."""
    return F.ceil((F.col(m) + F.col(n)) * NUMERATOR / (NUMERATOR + DENOMINATOR))


def _prefix_pairs(still: DataFrame, full: DataFrame) -> DataFrame:
    """Pairs of different components of `still` (doc_id, n, c) that may be linked; none that is linked is missing.

    Shingles are ranked from rare to frequent.  Linked sets share one among the first quarter of
    both, and the first that they share leaves enough behind it in both; so texts that share only
    what thousands share never meet.
    """
    occurrences = still.join(full, "doc_id").select("doc_id", "n", "c", "s").mapInArrow(_unpack, "doc_id long, n long, c long, h long")
    often = occurrences.groupBy("h").agg(F.count("*").alias("f")).filter("f > 1")
    ranked = Window.partitionBy("doc_id").orderBy("f", "h")
    seen = occurrences.join(often, "h").withColumn("own", F.col("n") - F.count("*").over(Window.partitionBy("doc_id")))
    seen = seen.withColumn("at", F.col("own") + F.row_number().over(ranked)).filter(f"{DENOMINATOR} * (at - 1) <= {DENOMINATOR - NUMERATOR} * n")
    x = seen.select("h", F.col("doc_id").alias("x"), F.col("n").alias("xn"), F.col("c").alias("xc"), F.col("at").alias("xi"))
    y = seen.select("h", F.col("doc_id").alias("y"), F.col("n").alias("yn"), F.col("c").alias("yc"), F.col("at").alias("yi"))
    fits = (x.h == y.h) & (F.col("xc") < F.col("yc")) & _size_fits("xn", "yn") & (1 + F.least(F.col("xn") - F.col("xi"), F.col("yn") - F.col("yi")) >= _needed("xn", "yn"))
    return x.join(y, fits).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each distinct doc_id of (doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "neardup")
    sketch = scratch.save(sketches(docs), "sketches")
    one = scratch.save(sketch.groupBy("doc_id").agg(F.max(F.struct("n", "d0", "d1")).alias("m")).select("doc_id", "m.*"), "one")
    classes = one.filter("n > 0 and doc_id is not null").groupBy("n", "d0", "d1").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = scratch.save(classes, "classes")
    # the rows of the smallest doc_id of each class; a group of copies never meets in one task
    own = [F.col(c).alias(f"r_{c}") for c in ("n", "d0", "d1")]
    some = sketch.join(classes.select(*own, "rep"), F.col("doc_id") == F.col("rep")).filter("n = r_n and d0 = r_d0 and d1 = r_d1").dropDuplicates(["doc_id"])
    reps = scratch.save(some.select("doc_id", "n", "a", "b"), "reps")
    half = reps.select("doc_id", "n", "b", F.posexplode("a").alias("i", "x"))
    keys = half.select("doc_id", "n", "i", "x", F.posexplode("b").alias("j", "y")).select("doc_id", "n", F.xxhash64("i", "j", "x", "y").alias("key"))

    least = keys.groupBy("key").agg(F.min(F.struct("doc_id", "n")).alias("m"), F.count("*").alias("c")).filter("c > 1")
    shared = scratch.save(keys.join(least.select("key", F.col("m.doc_id").alias("a"), F.col("m.n").alias("an")), "key"), "shared")
    star = shared.filter(F.col("doc_id") != F.col("a")).filter(_size_fits("n", "an")).select("a", F.col("doc_id").alias("b")).distinct()
    pairs = scratch.save(star, "pairs")
    members = shared.select("key", "doc_id", "n")

    # full sets of all that may ever be compared: members of shared keys
    bits = bit_map(shared.select(F.xxhash64("doc_id").alias("at")), "at")
    full = sets(docs.filter(may_be_in(bits, F.xxhash64(F.col("doc_id").cast("long")))))
    if sketch.count() > one.count():  # of several texts the larger set, as in `one`
        full = full.groupBy("doc_id").agg(F.max(F.struct("n", "d0", "d1", "s")).alias("m")).select("doc_id", "m.s")
    full = scratch.save(full.select("doc_id", "s"), "sets")

    def confirmed(candidates: DataFrame) -> DataFrame:
        left, right = full.select(F.col("doc_id").alias("a"), F.col("s").alias("p")), full.select(F.col("doc_id").alias("b"), F.col("s").alias("q"))
        both = candidates.join(left, "a").join(right, "b").select("a", "b", "p", "q")
        return scratch.save(both.mapInArrow(_confirm, "a long, b long, linked boolean"), "links")

    scratch.drop(sketch, reps)
    links = confirmed(pairs).filter("linked").select("a", "b")
    labels = components(links, scratch)
    known = members.join(labels, members.doc_id == labels.v, "left").select("key", "doc_id", "n", F.coalesce("c", "doc_id").alias("c"))
    mixed = known.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 <> c1").select("key")
    still = scratch.save(known.join(mixed, "key", "left_semi").select("doc_id", "n", "c").distinct(), "open")
    more = scratch.save(_prefix_pairs(still, full).join(pairs, ["a", "b"], "left_anti"), "pairs")
    found = confirmed(more).filter("linked").select("a", "b")
    if found.limit(1).count():
        labels = components(links.union(found), scratch)
    placed = scratch.save(classes.join(labels, classes.rep == labels.v, "left").select("n", "d0", "d1", "copies", F.coalesce("c", "rep").alias("c")), "placed")
    # classes that hold a thousandth of the documents or more are a thousand at most: only the others are dealt out
    same, limit = ["n", "d0", "d1"], one.count() / 1000
    hot = F.broadcast(placed.filter(F.col("copies") >= limit).select(*same, "c"))
    cold = placed.filter(F.col("copies") < limit).select(*same, "c")
    every = one.join(hot, same).unionByName(one.join(hot, same, "left_anti").join(cold, same, "left"))
    return every.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id")).alias("component_id"))


def op9_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


@foreign_names_kept
def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without all but the smallest doc_id of each near-duplicate component."""
    scratch = Scratch(docs.sparkSession, "kept")
    gone = scratch.save(near_duplicates(docs).filter("doc_id <> component_id").select("doc_id"), "gone")
    return without(docs, gone, "doc_id")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, array_to_string(ws[i : i + 4], ' ') AS g FROM w, range(1, greatest(len(ws) - 3, 2)) AS r(i) WHERE len(ws) > 0
  GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
r(v, c) AS (SELECT DISTINCT a, a FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.v)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.c, d.doc_id) AS component_id, coalesce(m.c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT v, min(c) AS c FROM r GROUP BY v) m ON m.v = d.doc_id
"""
