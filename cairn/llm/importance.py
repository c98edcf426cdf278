"""Importance resampling: documents drawn by likeness to a target, with Gumbel noise, by a distributed quickselect.

Features of a text are its runs of one to three words, hashed to a fixed number of buckets.  What a
bucket is worth is the log ratio of its shares in the target and in the documents: one array, which
scores texts by look-ups.  The k best of all documents are found without sorting them: some random keys
of those still in question are pivots, exact counts of the keys below, at and above each narrow the range
to the k-th key, and only keys at or before it are then sorted and ranked.

A key is (score, doc_id, n_features, place in the table), so no two are equal, and equal rows can be told
apart by nothing but their place: which of them is drawn shows in no column.  Null and empty texts have no
features, weight 0, and too few words to be drawn.  A null doc_id hashes as an empty one and goes before others
at equal scores.  An empty target gives every bucket its share in the documents alone; an empty table gives
no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import crc
from .bytekit import BREAK, LOWER, Block, blocks
from .scratch import Scratch

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
#: pivots of a round: the range in question shrinks to about one of so many parts
PIVOTS = 16
KEY = ("down", "named", "id", "n_features", "row")


def features(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document and bucket of each feature of a block, and the number of words of each document."""
    buf = LOWER[block.buf]
    starts, ends, docs = block.spans(~BREAK[buf])
    lengths = ends - starts
    word = crc.crc32(buf, starts, ends)
    spaced = crc.joined(word, np.full(len(word), crc.crc32(np.frombuffer(b" ", np.uint8), np.array([0]), np.array([1]))[0]), np.ones(len(word), np.int64))
    owners, sums = [docs], [word]
    tail, tail_len = word, lengths
    for n in range(2, LONGEST + 1):
        # the runs of n words that end where those of n - 1 do
        tail = crc.joined(spaced[: len(tail) - 1], tail[1:], tail_len[1:])
        tail_len = tail_len[1:] + lengths[: len(tail)] + 1
        whole = docs[: len(tail)] == docs[n - 1 :]
        owners.append(docs[: len(tail)][whole])
        sums.append(tail[whole])
    return np.concatenate(owners), np.concatenate(sums).astype(np.int64) % BUCKETS, np.bincount(docs, minlength=block.n)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts by bucket: each task sums its own rows into one array, which is all that leaves it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                total += np.bincount(features(block)[1], minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    s_all, t_all = float(documents.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(documents.tolist(), target.tolist(), strict=True)], np.int64)


def scored(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_features, weight, score and n_words of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for block in blocks(batch.column(1)):
                owner, bucket, n_words = features(block)
                weight = np.bincount(owner, weights=gains[bucket], minlength=block.n).astype(np.int64)
                parts.append((np.bincount(owner, minlength=block.n), weight, n_words))
            if parts:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts, strict=True))], ["doc_id", "n_features", "weight", "n_words"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_features long, weight long, n_words long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.withColumn("score", (F.col("weight") + noise).cast("long"))


def _key(of: dict | None = None) -> Column:
    return F.struct(*(F.lit(of[c]).alias(c) if of else F.col(c) for c in KEY))


def kth_key(keys: DataFrame, k: int) -> dict:
    """The k-th smallest of the keys (columns KEY, no two rows equal; k from 1 to their number)."""
    low = high = None
    skipped, turn = 0, 0
    while True:
        rest = keys
        if low:
            rest = rest.filter((F.col("down") >= low["down"]) & (_key() > _key(low)))
        if high:
            rest = rest.filter((F.col("down") <= high["down"]) & (_key() < _key(high)))
        drawn = rest.orderBy(F.xxhash64(F.lit(turn), *KEY), *KEY).limit(PIVOTS).collect()
        pivots = sorted((r.asDict() for r in drawn), key=lambda p: [p[c] for c in KEY])
        counts = rest.agg(*(F.count_if(_key() < _key(p)).alias(f"l{i}") for i, p in enumerate(pivots)), *(F.count_if(_key() == _key(p)).alias(f"e{i}") for i, p in enumerate(pivots))).first()
        passed = skipped
        for i, p in enumerate(pivots):
            if k <= skipped + counts[f"l{i}"]:
                high = p
                break
            passed = skipped + counts[f"l{i}"] + counts[f"e{i}"]
            if k <= passed:
                return p
            low = p
        skipped, turn = passed, turn + 1


def _ranked(winners: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows with their rank by KEY: ranges are numbered apart, after the counts of the ranges before."""
    parts = scratch.save(winners.repartitionByRange(*KEY).withColumn("part", F.spark_partition_id()), "ranges")
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*KEY))
    return parts.withColumn("place", place).join(starts, "part").withColumn("rank", (F.col("start") + F.col("place")).cast("long"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score of every row of `docs`, and rank of those drawn (else null)."""
    scratch = Scratch(docs.sparkSession, "importance")
    gains = bucket_gains(bucket_counts(docs), bucket_counts(target))
    rows = scored(docs, gains).withColumns({"row": F.monotonically_increasing_id(), "down": -F.col("score"), "named": F.col("doc_id").isNotNull(), "id": F.coalesce("doc_id", F.lit(0))})
    rows = scratch.save(rows, "scores")
    enough = F.col("n_words") >= MIN_WORDS
    k = percent * rows.filter(enough).count() // 100
    out = ["doc_id", "n_features", "weight", "score"]
    if not k:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    last = kth_key(rows.filter(enough).select(*KEY), k)
    drawn = enough & (_key() <= _key(last))
    return _ranked(rows.filter(drawn), scratch).select(*out, "rank").unionByName(rows.filter(~drawn).select(*out, F.lit(None).cast("long").alias("rank")))


def op11_importance_quickselect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT side, r, doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM (
    SELECT 0 AS side, row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents UNION ALL SELECT 1, row_number() OVER (), NULL, {_WORDS} FROM benchmark)),
g AS (SELECT side, r, w AS f1, w || ' ' || lead(w) OVER o AS f2, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS f3 FROM w WINDOW o AS (PARTITION BY side, r ORDER BY i)),
f AS (SELECT side, r, f1 AS f FROM g UNION ALL SELECT side, r, f2 FROM g WHERE f2 IS NOT NULL UNION ALL SELECT side, r, f3 FROM g WHERE f3 IS NOT NULL),
u AS (SELECT row_number() OVER () AS k, f FROM (SELECT DISTINCT f FROM f)),{crc.sql("u", "k", "f")},
b AS (SELECT side, r, crc % {BUCKETS} AS bucket FROM f JOIN u ON u.f = f.f JOIN crc_of c ON c.k = u.k),
n AS (SELECT count(*) FILTER (side = 0) AS s_all, count(*) FILTER (side = 1) AS t_all FROM b),
p AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM b GROUP BY bucket),
v AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + {BUCKETS})::DOUBLE) / ((s + 1)::DOUBLE * (t_all + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM p, n),
d AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM b JOIN v ON v.bucket = b.bucket WHERE side = 0 GROUP BY r),
x AS (SELECT row_number() OVER () AS r, doc_id, len({_WORDS}) AS n_words, (('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT)::DOUBLE AS h FROM documents),
y AS (
  SELECT doc_id, n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))))::BIGINT AS score FROM x LEFT JOIN d ON d.r = x.r),
z AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id, n_features) AS place, count(*) FILTER (n_words >= {MIN_WORDS}) OVER () AS n_all FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {MIN_WORDS} AND place <= {PERCENT} * n_all // 100 THEN place END::BIGINT AS rank FROM z
"""
