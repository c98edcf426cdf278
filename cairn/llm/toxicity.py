r"""Toxicity scores by a factorization machine over hashed terms (operator 3).

A text's features are its distinct terms: lower-cased words between white space and ASCII
punctuation, and the first 4, 5 and 6 bytes of longer words, hashed to 2**18 bins.  The score is

    sigmoid(b + sum_i w_i + sum_{i<j} <v_i, v_j>)

over the terms present, so a pair of terms (an insult and a group mention) can weigh more than the
two alone.  Terms are selected by their difference in document frequency between the classes, and both terms of
a pair by that of the pair: words that are as common in either class alone may tell it together.

The model is fitted on the driver with at most MAX_TRAIN labelled rows, the first by a hash of
doc_id; that bound is its only sample.  Every text is then scored where it lies, without a shuffle.

Defined results: null and empty texts have no terms and score sigmoid(b); null doc_ids are held in.
Labels that are null teach nothing; where a doc_id is labelled more than once, the highest label
counts; of several texts of one doc_id the greatest is learnt from, and each is scored.  Without labels the score is the prior 0.25.  The result has a row per input row; extra
columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytekit import BREAK, LOWER, U, Prefix, blocks, repeats
from .columns import foreign_names_kept

BITS, PREFIXES = 18, (4, 5, 6)
MAX_TRAIN, MAX_TERMS, RANK = 8000, 4096, 8
MIN_Z, STEPS, RATE, DECAY = 6.0, 200, 0.1, 2e-5
#: pairs of terms: toxic rows that must hold both, how many times those that chance would give, pairs that are
#: counted in all rows, pairs that are taken, and terms of the longest rows that pairs are sought in
PAIR_ROWS, LIFT, PAIR_TRIES, MAX_PAIRS, PAIR_TERMS = 12, 2.5, 4096, 512, 256
FOLDS = 5


def terms(block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct bins of each document, and the document of each."""
    starts, ends, docs = block.spans(~BREAK[block.buf])
    prefix = Prefix(LOWER[block.buf])
    found, where = [prefix(starts, ends)], [docs]
    for k in PREFIXES:
        at = np.flatnonzero(ends - starts > k)
        found.append(prefix(starts[at], starts[at] + k) * U(2 * k + 1))
        where.append(docs[at])
    h, d = np.concatenate(found) >> U(64 - BITS), np.concatenate(where)
    order = np.argsort(d, kind="stable")
    h, d = h[order], d[order]
    later, _ = repeats(h, d)
    return h[~later].astype(np.int32), d[~later]


def _separation(f1: np.ndarray, f: np.ndarray, n1: float, n: float) -> np.ndarray:
    """How many standard errors apart the shares of rows are: `f1` of the n1 toxic ones, `f` of all n."""
    p = f / n
    return (f1 / n1 - (f - f1) / (n - n1)) / np.sqrt(np.maximum(p * (1 - p), 1 / n) * (1 / n1 + 1 / (n - n1)))


def paired_terms(bins: np.ndarray, docs: np.ndarray, y: np.ndarray, f1: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Terms of the pairs that tell the classes apart better than either term does; docs ascend."""
    n, n1 = len(y), float(y.sum())
    # a term in more than a quarter of the rows is in most pairs, a pair no more common than chance is no pair
    keep = (f1[bins] >= PAIR_ROWS) & (f[bins] <= n / 4)
    bins, docs = bins[keep], docs[keep]
    toxic = np.flatnonzero(y > 0)
    rows = [np.sort(bins[a:b]).astype(np.int64) for a, b in zip(np.searchsorted(docs, toxic), np.searchsorted(docs, toxic, "right"), strict=True)]
    # a long text holds any two words: it tells nothing of pairs, and all its terms still count one by one
    rows = [row for row in rows if len(row) <= PAIR_TERMS]

    def codes() -> Iterator[np.ndarray]:
        for row in rows:
            a, b = np.triu_indices(len(row), 1)
            yield (row[a] << BITS) | row[b]

    hashed = lambda c: (c.astype(U) * U(0x9E3779B97F4A7C15) >> U(40)).astype(np.int64)
    chance = lambda a, b: f[a] * f[b] * (n1 / n / n)
    count = np.zeros(1 << 24, np.uint16)
    for c in codes():
        np.add.at(count, hashed(c), 1)
    often = []
    for c in codes():
        c = c[count[hashed(c)] >= PAIR_ROWS]
        often.append(c[count[hashed(c)] >= LIFT * chance(c >> BITS, c & ((1 << BITS) - 1))])
    del count
    pair, c1 = np.unique(np.concatenate([*often, np.zeros(0, np.int64)]), return_counts=True)
    pair, c1 = pair[c1 >= PAIR_ROWS], c1[c1 >= PAIR_ROWS]
    a, b = pair >> BITS, pair & ((1 << BITS) - 1)
    by_chance = chance(a, b)
    best = np.argsort(-(c1 - by_chance) / np.sqrt(by_chance + 1), kind="stable")[:PAIR_TRIES]
    a, b, c1 = a[best], b[best], c1[best]
    order = np.argsort(bins, kind="stable")
    listed, at = docs[order], np.searchsorted(bins[order], np.arange((1 << BITS) + 1))
    both = np.array([len(np.intersect1d(listed[at[i] : at[i + 1]], listed[at[j] : at[j + 1]], assume_unique=True)) for i, j in zip(a, b, strict=True)], float)
    if not len(both):
        return np.zeros(0, np.int64)
    z, alone = _separation(c1, both, n1, n), np.abs(_separation(f1, f, n1, n))
    better = np.flatnonzero((z > MIN_Z) & (z > np.maximum(alone[a], alone[b]) + 1))
    better = better[np.argsort(-z[better], kind="stable")][:MAX_PAIRS]
    return np.unique(np.concatenate((a[better], b[better])))


def _sum_rows(values: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of each document; docs ascend."""
    out = np.zeros((n, *values.shape[1:]))
    if len(docs):
        first = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
        out[docs[first]] = np.add.reduceat(values, first)
    return out


class FactorizationMachine:
    def __init__(self, slot: np.ndarray, b: float, w: np.ndarray, v: np.ndarray):
        self.slot, self.b, self.w, self.v = slot, b, w, v

    def margins(self, f: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
        """f: selected terms (slots), docs: the document of each."""
        vf = self.v[f]
        sums, squares = _sum_rows(vf, docs, n), _sum_rows((vf * vf).sum(1), docs, n)
        return self.b + _sum_rows(self.w[f], docs, n) + 0.5 * ((sums * sums).sum(1) - squares)

    def score(self, bins: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
        f = self.slot[bins]
        keep = f >= 0
        return _sigmoid(self.margins(f[keep], docs[keep], n))

    @classmethod
    def fit(cls, bins: np.ndarray, docs: np.ndarray, y: np.ndarray) -> FactorizationMachine:
        n, n1 = len(y), float(y.sum())
        n0 = n - n1
        prior = (n1 + 0.5) / (n + 2.0)
        slot = np.full(1 << BITS, -1, np.int32)
        empty = cls(slot, float(np.log(prior / (1 - prior))), np.zeros(0), np.zeros((0, RANK)))
        if not n0 or not n1:
            return empty
        f1 = np.bincount(bins, weights=y[docs], minlength=1 << BITS)
        f = np.bincount(bins, minlength=1 << BITS).astype(float)
        z = _separation(f1, f, n1, n)
        order = np.argsort(-np.abs(z), kind="stable")[:MAX_TERMS]
        chosen = order[(np.abs(z[order]) > MIN_Z) & (f[order] >= 3)]
        chosen = np.union1d(chosen, paired_terms(bins, docs, y, f1, f))
        if not len(chosen):
            return empty
        slot[chosen] = np.arange(len(chosen), dtype=np.int32)
        fs = slot[bins]
        fs, ds = fs[fs >= 0], docs[fs >= 0]
        rng = np.random.default_rng(5)
        b, w, v = np.array([empty.b]), np.zeros(len(chosen)), rng.normal(0, 0.02, (len(chosen), RANK))
        params, first, second = [b, w, v], [np.zeros_like(x) for x in (b, w, v)], [np.zeros_like(x) for x in (b, w, v)]
        by_term = np.argsort(fs, kind="stable")
        for step in range(1, STEPS + 1):
            model = cls(slot, float(b[0]), w, v)
            vf = v[fs]
            error = (_sigmoid(model.margins(fs, ds, n)) - y) / n
            sums = _sum_rows(vf, ds, n)
            e = error[ds]
            gw = _sum_rows(e[by_term], fs[by_term], len(w)) + DECAY * w
            gv = _sum_rows((e[:, None] * (sums[ds] - vf))[by_term], fs[by_term], len(w)) + DECAY * v
            for x, g, m1, m2 in zip(params, [np.array([error.sum()]), gw, gv], first, second, strict=True):
                m1 += 0.1 * (g - m1)
                m2 += 0.001 * (g * g - m2)
                x -= RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        return cls(slot, float(b[0]), w, v)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fold(doc_id: str = "doc_id"):
    """crc32 of the doc_id as text, modulo FOLDS: 0 is held out."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % FOLDS


def train(docs: DataFrame, labels: DataFrame) -> FactorizationMachine:
    """A model of `labels` (doc_id, toxic) over `docs` (doc_id, text), without the held-out fold."""
    known = labels.filter("toxic is not null and doc_id is not null").filter(fold() != 0)
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN)
    rows = docs.select("doc_id", "text").join(sample, "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.first("toxic").alias("toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1)
            for block in blocks(batch.column(0)):
                bins, d = terms(block)
                ends = np.searchsorted(d, np.arange(block.n + 1))
                packed = [bins[ends[i] : ends[i + 1]].tobytes() for i in range(block.n)]
                yield pa.RecordBatch.from_arrays([y.slice(block.first, block.n), pa.array(packed, pa.binary())], ["toxic", "bins"])

    got = rows.select("text", "toxic").mapInArrow(run, "toxic int, bins binary").collect()
    got = sorted((r["toxic"], bytes(r["bins"])) for r in got)
    packed = [np.frombuffer(b, np.int32) for _, b in got]
    y = np.array([t for t, _ in got], float)
    bins = np.concatenate([*packed, np.zeros(0, np.int32)])
    return FactorizationMachine.fit(bins, np.repeat(np.arange(len(y)), [len(p) for p in packed]), y)


def score(docs: DataFrame, model: FactorizationMachine, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """The columns `keep` of each row, and its score as the column `name`."""
    src = docs.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = [model.score(*terms(block), block.n) for block in blocks(batch.column(len(keep)))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(np.concatenate(scores))], [*keep, name])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
    return src.mapInArrow(run, ", ".join([*fields, f"`{name}` double"]))


def op3_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score(docs, train(docs, labels), ["doc_id"])
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@foreign_names_kept
def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` (all columns) without the rows that score 0.5 or more."""
    names = docs.columns
    scored = score(docs, train(docs, labels), names, name="__toxic_score")
    return scored.filter("__toxic_score < 0.5").select(*names)
