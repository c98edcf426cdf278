import hashlib
import math
import re
import zlib

import numpy as np
from fixtures import DOCS, rows, table
from pyspark.sql import functions as F

from cairn.llm import crc, importance

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def grams(text):
    ws = words(text)
    return [zlib.crc32(" ".join(ws[i : i + n]).encode()) % importance.BUCKETS for n in (1, 2, 3) for i in range(len(ws) - n + 1)]


def brute(docs, target, percent=importance.PERCENT):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) pairs."""
    s, t = np.zeros(importance.BUCKETS), np.zeros(importance.BUCKETS)
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for b in grams(text):
                counts[b] += 1
    out = []
    for i, text in docs:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (s.sum() + 10000) / ((s[b] + 1) * (t.sum() + 10000)))) for b in grams(text))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(grams(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words(text))))
    first = sorted((-r[3], r[0] is not None, r[0] or 0, r[1]) for r in out if r[4] >= importance.MIN_WORDS)
    first = first[: percent * len(first) // 100]
    ranks = {}
    for n, key in enumerate(first, 1):
        ranks.setdefault(key, []).append(n)
    return _with_ranks(out, ranks)


def _with_ranks(out, ranks):
    done = []
    for i, n, weight, score, n_words in out:
        left = ranks.get((-score, i is not None, i or 0, n)) if n_words >= importance.MIN_WORDS else None
        done.append((i, n, weight, score, left.pop(0) if left else None))
    return sorted(done, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_checksums_and_their_joins():
    rng = np.random.default_rng(3)
    buf = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4000, 300)
    ends = starts + np.concatenate((rng.integers(0, 12, 250), rng.integers(0, 900, 50)))
    one = crc.crc32(buf, starts, ends)
    assert one.tolist() == [zlib.crc32(buf[s:e].tobytes()) for s, e in zip(starts, ends)]
    both = crc.joined(one[:-1], one[1:], (ends - starts)[1:])
    assert both.tolist() == [zlib.crc32(buf[a:b].tobytes() + buf[c:d].tobytes()) for a, b, c, d in zip(starts, ends, starts[1:], ends[1:])]


def test_equals_brute_force_with_nulls_ties_and_clashing_columns(spark):
    data = rows(11, 60)
    data += [(None, "tie word " * 30, "en", None, 0)] * 3 + [(7, data[7][1], "en", "x", 0)] * 4
    target = [r[1] for r in data[:5]] + [None, "", "MiXed Case wörds 12"]
    docs = table(spark, data, rank="clash", row="clash", down="clash", id="clash", part="clash", score="clash")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    for percent in (5, 60, 100):
        assert got(importance.resample(docs, bench, percent)) == brute([(r[0], r[1]) for r in data], target, percent)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(none, bench).count() == 0
    data = [(i, "alpha beta gamma " * (i % 9), "en", "a", 0) for i in range(50)]
    assert got(importance.resample(spark.createDataFrame(data, DOCS), bench)) == brute([r[:2] for r in data], [])


def test_quickselect_finds_every_rank(spark):
    keys = spark.range(500).select((F.col("id") % 7).alias("down"), F.lit(True).alias("named"), (F.col("id") % 3).alias("id"), F.lit(1).alias("n_features"), F.col("id").alias("row"))
    order = sorted(tuple(r) for r in keys.collect())
    for k in (1, 2, 250, 499, 500):
        assert tuple(importance.kth_key(keys, k)[c] for c in importance.KEY) == order[k - 1]


def test_a_million_words_and_a_long_one(spark):
    data = [(1, "a b " * 200_000 + "z" * 300_000, "en", "a", 0), *((i, "a b c d e " * 5, "en", "a", 0) for i in range(2, 30))]
    assert got(importance.resample(spark.createDataFrame(data, DOCS), spark.createDataFrame([(1, "a b")], "item_id long, text string"))) == brute([r[:2] for r in data], ["a b"])
