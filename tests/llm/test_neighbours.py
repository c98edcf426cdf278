import math

import numpy as np
from pyspark.sql import functions as F

from cairn.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors, ids=None, **extra):
    ids = range(len(vectors)) if ids is None else ids
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in zip(ids, vectors)], SCHEMA).repartition(3)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def brute(df, every=neighbours.EVERY, wanted=neighbours.WANTED):
    rows = {}
    for r in df.collect():
        v = r.embedding
        if r.vec_id is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            rows.setdefault(r.vec_id, []).append(tuple(v))
    sizes = [len(v) for vs in rows.values() for v in vs]
    size = min(set(sizes), key=lambda n: (-sizes.count(n), n)) if sizes else 0
    rows = {i: min(v for v in vs if len(v) == size) for i, vs in rows.items() if any(len(v) == size for v in vs)}
    ids, x = sorted(rows), np.array([rows[i] for i in sorted(rows)])
    out = {}
    for q in ids:
        if q % every == 0:
            score = (x * np.array(rows[q])).sum(axis=1)
            out[q] = [(i, s) for s, i in sorted((-s, i) for i, s in zip(ids, score) if i != q)[:wanted]]
    return {q: [(i, -s) for i, s in near] for q, near in out.items()}


def got(df):
    out = {}
    for r in sorted(neighbours.search(df, F.col("id") % neighbours.EVERY == 0).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(df):
    want, have = brute(df), got(df)
    assert have.keys() <= want.keys()
    truth = {(q, i): s for q, near in want.items() for i, s in near}
    for q, near in have.items():
        assert len(near) == len(want[q]) == len({i for i, _ in near})
        assert near == sorted(near, key=lambda p: (-p[1], p[0]))
        assert all(abs(truth[q, i] - s) < 1e-12 for i, s in near if (q, i) in truth)
    return sum((q, i) in truth for q, near in have.items() for i, _ in near) / max(1, len(truth))


def test_recall_on_vectors_without_structure(spark):
    x = np.random.default_rng(1).normal(size=(3000, 64))
    assert recall(table(spark, x / np.linalg.norm(x, axis=1)[:, None])) >= 0.9


def test_recall_on_groups_of_unequal_length(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 24))[rng.integers(0, 40, 3000)] + 0.3 * rng.normal(size=(3000, 24))
    assert recall(table(spark, x * rng.uniform(0.5, 2, 3000)[:, None])) >= 0.9


def test_one_common_vector_and_a_large_cell(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 8))
    x[::3] = x[0]
    x[1::3] = x[0] + 1e-4 * rng.normal(size=(2000, 8))
    assert recall(table(spark, x)) >= 0.97


def test_ties_go_to_smaller_ids(spark):
    x = np.eye(4)[np.arange(400) % 4]
    df = table(spark, x)
    assert got(df) == brute(df)


def test_vectors_that_take_no_part_and_clashing_columns(spark):
    rng = np.random.default_rng(4)
    x = [list(v) for v in rng.normal(size=(90, 5))]
    x += [None, [], [0.0] * 5, [1, None, 1, 1, 1], [math.inf] * 5, [math.nan] * 5, [1, 2, 3]]
    ids = [*range(90), *range(100, 800, 100)]
    df = table(spark, [*x, [9, 9, 9, 9, 9], x[20], x[40][::-1], x[0]], [*ids, 800, None, 20, 40, 0], id="clash", v="clash", rank="clash", bin="clash", cell="clash")
    assert got(df) == brute(df) and set(got(df)) == {0, 20, 40, 60, 80, 800}


def test_few_vectors(spark):
    assert neighbours.search(spark.createDataFrame([], SCHEMA), F.col("id") == 0).count() == 0
    assert got(table(spark, [[1.0, 2.0]], [20])) == {}
    assert got(table(spark, [[2.0], [1.0], [3.0]], [20, 1, 2])) == {20: [(2, 6.0), (1, 2.0)]}


def test_traversal_is_by_falling_sum():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 9, 13).astype(float), rng.normal(size=7)
    seen = list(neighbours.traverse(a, b))
    assert [s for s, _, _ in seen] == sorted((x + y for x in a for y in b), reverse=True)
    assert sorted((i, j) for _, i, j in seen) == [(i, j) for i in range(13) for j in range(7)]
