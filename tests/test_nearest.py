import random

from pyspark.sql import functions as F

from cairn.operators import relational as rel
from cairn.plans import catalogue

SCHEMA = "{0}_key long, {0}_nationkey int, {0}_acctbal double"


def nearest(suppliers, customers):
    """By all pairs, nulls last: what the query's SQL says."""
    apart = F.round(F.abs(F.col("c_acctbal") - F.col("s_acctbal")), 2)
    pairs = suppliers.join(customers, F.col("s_nationkey") == F.col("c_nationkey")).withColumn("apart", apart)
    rows = pairs.groupBy("s_suppkey").agg(F.min_by("c_custkey", F.struct(F.col("apart").isNull(), "apart", -F.col("c_custkey"))), F.min("apart")).collect()
    return {r[0]: (r[1], r[2]) for r in rows}


def test_nearest_by_balance_makes_no_pairs_of_a_nation(spark, tmp_path):
    rng = random.Random(4)
    value = lambda: rng.choice([None, float("inf"), 0.0, 5000.25, *(round(rng.uniform(-999, 9999), rng.choice([0, 1, 2, 2, 2, 3, 4])) for _ in range(40))])
    customers = [(k, rng.choice([None, 1, 2, 3]), value()) for k in range(3000)]
    customers += [(k, 4, None) for k in range(3000, 3010)] + [(k, 5, round(rng.uniform(0, 0.1), 3)) for k in range(3010, 3060)] + [(k, 6, 7.0 + 3000 * (k % 2)) for k in range(3060, 3070)]
    suppliers = [(k, rng.choice([None, 1, 2, 3, 4, 5, 6, 7]), rng.choice([value(), round(rng.uniform(0, 0.1), 3)])) for k in range(600)]
    tables = {}
    for name, rows in (("c", customers), ("s", suppliers)):
        df = spark.createDataFrame(rows, SCHEMA.format(name)).withColumnRenamed(f"{name}_key", "c_custkey" if name == "c" else "s_suppkey")
        tables[name] = df
        df.write.parquet(f"{tmp_path}/{'customer' if name == 'c' else 'supplier'}.parquet")
    got = {r.s_suppkey: (r.nearest, r.apart) for r in catalogue.queries()["q_argmin_composite"](spark, str(tmp_path)).collect()}
    want = nearest(tables["s"], tables["c"])
    assert len(want) > 300
    assert {k: str(v) for k, v in got.items()} == {k: str(v) for k, v in want.items()}


def test_rows_of_a_point_do_not_grow_with_its_group(spark):
    places = spark.range(20000).select(F.lit(1).alias("g"), (F.col("id") % 9000 / 100.0).alias("x"), "id")
    near = rel.nearest_rounded(places.select("g", "x"), places, "g", "x", "id", 2)
    assert near.count() == 9000
    assert near.agg(F.max("apart")).first()[0] == 0
