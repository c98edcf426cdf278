import datetime

from pyspark.sql import functions as F

from cairn.operators import relational as rel


def test_numbers_within_few_groups(spark):
    day = datetime.date(2020, 1, 1)
    rows = [(("a", "b", None)[i % 3], (i * 7919) % 400, day + datetime.timedelta(i % 5), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, x int, d date, i long").repartition(5)
    for group in (["g"], [], ["g", "d"]):
        got = rel.numbered(df, group, ["x", "i"], slices=7)
        place = {r.i: r.place for r in got.collect()}
        want = {}
        for key in {tuple(r["gxdi".index(c)] for c in group) for r in rows}:
            mine = sorted((r for r in rows if tuple(r["gxdi".index(c)] for c in group) == key), key=lambda r: (r[1], r[3]))
            want |= {r[3]: n for n, r in enumerate(mine, 1)}
        assert place == want and got.columns == [*df.columns, "place"]
    assert rel.numbered(df.limit(0), ["g"], ["x"]).count() == 0
    assert "place" in rel.numbered(df.filter(F.col("i") < 1), [], ["i"]).columns


def test_a_row_finds_its_slice_by_halving(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 50 > 0, F.col("id") * 7919 % 1009).alias("x"), F.col("id").alias("i"))
    got = rel.numbered(df, ["g"], ["x", "i"])
    rows = sorted(df.collect(), key=lambda r: (r.g, r.x is not None, r.x or 0, r.i))
    place, want = {}, {}
    for r in rows:
        place[r.g] = want[r.i] = place.get(r.g, 0) + 1
    assert {r.i: r.place for r in got.collect()} == want
    # no list of all bounds is gone through for a row
    assert "filter(" not in got._jdf.queryExecution().analyzed().toString()
