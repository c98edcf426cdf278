from collections import Counter

from pyspark.sql import functions as F

from cairn.operators import sequence as seq


def test_letter_counts(spark, monkeypatch):
    """Against plain counting: nulls, empty texts, repeated rows, letters beyond the basic plane, chunks of a few letters."""
    monkeypatch.setattr(seq, "CHUNK_LETTERS", 7)
    data = [("a", 3, "ACGT"), ("a", 1, "ACCT\U0001f600x"), ("a", 1, "ACCT\U0001f600x"), (None, 2, "A\nB"), ("a", None, "G\x00"), ("b", None, "zz" * 9), ("b", 5, ""), ("b", 6, None)]
    df = spark.createDataFrame(data, "g string, id long, text string").withColumn("n", F.lit(1)).withColumn("first", F.lit("x"))
    counts = seq.letter_counts(df.repartition(2), "g", "id", "text").groupBy("g", "position", "letter").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    want, least = Counter(), {}
    for g, i, text in data:
        for at, x in enumerate(text or ""):
            want[g, at, x] += 1
            if i is not None:
                least[g, at, x] = min(i, least.get((g, at, x), i))
    assert {(r.g, r.position, r.letter): (r.n, r["first"]) for r in counts.collect()} == {k: (n, least.get(k)) for k, n in want.items()}
    assert seq.letter_counts(df.limit(0), "g", "id", "text").count() == 0


def test_divergence_counts_once(spark):
    df = spark.createDataFrame([("ACGTN", "ACCTA"), ("", ""), ("-A", "A-")], "q string, r string")
    assert [(r.compared, r.mismatches) for r in seq.divergence(df).collect()] == [(5, 2), (0, 0), (2, 2)]
    assert [(r.compared, r.mismatches) for r in seq.divergence(df, "^[ACGT]$").collect()] == [(4, 1), (0, 0), (0, 0)]
