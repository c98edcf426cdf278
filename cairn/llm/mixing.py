r"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 7, native).

Sources in code point order, null last, weigh 5, 2, 1, repeating.  Together they are to give as many
words as the corpus has; a target stops at 3 times its source's size and the excess goes to the
others by weight.  A source is first taken whole as often as its target holds it (complete epochs).
What is left is filled in the order of exponential keys -ln(u) / weight, u from a hash of the
document and weight its quality: documents whose running size ends nearest the budget.

The order is found without sorting a source: keys are cut into slices of equal ratio, small per-slice sums
give each slice's start, and only the slice in which a budget ends is put in order.  All slices before it
are taken whole, none behind it, and their rows stay where they are; texts are read again, never stored.
Sources are few against documents: a row for each is ordered in one task.

Defined results: size counts words `[^\x20\x09-\x0D]+`; null and empty texts have size 0, are never
taken and do not change any sum.  Null sources are one source.  Rows that repeat share a key and
follow each other; ties are ordered by doc_id and text hash, so reruns agree.  An empty table gives
an empty result; extra columns pass through `mix` untouched, but for those named as its own four.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch

WEIGHTS, MOST, SEED = (5, 2, 1), 3, 17
#: slices of a source for each factor of e in the keys: whatever the weights, none holds over 0.4 / SLICES of them
SLICES = 2048
WORD = r"[^\x20\x09-\x0D]+"


def quality(text: str = "text"):
    """Sampling weight of a text: the share of its characters that are not symbols, squared; 0.01 at least."""
    share = F.length(F.translate(F.coalesce(F.col(text), F.lit("")), "#*$%&|<>", "")) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(share * share, F.lit(0.01))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target): `sizes` has one row per source; the fill level is found in closed form.

    Sorted by the level at which each source is full, the sources before the k-th are full exactly
    if what the others would get by weight is no more than the k-th can hold.
    """
    ordered = Window.orderBy(F.col("source").isNull(), "source")
    w = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(ordered) - 1) % len(WEIGHTS) + 1).cast("double"))
    w = w.withColumn("cap", F.lit(float(MOST)) * F.col("source_size")).withColumn("full_at", F.col("cap") / F.col("weight"))
    rising = Window.orderBy("full_at", F.col("source").isNull(), "source")
    every = Window.partitionBy()
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    w = w.withColumn("share", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    w = w.withColumn("level", F.max(F.when(F.col("left") / F.col("share") <= F.col("full_at"), F.col("left") / F.col("share"))).over(every))
    return w.select("source", "source_size", F.least("cap", F.coalesce("level", F.lit(0.0)) * F.col("weight")).alias("target"))


def mix(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns `keep` of each row, and size, source_size, target and taken (words, repeats counted)."""
    scratch = Scratch(docs.sparkSession, "mixing")
    keep = [c for c in keep if c not in ("size", "source_size", "target", "taken")]
    # 52 bits of a hash of the document, as a number between 0 and 1
    digest = F.md5(F.concat_ws(":", F.lit(SEED), F.col("doc_id").cast("string"), "text"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    names = list(dict.fromkeys([*keep, "source", "doc_id"]))
    rows = docs.select(*names, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("__size"), (-F.log(u) / quality()).alias("__key"), F.xxhash64("text").alias("__text"))
    rows = rows.withColumn("__slice", F.floor(F.log("__key") * SLICES))
    slim = scratch.save(rows.select(*(c for c in rows.columns if c != "text")), "sizes")
    if "text" not in keep:
        rows = slim
    slices = slim.groupBy("source", "__slice").agg(F.sum("__size").alias("words"))
    start = F.sum("words").over(Window.partitionBy("source").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    slices = scratch.save(slices.withColumn("start", F.coalesce(start, F.lit(0))), "slices")
    goal = targets(slices.groupBy("source").agg(F.sum("words").alias("source_size"))).withColumnRenamed("source", "s")
    # a target is at most 3 sizes by construction; rounding must not make a fourth epoch of it
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size") + 1e-12), F.lit(MOST))).otherwise(F.lit(0))
    goal = goal.withColumn("epochs", epochs)
    goal = goal.withColumn("left", F.when(F.col("epochs") < MOST, F.col("target") - F.col("epochs") * F.col("source_size")).otherwise(F.lit(-1.0)))
    ends = F.col("start") + F.col("words")
    cut = (F.col("start") < F.col("left")) & (ends > F.col("left"))
    plan = slices.join(goal, F.col("source").eqNullSafe(F.col("s"))).groupBy("s", "source_size", "target", "epochs", "left")
    plan = plan.agg(F.max(F.when(ends <= F.col("left"), F.col("__slice"))).alias("whole"), F.max(F.when(cut, F.col("__slice"))).alias("cut"), F.max(F.when(cut, F.col("start"))).alias("start"))
    plan = scratch.save(plan.select(*(F.col(c).alias(f"__{c}") for c in plan.columns)), "plan")
    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("__s")))
    in_cut = F.coalesce(F.col("__slice") == F.col("__cut"), F.lit(False))
    out = [*keep, F.col("__size").alias("size"), F.col("__source_size").cast("long").alias("source_size"), F.col("__target").alias("target")]
    taken = lambda more: (F.col("__size") * (F.col("__epochs") + F.coalesce(more, F.lit(False)).cast("int"))).cast("long").alias("taken")
    most = placed.filter(~in_cut).select(*out, taken(F.col("__slice") <= F.col("__whole")))
    # the document that crosses the budget is taken if that ends nearer to it
    order = Window.partitionBy("source").orderBy("__key", "doc_id", "__text").rowsBetween(Window.unboundedPreceding, 0)
    few = placed.filter(in_cut).withColumn("__end", F.col("__start") + F.sum("__size").over(order))
    return most.unionByName(few.select(*out, taken(F.col("__end") - F.col("__size") / 2 <= F.col("__left"))))


def op7_efraimidis_spirakis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])


ORACLE_SQL = rf"""
WITH b AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    ((('0x' || substr(md5(concat_ws(':', {SEED}, doc_id, text)), 1, 13))::BIGINT)::DOUBLE + 0.5) / {1 << 52} AS u,
    length(translate(coalesce(text, ''), '#*$%&|<>', '')) / greatest(coalesce(length(text), 1), 1) AS share FROM documents),
r AS (SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY -ln(u) / greatest(share * share, 0.01), doc_id ROWS UNBOUNDED PRECEDING) AS ends FROM b),
g AS (SELECT source, sum(size) AS source_size FROM b GROUP BY source),
w AS (
  SELECT source, source_size, weight, cap, cap / weight AS full_at FROM (
    SELECT *, {list(WEIGHTS)}[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(WEIGHTS)} + 1]::DOUBLE AS weight, {MOST}::DOUBLE * source_size AS cap FROM g)),
x AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS try
  FROM w WINDOW before AS (ORDER BY full_at, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, coalesce(max(CASE WHEN try <= full_at THEN try END) OVER (), 0) * weight) AS target FROM x),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size + 1e-12), {MOST}) ELSE 0 END AS epochs FROM t)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, (size * (epochs + CASE WHEN epochs < {MOST} AND ends - size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source
"""
