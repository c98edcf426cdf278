"""Relational operators: first wins, precedence, islands, tiling, set accounting, ranks.

All are plain DataFrame compositions.  Top-1 choices are `min_by` / `max_by` aggregations, which
combine before the shuffle, rather than windows, wherever one row of a group is all that is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The values of each group's first row by `order`; a total order makes it deterministic."""
    first = F.min_by(F.struct(*values), F.struct(*order)).alias("m")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"m.{v}").alias(v) for v in values])


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each group, with their rank."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w).cast("bigint")).filter(F.col(rank) <= n)


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "place", slices: int = 64) -> DataFrame:
    """`df` with the number of each row in its group, from 1: for groups that are few and large, or none.

    A window over a group is one task.  Here the whole order of groups and rows is cut at `slices` keys, the first by a
    hash; rows are numbered within a slice, after those of the slices before, which are counted first.
    """
    keys = [*group, *order]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    drawn = df.select(*keys).orderBy(F.xxhash64(*keys), *keys).limit(slices).orderBy(*keys).collect()
    if not drawn:
        return df.withColumn(name, F.lit(0).cast("long"))
    bounds = F.array(*(F.struct(*(F.lit(r[k]).cast(kinds[k]).alias(k) for k in keys)) for r in drawn))
    # the number of bounds below a row, by halving: a comparison for each bit of it, not one for each bound
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(drawn).bit_length()))))
    cut = df.withColumn("__slice", F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.coalesce(F.get(bounds, at + step - 1) < F.struct(*keys), F.lit(False)), at + step).otherwise(at)))
    earlier = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy(*group, "__slice").agg(F.count("*").alias("__n")).withColumn("__start", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    starts = starts.select(*(F.col(c).alias(f"__g{i}") for i, c in enumerate(group)), F.col("__slice").alias("__s"), "__start")
    met = F.col("__slice") == F.col("__s")
    for i, c in enumerate(group):
        met = met & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    place = F.row_number().over(Window.partitionBy(*group, "__slice").orderBy(*order))
    out = cut.withColumn(name, place).join(starts, met)
    return out.select(*df.columns, (F.col("__start") + F.col(name)).cast("long").alias(name))


def governing(df: DataFrame, key: str, order: Sequence[Column], value: str) -> DataFrame:
    """Keep the highest-precedence row of each key; add `retired` rows and whether values disagree."""
    w = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(w))
    every = Window.partitionBy(key)
    ranked = ranked.withColumn("retired", F.count("*").over(every) - 1).withColumn("disagrees", F.min(value).over(every) != F.max(value).over(every))
    return ranked.filter("__rank = 1").drop("__rank")


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Maximal runs of equal `value` in order: run number and its rows."""
    w = Window.partitionBy(*keys).orderBy(*order)
    starts = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)), 0).otherwise(1)
    marked = df.withColumn("__start", starts)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = marked.withColumn("run", F.sum("__start").over(running))
    return numbered.groupBy(*keys, "run", value).agg(F.count("*").alias("length"))


def sessions(df: DataFrame, keys: Sequence[str], at: str, tie: str, seconds: int) -> DataFrame:
    """Number groups of rows that follow each other within `seconds`."""
    w = Window.partitionBy(*keys).orderBy(at, tie)
    gap = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(F.lag(at).over(w).cast("timestamp"))
    new = F.when(gap.isNull() | (gap > seconds * 1_000_000), 1).otherwise(0)
    return df.withColumn("__new", new).withColumn("session", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def gaps_between(df: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """The complement of consecutive positions: (key, gap_start, gap_end) where something lies between."""
    w = Window.partitionBy(key).orderBy(at, tie)
    return df.select(key, F.col(at).alias("gap_start"), F.lead(at).over(w).alias("gap_end")).filter("gap_end > gap_start")


def range_join(df: DataFrame, key: str, at: str, id_: str, width: int) -> DataFrame:
    """Pairs of rows of a key within `width` of each other, by equi-joining bins.

    Each row meets only its own bin and the next, so a key with many rows makes only near pairs.
    """
    bins = df.select(key, F.col(at).alias("p"), F.col(id_).alias("i"), F.floor(F.col(at) / width).alias("bin"))
    left = bins.select(key, F.col("p").alias("lo"), F.col("i").alias("lo_id"), F.explode(F.array("bin", F.col("bin") + 1)).alias("bin"))
    right = bins.select(key, F.col("p").alias("hi"), F.col("i").alias("hi_id"), "bin")
    return left.join(right, [key, "bin"]).filter((F.col("hi") > F.col("lo")) & (F.col("hi") - F.col("lo") <= width)).drop("bin")


def nearest_rounded(points: DataFrame, places: DataFrame, group: str, at: str, key: str, digits: int) -> DataFrame:
    """(group, at, apart, key): for each distinct point (group, at), the places (group, at, key) of its group that are nearest, and how far: rounded.

    Places of one distance are one row, with the largest key; a point has several rows where places differ by less than the rounding.
    A point or place that is null or not finite is as far from all finite ones: it meets one row for each such kind of its group.
    The least distance is to the place before or after in order, found within slices of the line and, where a slice has none,
    at the ends of the slices beside it; what rounds to that distance lies in cells next to it, which are joined by equality.
    """
    width, unit = 16.0, 10.0**-digits
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    every = places.groupBy(group, F.col(at).cast("double").alias("__p")).agg(F.max(key).alias(key))
    held = every.filter(finite(F.col("__p")) & F.col(key).isNotNull())
    asked = points.select(group, F.col(at).cast("double").alias("__x")).filter(F.col(group).isNotNull()).distinct()
    cell = lambda x: F.floor(x / width)
    line = held.select(group, F.col("__p").alias("__v"), F.col("__p")).unionByName(asked.filter(finite(F.col("__x"))).select(group, F.col("__x").alias("__v"), F.lit(None).cast("double").alias("__p")))
    line = line.withColumn("__cell", cell(F.col("__v")))
    before = Window.partitionBy(group, "__cell").orderBy("__v").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(group, "__cell").orderBy("__v").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    inner = line.withColumn("__lo", F.max("__p").over(before)).withColumn("__hi", F.min("__p").over(after)).filter("__p is null")
    ends = line.groupBy(group, "__cell").agg(F.max("__p").alias("__max"), F.min("__p").alias("__min"))
    cells = Window.partitionBy(group).orderBy("__cell")
    ends = ends.select(group, "__cell", F.max("__max").over(cells.rowsBetween(Window.unboundedPreceding, -1)).alias("__left"), F.min("__min").over(cells.rowsBetween(1, Window.unboundedFollowing)).alias("__right"))
    x = F.col("__x")
    near = inner.join(ends, [group, "__cell"]).select(group, F.col("__v").alias("__x"), F.coalesce("__lo", "__left").alias("__lo"), F.coalesce("__hi", "__right").alias("__hi"))
    near = near.withColumn("apart", F.round(F.least(F.abs(F.col("__lo") - x), F.abs(F.col("__hi") - x)), digits)).filter("apart is not null")
    # whatever rounds to this distance lies within half a unit of it on either side: in the cells around
    unit_of = lambda v: F.floor(v / unit)
    around = lambda side: F.sequence(unit_of(side - unit * 0.75) - 1, unit_of(side + unit * 0.75) + 1)
    tried = near.select(group, "__x", "apart", F.explode(F.array_union(around(x - F.col("apart")), around(x + F.col("apart")))).alias("__unit"))
    met = tried.join(held.withColumn("__unit", unit_of(F.col("__p"))), [group, "__unit"]).filter(F.round(F.abs(F.col("__p") - x), digits) == F.col("apart"))
    found = met.groupBy(group, "__x", "apart").agg(F.max(key).alias(key))
    kinds = every.groupBy(group, F.when(finite(F.col("__p")), 0.0).otherwise(F.col("__p")).alias("__p")).agg(F.max(key).alias(key))
    rest = asked.join(found.select(F.col(group).alias("__g"), F.col("__x").alias("__f")), (F.col(group) == F.col("__g")) & F.col("__x").eqNullSafe(F.col("__f")), "left_anti")
    rest = rest.join(kinds, group).select(group, "__x", F.round(F.abs(F.col("__p") - x), digits).alias("apart"), key)
    return found.select(group, "__x", "apart", key).unionByName(rest).withColumnRenamed("__x", at)


def content_id(prefix: str, *cols: Column, digits: int = 12) -> Column:
    """An id from what the row says: prefix and the first digits of a SHA-256."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *cols), 256), 1, digits))


def set_difference_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys only left, only right and in both; both directions in one full join of distinct keys."""
    a, b = left.select(F.col(key).alias("a")).distinct(), right.select(F.col(key).alias("b")).distinct()
    both = a.join(b, F.col("a") == F.col("b"), "full")
    return both.agg(F.count_if(F.col("b").isNull()).alias("only_left"), F.count_if(F.col("a").isNull()).alias("only_right"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("shared"))


def nearest_rank(df: DataFrame, key: str, value: str, shares: dict[str, float]) -> DataFrame:
    """Order statistics by index min(n - 1, int(f * n)), no interpolation."""
    w = Window.partitionBy(key).orderBy(value)
    ranked = df.filter(F.col(value).isNotNull()).withColumn("__i", F.row_number().over(w) - 1).withColumn("__n", F.count("*").over(Window.partitionBy(key)))
    picks = [F.max(F.when(F.col("__i") == F.least(F.col("__n") - 1, F.floor(F.lit(f) * F.col("__n"))), F.col(value))).alias(name) for name, f in shares.items()]
    return ranked.groupBy(key).agg(*picks)
