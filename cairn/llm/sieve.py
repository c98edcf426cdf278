"""Sieves: bit maps of fixed size that keep rows out of a shuffle whose keys cannot match.

A map sets one bit for each key of a table.  Rows whose bit is not set match nothing and stay where
they are; the others go on to an exact join, so a full map costs time and never a row.  The map is one
array of 2**MAP_BITS bits, whatever the table's size: the only thing that is sent to every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP_BITS = 24


def bit_map(keys: DataFrame, key: str, log_bits: int = MAP_BITS) -> Column:
    """A scalar: one array of 64-bit words; bit `key mod 2**log_bits` is set for each long `key` of `keys`."""
    slot = F.col(key).bitwiseAND((1 << log_bits) - 1)
    bits = keys.groupBy(F.shiftright(slot, 6).alias("id")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(`{key}` & 63 as int))")).alias("bits"))
    words = keys.sparkSession.range(1 << (log_bits - 6)).join(bits, "id", "left").select(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits")).alias("w"))
    return words.agg(F.transform(F.array_sort(F.collect_list("w")), lambda w: w["bits"]).alias("map")).scalar()


def may_be_in(bits: Column, key: Column, log_bits: int = MAP_BITS) -> Column:
    slot = key.bitwiseAND((1 << log_bits) - 1)
    word = F.get(bits, F.shiftright(slot, 6).cast("int"))
    return F.call_function("getbit", word, key.bitwiseAND(63).cast("int")) == 1


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """`rows` whose `key` is not in `gone`; only rows that may be are shuffled.  Null keys stay."""
    bits = bit_map(gone.select(F.xxhash64(key).alias("__key")), "__key")
    listed = may_be_in(bits, F.xxhash64(key))
    return rows.filter(~listed).unionByName(rows.filter(listed).join(gone.select(key).distinct(), key, "left_anti").select(*rows.columns))
