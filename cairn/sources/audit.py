"""Sinks of what rules and decisions did, and the check of a release's list of files.

All of them refuse a folder that exists, and columns that are not declared (`tabular`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tabular import Refused, require_columns, require_unique, write_tsv


def write_provenance(projected: DataFrame, path: str) -> None:
    """Rows of `rules.project`, a folder per canonical column: reading one column reads its files only."""
    projected.write.partitionBy("canonical_field").parquet(path, compression="zstd", mode="errorifexists")


def write_ordered(df: DataFrame, path: str, declared: list[str] | tuple[str, ...], order: str) -> int:
    """The declared columns as tab-separated text in the order of a number, which is not written; the number of rows.

    Files in name order follow each other.  An order that repeats would not be one, and raises; so does an empty table.
    """
    ordered = require_unique(df, order).orderBy(order)
    return write_tsv(ordered.select(*[F.col(c).cast("string").alias(c) for c in df.columns if c != order or order in declared]), path, declared)


def unversioned(name: str):
    """What stands before the last dot of a name; a name without a dot has none."""
    return F.regexp_extract(name, r"(?s)^(.*)\.[^.]*$", 1)


def write_divergence(measures: DataFrame, path: str, version: str = "version") -> None:
    """Parquet of measures with `accession`, their version's name before its last dot, sorted by version within files."""
    if "accession" in measures.columns:
        raise Refused("accession is derived here")
    measures.select(unversioned(version).alias("accession"), "*").sortWithinPartitions(version).write.parquet(path, compression="zstd", mode="errorifexists")


def write_queue(df: DataFrame, path: str, declared: list[str] | tuple[str, ...]) -> None:
    """A plain tab-separated queue: cells that would need quotes are refused, nulls are empty."""
    df = require_columns(df, declared).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in declared])
    bad = df.filter(F.concat_ws("\0", *declared).rlike("[\t\r\n]")).limit(1).collect()
    if bad:
        raise Refused(f"a cell holds a tab or line break: {bad[0].asDict()}")
    df.write.csv(path, sep="\t", header=True, quote="", emptyValue="", mode="errorifexists")


def manifest_problems(declared: DataFrame, carried: DataFrame, present: DataFrame) -> DataFrame:
    """(path, problem) of three lists of paths: what is declared or carried must be present, and be only one of the two."""
    parts = [df.select("path", F.lit(i).alias("i")) for i, df in enumerate((declared, carried, present))]
    has = [F.bool_or(F.col("i") == i) for i in range(3)]
    seen = parts[0].union(parts[1]).union(parts[2]).groupBy("path").agg(*(h.alias(n) for h, n in zip(has, ("d", "c", "p"), strict=True)))
    problem = F.when(F.col("d") & F.col("c"), "declared and carried").when(~F.col("p"), "missing").when(~F.col("d") & ~F.col("c"), "undeclared")
    return seen.select("path", problem.alias("problem")).filter("problem is not null")
