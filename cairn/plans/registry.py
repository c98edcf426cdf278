"""Registration of queries: a Spark plan and, where SQL can say it, the SQL that it must match."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a folder of Parquet files, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Spark SQL in which @name stands for a table of the folder."""
        return self.spark.sql(re.sub(r"@(\w+)", lambda m: f"parquet.`{self.folder}/{m[1]}.parquet`", text))


def query(oracle: str | None = None):
    """Register a function of `Tables` under its name, with its DuckDB SQL."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def ansi(name: str, text: str) -> None:
    """Register one text that both engines read alike; @name stands for a table."""
    QUERIES[name] = lambda spark, folder: Tables(spark, folder).sql(text)
    ORACLES[name] = re.sub(r"@(\w+)", r"\1", text)
