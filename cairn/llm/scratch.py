"""Shared scratch space: tables written once so that later stages never recompute them.

Everything goes to the folder in ``spark.checkpoint.dir``, which every executor can read,
so a lost executor costs only the tasks it was running.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: when a query ends, Spark removes the shuffle files that only it could read
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_here = threading.local()
_lock = threading.Lock()
_cleaning: dict[int, tuple[int, str | None]] = {}


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """CLEAN_UP is on while any thread writes; the last one to end puts back what the session had."""
    with _lock:
        n, before = _cleaning.get(id(spark), (0, None))
        if not n:
            before = spark.conf.get(CLEAN_UP, None)
            spark.conf.set(CLEAN_UP, "true")
        _cleaning[id(spark)] = n + 1, before
    try:
        yield
    finally:
        with _lock:
            n, before = _cleaning.pop(id(spark))
            if n > 1:
                _cleaning[id(spark)] = n - 1, before
            elif before is None:
                spark.conf.unset(CLEAN_UP)
            else:
                spark.conf.set(CLEAN_UP, before)


def checkpoint_root(spark: SparkSession) -> str:
    """Folder named by the session.  Where none is set, a temporary one in local mode; on a cluster an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cairn-"))
        root = spark.sparkContext.getCheckpointDir()
    return root


class Scratch:
    """Writes intermediate tables and removes them once a later table has replaced them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        if getattr(_here, "lent", None) is not None:
            _here.lent.append(self)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with _cleaned(self.spark):
            # a plan takes the setting when it is made
            df.select("*").write.option("compression", "zstd").parquet(path)
        # the schema is known: reading with it skips inference and keeps empty tables readable
        out = self.spark.read.schema(df.schema).parquet(path)
        out._cairn_path = path
        return out

    def _delete(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            self._delete(df._cairn_path)

    def close(self) -> None:
        """Remove all tables: for when what was made of them has been written elsewhere."""
        self._delete(self.root)


@contextmanager
def lent() -> Iterator[list[Scratch]]:
    """Lists the scratch spaces that this thread opens inside, so that the caller can close them once their result is written.

    Where the work inside fails they are closed at once.
    """
    before, _here.lent = getattr(_here, "lent", None), []
    try:
        yield _here.lent
    except BaseException:
        for opened in _here.lent:
            opened.close()
        raise
    finally:
        _here.lent = before
