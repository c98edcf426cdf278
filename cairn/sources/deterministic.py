"""Tables as gzip files whose bytes depend on the rows and their order alone.

Rows are numbered by their declared order, then by all other cells, range by range; every so many of them are one
file.  So a file holds the same rows whatever the number of partitions, and its bytes hold no time, name or
host.  Tasks write under temporary names in the target's folder, and the files get their names once all are written; the list of them
comes last, so a folder without the list is not whole.  Files joined in name order are one gzip file.
"""

from __future__ import annotations

import csv
import gzip
import hashlib
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from .tabular import Refused, require_columns

FORMAT = "cairn_gzip_tsv"
ROWS = 1_000_000
LIST = "files.json"
TEMPORARY = "_temporary"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def write_text(path: str, text: str) -> None:
    """A small file, written under another name first."""
    store, at = _open(path)
    temporary = f"{at}.{uuid.uuid4().hex}"
    with store.open_output_stream(temporary) as out:
        out.write(text.encode())
    store.move(temporary, at)


@dataclass
class Part:
    name: str
    temporary: str
    rows: int
    size: int
    sha256: str


@dataclass
class Parts(WriterCommitMessage):
    parts: list[Part]


class _Member:
    """One file being written: a gzip member without name and time, and the digest of its bytes."""

    def __init__(self, store: fs.FileSystem, folder: str, number: int):
        self.name, self.temporary = f"part-{number:08d}.tsv.gz", f"{folder}/{TEMPORARY}/{uuid.uuid4().hex}"
        self.rows, self.digest, self.size = 0, hashlib.sha256(), 0
        self.out = store.open_output_stream(self.temporary)
        self.packed = gzip.GzipFile(filename="", mode="wb", compresslevel=6, fileobj=self, mtime=0)
        self.text = io.TextIOWrapper(self.packed, encoding="utf-8", newline="")
        self.lines = csv.writer(self.text, delimiter="\t", lineterminator="\n", quoting=csv.QUOTE_MINIMAL)

    def write(self, data: bytes) -> int:
        self.digest.update(data)
        self.size += len(data)
        self.out.write(data)
        return len(data)

    def flush(self) -> None:
        pass

    def close(self) -> Part:
        self.text.close()
        self.out.close()
        return Part(self.name, self.temporary, self.rows, self.size, self.digest.hexdigest())


class GzipWriter(DataSourceArrowWriter):
    """Writes rows whose first column is the number of their file; a file's rows come one after the other."""

    def __init__(self, path: str, columns: list[str], overwrite: bool):
        self.path, self.columns, self.overwrite = path, columns, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        store, folder = _open(self.path)
        store.create_dir(f"{folder}/{TEMPORARY}")
        parts: list[Part] = []
        member, number = None, None
        for batch in iterator:
            for at, *cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != number:
                    parts += [member.close()] if member else []
                    member, number = _Member(store, folder, at), at
                member.lines.writerow(cells)
                member.rows += 1
        parts += [member.close()] if member else []
        return Parts(parts)

    def commit(self, messages: list[Parts | None]) -> None:
        store, folder = _open(self.path)
        store.create_dir(f"{folder}/{TEMPORARY}")
        head = _Member(store, folder, 0)
        head.lines.writerow(self.columns[1:])
        parts = sorted([head.close(), *(p for m in messages if m for p in m.parts)], key=lambda p: p.name)
        if self.overwrite:
            for old in store.get_file_info(fs.FileSelector(folder)):
                if old.base_name.startswith("part-") or old.base_name == LIST:
                    store.delete_file(old.path)
        for p in parts:
            store.move(p.temporary, f"{folder}/{p.name}")
        store.delete_dir(f"{folder}/{TEMPORARY}")
        rows = [{"name": p.name, "rows": p.rows, "bytes": p.size, "sha256": p.sha256} for p in parts]
        write_text(f"{self.path}/{LIST}", json.dumps(rows, indent=1) + "\n")

    def abort(self, messages: list[Parts | None]) -> None:
        store, folder = _open(self.path)
        store.delete_dir(f"{folder}/{TEMPORARY}")


class GzipSource(DataSource):
    """The format `cairn_gzip_tsv`; `write_deterministic` numbers the rows for it."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> GzipWriter:
        return GzipWriter(self.options["path"], schema.names, overwrite)


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """`df` with __n, its place from 0 by `order` and then by all cells: ranges are numbered apart, after those before them."""
    keys = [*order, *(c for c in df.columns if c not in order)]
    parts = df.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id())
    parts = parts.checkpoint()  # ranges are drawn from a sample: they are fixed before they are counted
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.groupBy("__part").agg(F.count("*").alias("n")).select("__part", F.coalesce(before, F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*keys)) - 1
    return parts.withColumn("__n", place).join(starts, "__part").withColumn("__n", F.col("__n") + F.col("__start")).drop("__part", "__start")


def write_deterministic(df: DataFrame, path: str, declared: list[str], order: list[str], rows: int = ROWS, overwrite: bool = False) -> list[dict]:
    """The declared columns as tab-separated gzip files of `rows` rows each, in `order`; name, rows, bytes and sha256 of each file.

    The first file holds the header alone.  Nulls are empty; cells are quoted where they must be.  A folder that holds files is refused unless `overwrite`.
    """
    store, folder = _open(path)
    if not overwrite and store.get_file_info(folder).type != fs.FileType.NotFound:
        raise Refused(f"{path} exists")
    df.sparkSession.dataSource.register(GzipSource)
    text = require_columns(df, declared).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in declared])
    ready = numbered(text, order).withColumn("__file", F.floor(F.col("__n") / rows) + 1)
    ready = ready.repartition("__file").sortWithinPartitions("__file", "__n").select(F.col("__file").cast("long"), *declared)
    ready.write.format(FORMAT).option("path", path).mode("overwrite" if overwrite else "append").save()
    with store.open_input_stream(f"{folder}/{LIST}") as f:
        return json.loads(f.read())


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """name, rows, bytes, sha256 of the files that `write_deterministic` left."""
    return spark.read.json(f"{path}/{LIST}", multiLine=True).select("name", "rows", "bytes", "sha256")


def write_transport(df: DataFrame, path: str, canonical: list[str], pending: dict[str, str], provenance: DataFrame | None = None) -> dict:
    """Those of the canonical columns that `df` has, and beside them coverage.json, which says what they hold and why others are missing.

    Rows and filled cells are counted in the pass that writes.  Every canonical column is either there or pending with a reason.
    """
    there = [c for c in canonical if c in df.columns]
    unsaid = [c for c in canonical if c not in there and not pending.get(c)]
    if unsaid or set(there) & set(pending) or len(there) < len(df.columns):
        raise Refused(f"columns {unsaid} without a reason, {sorted(set(there) & set(pending))} both there and pending, {[c for c in df.columns if c not in there]} not canonical")
    seen = Observation("transport")
    text = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in there])
    counts = [F.count(F.lit(1)).alias("rows"), *(F.count(F.nullif(F.col(c), F.lit(""))).alias(c) for c in there)]
    text.observe(seen, *counts).write.csv(f"{path}/rows", sep="\t", header=True, quote='"', escape='"', emptyValue="", nullValue="", compression="gzip", mode="errorifexists")
    got = seen.get
    fields = sorted(r[0] for r in provenance.select("canonical_field").distinct().collect()) if provenance is not None else []
    coverage = {"canonical_columns": canonical, "transported_columns": there, "pending_columns": pending, "provenance_fields": fields, "rows": got["rows"], "filled": {c: got[c] for c in there}}
    write_text(f"{path}/coverage.json", json.dumps(coverage, indent=2) + "\n")
    return coverage
