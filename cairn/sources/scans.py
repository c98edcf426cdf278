"""Small scans that check what they read, and the repair of rows whose last column spilled over."""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tabular import Refused, require_columns, require_count, require_unique

COVERAGE = ("accession", "version", "tier", "family", "virus_type", "block", "present", "source_nt", "block_nt", "absence_reason")
REFUSED = "refused"


def _header(spark: SparkSession, path: str, sep: str) -> list[str]:
    first = spark.read.text(path).limit(1).collect()
    return first[0].value.removeprefix("\ufeff").split(sep) if first else []


def joined_payload(payload: str) -> str | None:
    """The text that an earlier tool split at commas and left as a printed list; None if it is no such list."""
    try:
        got = ast.literal_eval(payload.strip())
    except (ValueError, SyntaxError, MemoryError, RecursionError):
        return None
    # elements keep the blank that followed their comma, and empty ones stand for commas of their own
    return ",".join(got) if isinstance(got, list) and all(isinstance(x, str) for x in got) else None


def read_spilled(spark: SparkSession, path: str, declared: list[str], reason: str, strict: bool = True) -> DataFrame:
    """The declared columns of comma-separated files, and `refused`: rows with more cells than columns are mended or refused.

    Spark keeps the text of rows that the schema refuses; only these are read again, with room for two more
    cells.  One further cell that holds a printed list of texts goes back to the end of `reason`; anything else is refused, with why
    in `refused`, null elsewhere.  `strict` raises if a row is refused, with their number.  A header may end in a nameless column.
    """
    header = _header(spark, path, ",")
    spare = ["__spill"] if len(header) == len(declared) + 1 and not header[-1] else []
    if header[: len(declared)] != declared or len(header) != len(declared) + len(spare):
        raise Refused(f"columns {header}, not {declared}")
    names = declared + spare
    schema = lambda columns: ", ".join(f"`{c}` string" for c in columns)
    options = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    read = spark.read.options(header=True, enforceSchema=True, multiLine=True, columnNameOfCorruptRecord="__bad", **options)
    rows = read.schema(f"{schema(names)}, __bad string").csv(path)
    wide = [*declared, "__one", "__two"]
    again = F.when(F.col("__bad").isNotNull(), F.from_csv("__bad", schema(wide), options))
    cells = F.size(F.split("__bad", ","))
    sound = {**{c: F.col(c) for c in declared}, "__one": F.col("__spill") if spare else F.lit(None).cast("string"), "__two": F.lit(None).cast("string")}
    rows = rows.withColumn("__x", again)
    cell = {c: F.when(F.col("__bad").isNull(), sound[c]).otherwise(F.col("__x")[c]) for c in wide}
    every = rows.select(*(F.coalesce(x, F.lit("")).alias(c) for c, x in cell.items()), F.coalesce(cells < len(names), F.lit(False)).alias("__short"))

    def mend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["__tail"] = [joined_payload(x) for x in pdf["__one"]]
            yield pdf

    spilled = (F.trim("__one") != "") & (F.trim("__two") == "") & ~F.col("__short")
    kept = every.filter(~spilled).withColumn("__tail", F.lit(None).cast("string"))
    mended = every.filter(spilled).mapInPandas(mend, f"{schema(wide)}, __short boolean, __tail string")
    why = (
        F.when(F.col("__short"), "fewer cells than columns")
        .when((F.trim("__one") != "") & (F.trim("__two") != ""), "more than one cell beyond the columns")
        .when(F.trim("__two") != "", "a cell beyond the nameless column")
        .when((F.trim("__one") != "") & F.col("__tail").isNull(), "the cell beyond the columns is no printed list of texts")
    )
    out = kept.unionByName(mended).withColumn(REFUSED, why)
    whole = F.when(F.col("__tail").isNotNull() & (F.col("__tail") != ""), F.concat(reason, F.lit(","), "__tail")).otherwise(F.col(reason))
    out = out.select(*(whole.alias(c) if c == reason else F.col(c) for c in declared), REFUSED)
    if strict:
        # whole rows are asked for: Spark refuses a scan of refused texts alone
        bad = out.filter(f"{REFUSED} IS NOT NULL").agg(F.count("*").alias("n"), F.first(F.struct(*declared, REFUSED)).alias("one")).first()
        if bad.n:
            raise Refused(f"{bad.n} rows: {bad.one}")
    return out.drop(REFUSED) if strict else out


def row_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id, ordinal): the distinct first words of an alignment's lines by first sight, counted from 0; marks, ends and blank lines have none.

    Rows may come whole or in several blocks.  A line's place is its file, its split of the file, and its number there; no
    sort of all lines is needed: the first places are counted by split, and numbered within each.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"))
    lines = lines.filter(~F.col("value").startswith("#") & ~F.col("value").startswith("//") & (F.trim(F.regexp_replace("value", r"\s", " ")) != ""))
    name = F.regexp_extract("value", r"^\s*(\S+)", 1)
    first = lines.groupBy(name.alias("id")).agg(F.min(F.struct("file", "split", "line")).alias("at")).select("id", "at.*")
    before = F.sum("n").over(Window.orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1))
    starts = first.groupBy("file", "split").agg(F.count("*").alias("n")).select("file", "split", F.coalesce(before, F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("file", "split").orderBy("line")) - 1
    return first.withColumn("place", place).join(starts, ["file", "split"]).select("id", (F.col("start") + F.col("place")).cast("long").alias("ordinal"))


def _exact(spark: SparkSession, path: str, declared: list[str] | tuple[str, ...], sep: str) -> DataFrame:
    """Files with just these columns in this order; a row with more or fewer cells fails when it is read."""
    if _header(spark, path, sep) != list(declared):
        raise Refused(f"columns {_header(spark, path, sep)}, not {list(declared)}")
    schema = ", ".join(f"`{c}` string" for c in declared)
    return spark.read.schema(schema).csv(path, sep=sep, header=True, quote='"', escape='"', mode="FAILFAST").fillna("")


def read_coverage(spark: SparkSession, path: str) -> DataFrame:
    """The coverage rows of an alignment; `present` is a boolean and both lengths are numbers."""
    rows = _exact(spark, path, COVERAGE, "\t")
    return rows.withColumns({"present": F.col("present") == "TRUE", "source_nt": F.col("source_nt").cast("long"), "block_nt": F.col("block_nt").cast("long")})


def write_coverage(rows: DataFrame, path: str) -> None:
    """Coverage rows in their order of accession and block, booleans as TRUE and FALSE."""
    cell = {"present": F.when(F.col("present"), "TRUE").otherwise("FALSE")}
    text = require_columns(rows, COVERAGE).select(*[F.coalesce(cell.get(c, F.col(c)).cast("string"), F.lit("")).alias(c) for c in COVERAGE])
    text.orderBy("accession", "block").write.csv(path, sep="\t", header=True, quote="", emptyValue="", mode="errorifexists")


REGIONS = ("serotype", "ref_accession", "region", "start", "end", "length")


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """(serotype, regions): the map of each serotype's regions to (start, end), counted from 1, ends included; a region that repeats raises."""
    rows = require_unique(_exact(spark, path, REGIONS, "\t"), "serotype", "region")
    span = F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    return rows.groupBy("serotype").agg(F.map_from_entries(F.collect_list(F.struct("region", span.alias("span")))).alias("regions"))


def write_regions(rows: DataFrame, path: str) -> None:
    """Regions by serotype and start, as tab-separated text with its header."""
    text = require_columns(rows, REGIONS).orderBy("serotype", F.col("start").cast("int")).select(*[F.col(c).cast("string").alias(c) for c in REGIONS])
    text.write.csv(path, sep="\t", header=True, quote="", emptyValue="", mode="errorifexists")


def read_file_list(spark: SparkSession, path: str) -> DataFrame:
    """(path, hash_scope, sha256) of a release's list of files; further columns are dropped; a path that repeats and an empty list raise."""
    rows = spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', inferSchema=False)
    missing = [c for c in ("path", "hash_scope", "sha256") if c not in rows.columns]
    if missing:
        raise Refused(f"missing columns {missing}")
    return require_unique(rows.select("path", "hash_scope", "sha256").fillna(""), "path")


def read_allowlist(spark: SparkSession, path: str, declared: list[str], rows: int, key: str = "accession") -> DataFrame:
    """A comma-separated list of just these columns, this many rows, and no key twice."""
    return require_unique(require_count(_exact(spark, path, declared, ","), rows), key)


LEFT, RIGHT = "\u201c", "\u201d"


def plain_problem(c: Column) -> Column:
    """Why a cell cannot be written without quoting, null if it can."""
    quotes = F.regexp_count(c, F.lit('"'))
    return F.when(c.rlike("[\t\r\n]"), "holds a tab or line break").when(c.rlike(f"[{LEFT}{RIGHT}]"), "holds typographic quotes already").when(quotes % 2 == 1, "holds an odd number of quotes")


def plain(c: Column) -> Column:
    """A cell that needs no quoting: each pair of quotes becomes a typographic one; null where `plain_problem` has a reason."""
    mark = lambda i: F.when(i == 0, "").when(i % 2 == 1, LEFT).otherwise(RIGHT)
    paired = F.array_join(F.transform(F.split(c, '"', -1), lambda p, i: F.concat(mark(i), p)), "")
    return F.when(plain_problem(c).isNull(), paired)
