"""Tables, FASTA and Stockholm files: readers that check what they read, and writers of the same forms.

Readers and writers are Spark's own; what a format demands (a declared header, a count, unique names,
one width) is checked by an aggregation and raises.  A check that has nothing to examine raises too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Refused(ValueError):
    """An input or output is not what was declared."""


def require_columns(df: DataFrame, declared: list[str] | tuple[str, ...]) -> DataFrame:
    """`df` with the declared columns in that order; missing and undeclared ones raise."""
    missing, extra = [c for c in declared if c not in df.columns], [c for c in df.columns if c not in declared]
    if missing or extra:
        raise Refused(f"missing columns {missing}, undeclared columns {extra}")
    return df.select(*declared)


def require_count(df: DataFrame, declared: int) -> DataFrame:
    n = df.count()
    if n != declared:
        raise Refused(f"{n} rows; {declared} are declared")
    return df


def require_unique(df: DataFrame, *key: str) -> DataFrame:
    """Raises where a key repeats, and where there is no row."""
    got = df.groupBy(*key).count().agg(F.count("*").alias("keys"), F.max("count").alias("most"), F.min_by(F.struct(*key), -F.col("count")).alias("which")).first()
    if not got.keys:
        raise Refused("no row to examine")
    if got.most > 1:
        raise Refused(f"{got.which} occurs {got.most} times")
    return df


def read_tsv(spark: SparkSession, path: str, declared: list[str] | tuple[str, ...]) -> DataFrame:
    """A tab-separated file with its header checked; quoted fields may hold tabs and line breaks; all cells are text, blank ones empty."""
    df = spark.read.csv(path, sep="\t", header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST", inferSchema=False)
    return require_columns(df, declared).fillna("")


def write_tsv(df: DataFrame, path: str, declared: list[str] | tuple[str, ...]) -> int:
    """The declared columns, all of them text, as tab-separated files; the number of rows."""
    df = require_columns(df, declared)
    other = [f.name for f in df.schema.fields if f.dataType.simpleString() != "string"]
    if other:
        raise Refused(f"columns {other} are not text")
    df.write.csv(path, sep="\t", header=True, quote='"', escape='"', emptyValue="", nullValue="", compression="gzip", mode="errorifexists")
    return df.count()


def write_relational(df: DataFrame, path: str, numbers: frozenset[str] | set[str] = frozenset()) -> None:
    """Parquet with empty text as null and the named columns as bigint."""
    cell = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    df.select(*[(cell(c).cast("long") if c in numbers else cell(c)).alias(c) for c in df.columns]).write.parquet(path, compression="zstd")


def read_fasta(spark: SparkSession, path: str, strip_version: bool = False) -> DataFrame:
    """(id, sequence): one row per `>` block, wrapped lines joined, upper case; a repeated id raises."""
    blocks = spark.read.option("lineSep", ">").text(path).filter(F.trim(F.regexp_replace("value", r"\s", "")) != "")
    head = F.regexp_extract("value", r"^\s*(\S+)", 1)
    name = F.regexp_replace(head, r"\.[0-9]+$", "") if strip_version else head
    body = F.when(F.instr("value", "\n") > 0, F.substr("value", F.instr("value", "\n") + 1)).otherwise("")
    return require_unique(blocks.select(name.alias("id"), F.upper(F.regexp_replace(body, r"\s", "")).alias("sequence")), "id")


def write_fasta(df: DataFrame, path: str, width: int = 70) -> None:
    """(id, sequence) in order of id, lines wrapped; files in name order follow each other."""
    wrapped = F.regexp_replace("sequence", rf"(.{{{width}}})(?!$)", "$1\n")
    df.orderBy("id").select(F.concat(F.lit(">"), "id", F.lit("\n"), wrapped).alias("value")).write.text(path)


def read_stockholm(spark: SparkSession, path: str, strict: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """(id, row) of an alignment whose rows may come in several blocks, and its per-column lines by tag.

    `strict` refuses an id that comes twice.  Rows of unequal width raise.
    """
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id()).filter("value <> '' and value <> '//'")
    column = lines.filter("value like '#=GC %'").select(F.regexp_extract("value", r"^#=GC\s+(\S+)\s+(\S+)", 1).alias("id"), F.regexp_extract("value", r"^#=GC\s+(\S+)\s+(\S+)", 2).alias("part"), "at")
    rows = lines.filter("value not like '#%'").select(F.regexp_extract("value", r"^(\S+)\s+(\S+)", 1).alias("id"), F.regexp_extract("value", r"^(\S+)\s+(\S+)", 2).alias("part"), "at")
    if strict:
        require_unique(rows, "id")
    join = lambda df: df.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda x: x["part"]), "").alias("row"))
    out = join(rows)
    widths = out.agg(F.min(F.length("row")).alias("lo"), F.max(F.length("row")).alias("hi")).first()
    if widths.lo is None:
        raise Refused("no row to examine")
    if widths.lo != widths.hi:
        raise Refused(f"rows of {widths.lo} to {widths.hi} columns")
    return out, {r.id: r.row for r in join(column).collect()}


def write_stockholm(df: DataFrame, path: str, columns: dict[str, str] | None = None) -> None:
    """(id, row) in order of id, ids padded to one width, then the per-column lines."""
    spark, tags = df.sparkSession, columns or {}
    most = df.agg(F.max(F.length("id")).alias("w")).first().w
    if most is None:
        raise Refused("no row to examine")
    width = max([most, *(len(f"#=GC {t}") for t in tags)])
    head = spark.createDataFrame([(0, "", "# STOCKHOLM 1.0")], "k int, id string, value string")
    body = df.select(F.lit(1).alias("k"), "id", F.concat(F.rpad("id", width, " "), F.lit(" "), "row").alias("value"))
    tail = spark.createDataFrame([*((2, f"{i:04d}", f"{f'#=GC {t}':<{width}} {x}") for i, (t, x) in enumerate(tags.items())), (3, "", "//")], "k int, id string, value string")
    head.union(body).union(tail).orderBy("k", "id").select("value").write.text(path)
