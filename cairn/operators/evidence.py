"""How far a record lies from its reference: letters of a region, else of the wider one; residues against several references.

No gaps are placed: a record is laid along the diagonal on which most seeds of the region agree, on either strand.  Tasks
count, chunk by chunk, what compares and what differs; all rules (floors, guards, which strand, which
region) are expressions over these counts.  Nothing is shuffled.

A reference row has reference, region_lo, region_hi, wide_lo: the region is [region_lo, region_hi), the wide one
[wide_lo, region_hi), whose codons start at wide_lo; positions count from 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import AMINO_ACIDS
from .sequence import BROADCAST_SEEDS, IMPLAUSIBLE_PERCENT, MIN_ANCHORS, MIN_COMPARED, SEED

# Chunks of the guard, how many letters a chunk must compare, how many such chunks there must be, how many
# points one may differ from the whole, and from which length on a region needs no guard; names of what was measured.
CHUNK, CHUNK_LEAST, CHUNKS_LEAST, DEVIATION, GUARDED_BELOW = 150, 30, 2, 15.0, 300
REGION, WIDE = "VP1", "P1_capsid"
BY_BAND = {REGION: "VP1_serotype_from_membership_band", WIDE: "P1_capsid_serotype_from_membership_band"}

COUNTS = "strand string, wide boolean, sizes array<int>, differ array<int>, codons int, same int"
_STRUCT = pa.struct([("strand", pa.string()), ("wide", pa.bool_()), ("sizes", pa.list_(pa.int32())), ("differ", pa.list_(pa.int32())), ("codons", pa.int32()), ("same", pa.int32())])
_TURN = str.maketrans("ACGTN", "TGCAN")
_BASE = np.full(128, 4, np.int64)
_BASE[[ord(c) for c in "TCAG"]] = range(4)
#: residues by code; a codon with a base that cannot be read is -1
_RESIDUES = np.frombuffer(AMINO_ACIDS.encode(), np.uint8).astype(np.int64)


def _letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)


def _seeds(x: np.ndarray) -> np.ndarray:
    """A number for each SEED letters in a row."""
    n = len(x) - SEED + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(SEED if n > 0 else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + x[k : k + n].astype(np.uint64)
    return out


def best_diagonal(reference: np.ndarray, query: np.ndarray, lo: int, hi: int) -> int | None:
    """The diagonal (place in the reference less place in the query) of most common seeds that begin in [lo, hi); of equals the one met first."""
    r = _seeds(reference)[lo:hi]
    order = np.argsort(r, kind="stable")
    ranked, q = r[order], _seeds(query)
    first, last = np.searchsorted(ranked, q, "left"), np.searchsorted(ranked, q, "right")
    n = last - first
    if not n.sum():
        return None
    at = np.repeat(np.arange(len(q)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    diagonals, met, votes = np.unique(order[first[at] + nth] + lo - at, return_index=True, return_counts=True)
    best = np.lexsort((met, -votes))[0]
    return int(diagonals[best]) if votes[best] >= MIN_ANCHORS else None


def _residues(x: np.ndarray) -> np.ndarray:
    codons = _BASE[np.minimum(x, 127)].reshape(-1, 3)
    code = codons @ np.array([16, 4, 1])
    return np.where((codons < 4).all(axis=1), _RESIDUES[np.minimum(code, 63)], -1)


def _sums(values: np.ndarray) -> list[int]:
    return np.add.reduceat(values, np.arange(0, len(values), CHUNK)).tolist() if len(values) else []


def counts(reference: str, query: str, lo: int, hi: int, wide_lo: int) -> list[dict]:
    """For both strands and both regions, where there is a diagonal: what compares and what differs by chunk, and residues of the wide one."""
    r, out = _letters(reference), []
    for strand, text in (("+", query), ("-", query.translate(_TURN)[::-1])):
        q = _letters(text)
        for wide, begin in ((False, lo), (True, wide_lo)):
            diagonal = best_diagonal(r, q, begin, hi)
            if diagonal is None:
                continue
            first, last = max(begin, diagonal), min(hi, len(r), len(q) + diagonal)
            if first >= last:
                continue
            x, y = r[first:last], q[first - diagonal : last - diagonal]
            # the wide region counts only letters that can be read on both sides
            read = (_BASE[np.minimum(x, 127)] < 4) & (_BASE[np.minimum(y, 127)] < 4) if wide else np.ones(len(x), bool)
            skip = -(first - wide_lo) % 3
            whole = max(0, (len(x) - skip) // 3) * 3
            a, b = _residues(x[skip : skip + whole]), _residues(y[skip : skip + whole])
            both = (a >= 0) & (b >= 0)
            out.append({"strand": strand, "wide": wide, "sizes": _sums(read.astype(np.int64)), "differ": _sums((read & (x != y)).astype(np.int64)), "codons": int(both.sum()), "same": int((both & (a == b)).sum())})
    return out


def counted(records: DataFrame, references: DataFrame, key: str | None = "ref_id") -> DataFrame:
    """The rows of `records` (sequence and others) with `found`, the counts against their reference by `key`, or against every reference.

    References are broadcast if their letters are few, which is counted; every reference is taken only if they are few.
    """
    size = references.agg(F.sum(F.length("reference"))).first()[0] or 0
    refs = references.withColumn("reference", F.upper("reference"))
    if key:
        rows = records.join(F.broadcast(refs) if size <= BROADCAST_SEEDS else refs, key)
    elif size <= BROADCAST_SEEDS:
        every = refs.agg(F.collect_list(F.struct(*refs.columns)).alias("refs")).scalar()
        rows = records.withColumn("__ref", F.explode(every)).select(*records.columns, "__ref.*")
    else:
        raise ValueError(f"{size} letters of references are too many to be compared with every record")
    rows = rows.withColumn("sequence", F.upper("sequence"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("reference", "sequence", "region_lo", "region_hi", "wide_lo")]
            found = [counts(r, q or "", lo, hi, wide) for r, q, lo, hi, wide in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(_STRUCT))], [*batch.schema.names, "found"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, found array<struct<{', '.join(x.replace(' ', ':', 1) for x in COUNTS.split(', '))}>>")


def homogeneous(sizes: Column, differ: Column, whole: Column) -> Column:
    """Whether chunks that compare enough are enough, and none differs far more or less than the whole."""
    rates = F.transform(F.filter(F.arrays_zip(sizes.alias("n"), differ.alias("d")), lambda c: c["n"] >= CHUNK_LEAST), lambda c: c["d"] * 100.0 / c["n"])
    return (F.size(rates) >= CHUNKS_LEAST) & F.forall(rates, lambda x: F.abs(x - whole) <= DEVIATION)


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda s, x: s + x)


def letters_apart(found: Column, wide: bool) -> Column:
    """(percent, compared, strand) of a region: of the strands that pass the floor and the guard, the one that compares more, the given one at ties."""

    def measure(c: Column) -> Column:
        n = _total(c["sizes"])
        return F.struct(n.alias("compared"), (c["strand"] == "+").alias("ahead"), F.when(n > 0, _total(c["differ"]) * 100.0 / n).alias("percent"), c["strand"].alias("strand"), c["sizes"].alias("sizes"), c["differ"].alias("differ"))

    def passes(m: Column) -> Column:
        guarded = homogeneous(m["sizes"], m["differ"], m["percent"])
        return (m["compared"] >= MIN_COMPARED) & (m["percent"] <= IMPLAUSIBLE_PERCENT) & (guarded if wide else (m["compared"] >= GUARDED_BELOW) | guarded)

    best = F.array_max(F.filter(F.transform(F.filter(found, lambda c: c["wide"] == F.lit(wide)), measure), passes))
    return F.when(best.isNotNull(), F.struct(best["percent"].alias("percent"), best["compared"].alias("compared"), best["strand"].alias("strand")))


def residues_apart(found: Column) -> Column:
    """(percent, codons, strand) of the wide region in the reference's frame: the strand that differs least, then compares more."""

    def measure(c: Column) -> Column:
        return F.struct(((c["codons"] - c["same"]) * 100.0 / c["codons"]).alias("percent"), (-c["codons"]).alias("less"), (c["strand"] != "+").alias("behind"), c["strand"].alias("strand"))

    usable = F.filter(found, lambda c: c["wide"] & (c["codons"] > 0))
    best = F.array_min(F.filter(F.transform(usable, measure), lambda m: m["percent"] <= IMPLAUSIBLE_PERCENT))
    return F.when(best.isNotNull(), F.struct(best["percent"].alias("percent"), (-best["less"]).alias("codons"), best["strand"].alias("strand")))


def measure_evidence(records: DataFrame, references: DataFrame) -> DataFrame:
    """`records` (ref_id, sequence, by_band and others) with percent, compared, strand and basis: the region if it can be measured, else the wide one.

    Records that neither measures, or without reference or sequence, have no row.  `by_band` says that the reference was chosen by another measurement.
    """
    rows = counted(records, references)
    rows = rows.withColumn("__near", letters_apart(F.col("found"), False)).withColumn("__wide", letters_apart(F.col("found"), True))
    name = lambda kind: F.when(F.coalesce("by_band", F.lit(False)), BY_BAND[kind]).otherwise(kind)
    rows = rows.withColumn("basis", F.when(F.col("__near").isNotNull(), name(REGION)).when(F.col("__wide").isNotNull(), name(WIDE))).withColumn("m", F.coalesce("__near", "__wide"))
    return rows.filter("m IS NOT NULL").select(*records.columns, "m.*", "basis")


def nearest_reference(records: DataFrame, references: DataFrame) -> DataFrame:
    """`records` (version, sequence and others) with ref_id, percent, codons and strand of the reference that is nearest in residues.

    Ties go to more codons, then to the smaller ref_id.  The references are few: their letters are counted, and a task compares a record with all.
    """
    rows = counted(records, references, None).withColumn("m", residues_apart(F.col("found"))).filter("m IS NOT NULL")
    best = F.min_by(F.struct("ref_id", "m", *(c for c in records.columns if c != "version")), F.struct("m.percent", -F.col("m.codons"), "ref_id")).alias("b")
    out = rows.groupBy("version").agg(best)
    return out.select("version", *(F.col(f"b.{c}").alias(c) for c in records.columns if c not in ("version", "sequence")), "b.ref_id", F.col("b.m.percent").alias("percent"), F.col("b.m.codons").alias("codons"), F.col("b.m.strand").alias("strand"))
