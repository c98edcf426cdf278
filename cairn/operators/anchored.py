"""Records against one reference, in the reference's own columns: codon by codon where that does no harm.

A record is aligned as it is or reverse-complemented, whichever scores more.  Within the reference's coding
span its codons are then placed by its residues: in the frame that its annotation states, else in the one
that the alignment implies.  A frame with an internal stop is parted where letters are lost or
won that are no multiple of three, and each part is placed in the reference's frame again.  Two guards stand
over this: the implied frame replaces a stated one that differs far more in residues, and the plain alignment
replaces one by codons that differs more in letters.

A record's whole way is one task without a shuffle: two passes of pairwise alignment in Arrow batches, and
expressions before, between and after.  Records without letters, or of which none falls in the span, have no row (null).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blocks as B
from . import pairwise
from .sequence import BROADCAST_SEEDS

# How many points a guard allows, and names of the ways by which a row was placed.
NUCLEOTIDE_GUARD, RESIDUE_GUARD = 2.0, 30.0
CODON, IMPLIED, RECOVERED = "codon", "codon_ref_inferred", "recovered"
CDS_FALLBACK, FALLBACK, BETTER = "nt_cds_fallback", "nt_fallback", "nt_better"
FORWARD, REVERSED = "forward", "reverse_complement"

_RUN = pa.struct([("r", pa.int32()), ("q", pa.int32()), ("n", pa.int32())])


def _as_runs(many: list) -> pa.Array:
    return pa.array([[{"r": r, "q": q, "n": n} for r, q, n in runs] for runs in many], pa.list_(_RUN))


def _with_columns(df: DataFrame, work, added: str) -> DataFrame:
    """All columns of `df` and those that `work` makes of a batch of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                new = work(batch)
                yield pa.RecordBatch.from_arrays([*batch.columns, *new.values()], [*batch.schema.names, *new])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, {added}")


def best_strand(df: DataFrame, reference: str, query: str) -> DataFrame:
    """`df` with strand, oriented and nt: the query as it stands or reverse-complemented, whichever aligns better, and its runs."""
    both = df.withColumn("__turned", B.reverse_complement(F.col(query)))

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        text = {c: batch.column(c).to_pylist() for c in (reference, query, "__turned")}
        strands, oriented, nt = [], [], []
        for r, q, turned in zip(*text.values(), strict=True):
            ahead, back = pairwise.align(r, q), pairwise.align(r, turned)
            backward = back[0] > ahead[0]
            strands.append(REVERSED if backward else FORWARD)
            oriented.append(turned if backward else q)
            nt.append((back if backward else ahead)[1])
        return {"strand": pa.array(strands), "oriented": pa.array(oriented), "nt": _as_runs(nt)}

    return _with_columns(both, work, f"strand string, oriented string, nt {B.RUNS}").drop("__turned")


def coding_start(cds: Column, strand: Column, length: Column) -> Column:
    """Where the coding text starts in the oriented query; null where annotation and alignment disagree about the strand.

    `cds` is (start, end, strand, codon_start), counted from 1 in the deposited record.
    """
    ahead = cds["start"] - 1 + cds["codon_start"] - 1
    return F.when((strand == FORWARD) & (cds["strand"] == "+"), ahead).when((strand == REVERSED) & (cds["strand"] == "-"), length - (cds["end"] - (cds["codon_start"] - 1)))


def placing(reference: Column, query: Column, r: Column, r_end: Column, q: Column, q_end: Column, lo: Column) -> Column:
    """A task of placing by residues, from the first codon of the reference's frame in the span on: (ref_aa, query_aa, r0, q0, stop)."""
    skip = F.pmod(F.lit(3) - F.pmod(r - lo, F.lit(3)), F.lit(3))
    r0, q0 = r + skip, q + skip
    fits = (r0 + 3 <= r_end) & (q0 + 3 <= q_end)
    aa = lambda text, a, b: F.when(fits, B.translate(B.cut(text, a, b))).otherwise("")
    return F.struct(aa(reference, r0, r_end).alias("ref_aa"), aa(query, q0, q_end).alias("query_aa"), r0.cast("int").alias("r0"), q0.cast("int").alias("q0"))


def _place(df: DataFrame, tasks: str, placed: str) -> DataFrame:
    """`df` with `placed`: for each of the `tasks` of a row, the runs of its residues."""

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        out = [[[{"r": r, "q": q, "n": n} for r, q, n in pairwise.align(t["ref_aa"], t["query_aa"], pairwise.PROTEINS)[1]] for t in row or ()] for row in batch.column(tasks).to_pylist()]
        return {placed: pa.array(out, pa.list_(pa.list_(_RUN)))}

    return _with_columns(df, work, f"{placed} array<{B.RUNS}>")


def place_records(df: DataFrame, nucleotide_guard: float = NUCLEOTIDE_GUARD, residue_guard: float = RESIDUE_GUARD) -> DataFrame:
    """`df` (reference, lo, hi, query, cds, bypass and others) with strand, method, internal_stop, recovered, runs, row, shifted, misphased.

    `lo` and `hi` bound the coding span of the reference; `cds` may be null; `bypass` frees a record of the nucleotide guard.
    """
    c = F.col
    lo, hi, length = c("lo"), c("hi"), F.length("oriented")
    rows = best_strand(df, "reference", "query").withColumn("__span", B.clip(c("nt"), lo, hi))
    first, last = F.get("__span", F.lit(0)), F.get("__span", F.size("__span") - 1)
    rows = rows.withColumns({
        "__start": first["q"] + F.pmod(F.lit(3) - F.pmod(first["r"] - lo, F.lit(3)), F.lit(3)),
        "__end": last["q"] + last["n"],
        "__stated": F.greatest(F.lit(0), F.least(coding_start(c("cds"), c("strand"), length), length)),
    })
    # least and greatest pass over nulls: a start that is not stated stays null
    stated = F.when(coding_start(c("cds"), c("strand"), length).isNotNull() & (F.size("__span") > 0), c("__stated"))
    rows = rows.withColumn("__stated", stated)

    def frame(start: Column) -> Column:
        end = F.least(c("__end"), length)
        aa = B.translate(B.cut(c("oriented"), start, end))
        usable = (F.size("__span") > 0) & (end - start >= 3)
        return F.when(usable, F.struct(start.cast("int").alias("q0"), aa.alias("aa"), B.has_internal_stop(aa).alias("stop")))

    rows = rows.withColumn("__frame1", frame(F.coalesce("__stated", "__start"))).withColumn("__frame2", F.when(c("__stated") != c("__start"), frame(c("__start"))))
    whole = B.translate(B.cut(c("reference"), lo, hi))
    task = lambda f: F.when(f.isNotNull() & ~f["stop"], F.struct(whole.alias("ref_aa"), f["aa"].alias("query_aa"), lo.cast("int").alias("r0"), f["q0"].alias("q0")))
    parts = F.transform(B.pieces(c("__span")), lambda p: placing(c("reference"), c("oriented"), p["r"], p["r_end"], p["q"], p["q_end"], lo))
    # frames first, then the parts of a frame that a stop breaks
    none = F.array().cast("array<struct<ref_aa:string,query_aa:string,r0:int,q0:int>>")
    rows = rows.withColumn("__parts", F.when(c("__frame1.stop"), parts).otherwise(none))
    rows = rows.withColumn("__tasks", F.concat(F.array(task(c("__frame1")), task(c("__frame2"))), "__parts"))
    rows = rows.withColumn("__tasks", F.transform("__tasks", lambda t: F.coalesce(t, F.struct(F.lit("").alias("ref_aa"), F.lit("").alias("query_aa"), F.lit(0).alias("r0"), F.lit(0).alias("q0")))))
    rows = _place(rows, "__tasks", "__placed")
    runs = F.transform(F.arrays_zip("__tasks", "__placed"), lambda z: B.codon_runs(z["__placed"], z["__tasks"]["r0"], z["__tasks"]["q0"]))
    rows = rows.withColumn("__runs", runs)
    joined = F.flatten(F.slice("__runs", 3, F.greatest(F.size("__runs") - 2, F.lit(0))))
    sound = ~F.exists("__parts", lambda p: B.has_internal_stop(p["query_aa"])) & (F.size(joined) > 0)
    kind = F.when(c("__stated").isNotNull(), CODON).otherwise(IMPLIED)
    plain = lambda method: F.struct(c("__span").alias("runs"), F.lit(method).alias("method"), F.lit(False).alias("internal_stop"), F.lit(None).cast("boolean").alias("recovered"))
    made = lambda runs, method, stop, recovered: F.struct(runs.alias("runs"), method.alias("method"), F.lit(stop).alias("internal_stop"), F.lit(recovered).cast("boolean").alias("recovered"))
    clean = lambda n, method: F.when(F.size(F.get("__runs", F.lit(n))) > 0, made(F.get("__runs", F.lit(n)), method, False, None))
    one = F.when(c("__frame1").isNull(), None).when(~c("__frame1.stop"), clean(0, kind)).when(sound, made(joined, F.lit(RECOVERED), True, True)).otherwise(made(c("__span"), F.lit(CDS_FALLBACK), True, False))
    rows = rows.withColumn("__one", one).withColumn("__two", F.when(c("__frame2").isNotNull() & ~c("__frame2.stop"), clean(1, F.lit(IMPLIED))))

    def differ(runs: Column, by_codon: bool) -> Column:
        held = B.clip(runs, lo, hi)
        held = B.whole_codons(held, lo) if by_codon else held
        x, y = B.letters_under(held, c("reference"), "r"), B.letters_under(held, c("oriented"), "q")
        return B.percent(B.compared(B.translate(x), B.translate(y), "[^X]") if by_codon else B.compared(x, y, "[ACGT]"))

    both = c("__one").isNotNull() & ~c("__one.internal_stop") & c("__two").isNotNull()
    rescue = F.coalesce(both & (F.when(both, differ(c("__one.runs"), True)) - F.when(both, differ(c("__two.runs"), True)) > residue_guard), F.lit(False))
    rows = rows.withColumn("__best", F.when(rescue, c("__two")).otherwise(c("__one")))
    worse = F.coalesce(differ(c("__best.runs"), False) - differ(c("__span"), False) > nucleotide_guard, F.lit(False)) & ~F.coalesce(c("bypass"), F.lit(False))
    rows = rows.withColumn("__best", F.when(c("__best").isNull(), plain(FALLBACK)).when(worse, plain(BETTER)).otherwise(c("__best")))
    rows = rows.select(*df.columns, "strand", "oriented", "__best.*").withColumn("row", B.project(c("runs"), c("oriented"), lo, hi))
    rows = rows.withColumn("__gaps", B.gap_audit(c("row"), c("runs"), lo, hi)).select(*df.columns, "strand", "oriented", "method", "internal_stop", "recovered", "runs", "row", "__gaps.*")
    return rows.withColumn("row", F.when(F.translate("row", B.GAP, "") != "", c("row")))


def anchored_block(records: DataFrame, references: DataFrame, **guards: float) -> DataFrame:
    """The rows of `records` (key, ref_id, sequence, cds, bypass) in the columns of their references (ref_id, reference, lo, hi).

    Records whose reference is missing are left out.  References are broadcast if their letters are few; both bounds are counted.
    """
    size = references.agg(F.sum(F.length("reference"))).first()[0] or 0
    refs = references.select("ref_id", "reference", "lo", "hi")
    met = records.withColumnRenamed("sequence", "query").join(F.broadcast(refs) if size <= BROADCAST_SEEDS else refs, "ref_id")
    return place_records(met, **guards)
