"""Column expressions over alignments kept as runs: arrays of (r, q, n), n letters from r on in a reference under n from q on in a query.

Positions count from 0, ends are exclusive.  Texts are upper-case; a gap is "-".
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

#: the standard genetic code, in the order T C A G of each position
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
GAP = "-"
RUNS = "array<struct<r:int,q:int,n:int>>"


def run(r: Column, q: Column, n: Column) -> Column:
    return F.struct(r.cast("int").alias("r"), q.cast("int").alias("q"), n.cast("int").alias("n"))


def no_runs() -> Column:
    return F.array().cast(RUNS)


def cut(text: Column, start: Column, end: Column) -> Column:
    """The letters from `start` to before `end`."""
    return F.substr(text, start.cast("int") + 1, F.greatest(end - start, F.lit(0)).cast("int"))


def residue(codon: Column) -> Column:
    """The residue of a codon; X if a base cannot be read."""
    at = lambda i: F.instr(F.lit("TCAG"), F.substring(codon, i, 1)) - 1
    index = at(1) * 16 + at(2) * 4 + at(3)
    return F.when(codon.rlike("^[TCAG]{3}$"), F.substr(F.lit(AMINO_ACIDS), index + 1, F.lit(1))).otherwise("X")


def translate(text: Column) -> Column:
    """The residues of a text's whole codons; what is left at its end is dropped."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)(.{3})"), F.lit(1)), residue), "")


#: what a base counts as in a codon, and the residue of each codon number; from 64 on one of its letters is no base
_DIGIT = np.full(256, 64, np.int16)
_DIGIT[np.frombuffer(b"TCAG", np.uint8)] = np.arange(4)
_RESIDUE = np.append(np.frombuffer(AMINO_ACIDS.encode(), np.uint8), np.uint8(ord("X")))


def codon_numbers(text: np.ndarray) -> np.ndarray:
    """The numbers 0 to 63 of the codons of a text's bytes, whose length is a multiple of three; 64 for those that cannot be read."""
    digit = _DIGIT[text]
    return np.minimum(digit[0::3] * 16 + digit[1::3] * 4 + digit[2::3], 64)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and the place where each begins, with the end of the last; nulls are empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def texts_of(data: np.ndarray, ends: np.ndarray, like: pa.Array) -> pa.Array:
    """The texts that end at `ends` in `data`; null where `like` is."""
    out = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())
    return pc.if_else(like.is_valid(), out, None) if like.null_count else out


def _residues(texts: pa.Array) -> pa.Array:
    data, offsets = flat(texts)
    if (data > 127).any():  # a letter beyond ASCII is one letter that cannot be read
        lead = (data & 0xC0) != 0x80
        data, offsets = data[lead], np.append(0, np.cumsum(lead))[offsets]
    size = np.diff(offsets)
    kept = size - size % 3
    if (kept != size).any():
        data = data[np.arange(len(data)) - np.repeat(offsets[:-1], size) < np.repeat(kept, size)]
    return texts_of(_RESIDUE[codon_numbers(data)], np.cumsum(kept // 3), texts)


@F.arrow_udf(StringType())
def residues_of(text: pa.Array) -> pa.Array:
    """`translate`, a batch at once; not for use within lambdas."""
    return _residues(text)


#: what each letter is read as, 0 for what is no letter
_BASE = np.zeros(256, np.uint8)
for _start in (ord("A"), ord("a")):
    _BASE[_start : _start + 26] = np.frombuffer(b"ACCCGGGTTTAACCNGTACGTTACGT", np.uint8)


def _as_bases(text: pa.Array) -> pa.Array:
    """The letters of texts as bases, a batch at once; whatever is no ASCII letter is left out."""
    data, offsets = flat(text)
    data = _BASE[data]
    return texts_of(data[data > 0], np.append(0, np.cumsum(data > 0))[offsets[1:]], text)


def _count_bases(text: pa.Array) -> pa.Array:
    """The number of bases of each text."""
    data, offsets = flat(text)
    return pa.array(np.diff(np.append(0, np.cumsum(_BASE[data] > 0))[offsets]), pa.int64())


bases_of = F.arrow_udf(_as_bases, StringType())
# a filter on these does not have them worked out once more below it
bases_once = F.arrow_udf(_as_bases, StringType()).asNondeterministic()
n_bases_once = F.arrow_udf(_count_bases, LongType()).asNondeterministic()


#: bases under which reads another strand, and all other bytes as they are
_OTHER_STRAND = np.arange(256, dtype=np.uint8)
_OTHER_STRAND[np.frombuffer(b"ACGT", np.uint8)] = np.frombuffer(b"TGCA", np.uint8)


def turned_texts(texts: pa.Array) -> pa.Array:
    """The other strand of each text, letters that are no bases as they are."""
    data, offsets = flat(texts)
    if (data > 127).any():  # a letter beyond ASCII keeps its bytes in order
        table = str.maketrans("ACGT", "TGCA")
        return pa.array([x if x is None else x[::-1].translate(table) for x in texts.to_pylist()], pa.string())
    # the batch turned round as a whole has its texts turned round, the last one first
    back = _OTHER_STRAND[data[::-1]]
    size = np.diff(offsets)
    return texts_of(back[np.arange(len(data)) + np.repeat(len(data) - offsets[1:] - offsets[:-1], size)], offsets[1:], texts)


#: not for use within lambdas; `other_strand_once` is not worked out again by each column that is made of it
reverse_complement = F.arrow_udf(turned_texts, StringType())
other_strand_once = F.arrow_udf(turned_texts, StringType()).asNondeterministic()


def has_internal_stop(residues: Column) -> Column:
    """Whether a stop stands anywhere but at the end."""
    first = F.instr(residues, "*")
    return (first > 0) & (first < F.length(residues))


def _coded(texts: pa.Array) -> pa.Array:
    data, offsets = flat(texts)
    if (data > 127).any():
        # no base is beyond ASCII: one letter in its place leaves all else as it is, and the text itself is cut
        rows = _coded(pa.array([x if x is None else "".join(c if c < "\x80" else "N" for c in x) for x in texts.to_pylist()], pa.string())).to_pylist()
        cut_rows = [r if r is None else {**r, "nt": x[: len(r["nt"])]} for r, x in zip(rows, texts.to_pylist(), strict=True)]
        return pa.array(cut_rows, CODED)
    size = np.diff(offsets)
    kept = size - size % 3
    whole = data[np.arange(len(data)) - np.repeat(offsets[:-1], size) < np.repeat(kept, size)]
    residues = _RESIDUE[codon_numbers(whole)]
    ends = np.cumsum(kept // 3)
    stop = residues == ord("*")
    last = ends[kept > 0] - 1
    last = last[stop[last]]
    held = np.ones(len(residues), bool)
    held[last] = False
    counted = np.append(0, np.cumsum(held))[ends]
    stops = np.diff(np.append(0, np.append(0, np.cumsum(stop & held))[ends])).astype(np.int32)
    nt = texts_of(whole[np.repeat(held, 3)], 3 * counted, texts)
    aa = texts_of(np.where(stop, np.uint8(ord("X")), residues)[held], counted, texts)
    return pa.StructArray.from_arrays([nt, aa, pa.array(stops)], fields=list(CODED), mask=texts.is_null())


#: (nt, aa, stops) of a coding text: whole codons without the stop at their end, residues with X for a stop, and how many of these there were
CODED = pa.struct([("nt", pa.string()), ("aa", pa.string()), ("stops", pa.int32())])
coding = F.arrow_udf(_coded, StructType().add("nt", StringType()).add("aa", StringType()).add("stops", IntegerType())).asNondeterministic()


def clip(runs: Column, lo: Column, hi: Column) -> Column:
    """The runs within the reference's span from `lo` to before `hi`."""

    def cut_run(b: Column) -> Column:
        low = F.greatest(b["r"], lo)
        return run(low, b["q"] + low - b["r"], F.least(b["r"] + b["n"], hi) - low)

    return F.filter(F.transform(runs, cut_run), lambda b: b["n"] > 0)


def of_gapped(reference: Column, query: Column, r0: Column, q0: Column, letters: int = 1) -> Column:
    """The runs of two gapped texts of equal length; each letter stands for `letters` of the texts that r0 and q0 count in.

    Columns are told by what they hold, so that a run of them is one match of a pattern; places are sums
    over the runs before.
    """
    kinds = F.array_join(F.zip_with(F.split(reference, ""), F.split(query, ""), lambda x, y: F.when(x == "", "").when((x == GAP) & (y == GAP), "n").when(y == GAP, "r").when(x == GAP, "q").otherwise("b")), "")
    pieces = F.transform(F.regexp_extract_all(kinds, F.lit("(b+|r+|q+|n+)"), F.lit(1)), lambda p: F.struct(F.substring(p, 1, 1).alias("kind"), (F.length(p) * letters).alias("n")))
    start = F.struct(r0.cast("int").alias("r"), q0.cast("int").alias("q"), no_runs().alias("out"))

    def step(s: Column, p: Column) -> Column:
        size = lambda kinds: F.when(p["kind"].isin(*kinds), p["n"]).otherwise(0)
        grown = F.when(p["kind"] == "b", F.concat(s["out"], F.array(run(s["r"], s["q"], p["n"])))).otherwise(s["out"])
        return F.struct((s["r"] + size("br")).cast("int").alias("r"), (s["q"] + size("bq")).cast("int").alias("q"), grown.alias("out"))

    return F.aggregate(pieces, start, step, lambda s: s["out"])


def codon_runs(runs: Column, r0: Column, q0: Column) -> Column:
    """Runs of residues as runs of letters: three for each, from the first codons at r0 and q0 on."""
    return F.transform(runs, lambda b: run(b["r"] * 3 + r0, b["q"] * 3 + q0, b["n"] * 3))


def pieces(runs: Column) -> Column:
    """Spans (r, r_end, q, q_end) of the runs, parted where a frame is lost: where what is left out and put in differs by no multiple of three."""
    at = lambda i: F.get(runs, i)
    lost = lambda b, p: F.pmod((b["q"] - p["q"] - p["n"]) - (b["r"] - p["r"] - p["n"]), F.lit(3)) != 0
    heads = F.filter(F.sequence(F.lit(0), F.size(runs) - 1), lambda i: (i == 0) | lost(at(i), at(i - 1)))

    def span(i: Column, k: Column) -> Column:
        last = at(F.coalesce(F.get(heads, k + 1), F.size(runs)) - 1)
        return F.struct(at(i)["r"].alias("r"), (last["r"] + last["n"]).alias("r_end"), at(i)["q"].alias("q"), (last["q"] + last["n"]).alias("q_end"))

    return F.when(F.size(runs) > 0, F.transform(heads, span)).otherwise(F.array().cast("array<struct<r:int,r_end:int,q:int,q_end:int>>"))


def project(runs: Column, query: Column, lo: Column, hi: Column) -> Column:
    """The query in the columns of the reference's span: as wide as the span, gaps where no letter stands, letters without a column left out."""
    start = F.struct(lo.cast("int").alias("at"), F.lit("").alias("row"))

    def step(s: Column, b: Column) -> Column:
        row = F.concat(s["row"], F.repeat(F.lit(GAP), b["r"] - s["at"]), cut(query, b["q"], b["q"] + b["n"]))
        return F.struct((b["r"] + b["n"]).cast("int").alias("at"), row.alias("row"))

    return F.aggregate(clip(runs, lo, hi), start, step, lambda s: F.concat(s["row"], F.repeat(F.lit(GAP), (hi - s["at"]).cast("int"))))


def letters_under(runs: Column, text: Column, side: str) -> Column:
    """The letters of one side ("r" or "q") that stand in the runs, one after the other."""
    return F.array_join(F.transform(runs, lambda b: cut(text, b[side], b[side] + b["n"])), "")


def whole_codons(runs: Column, lo: Column) -> Column:
    """The runs less what is no whole codon of the reference's frame, which starts at `lo`."""

    def keep(b: Column) -> Column:
        skip = F.pmod(F.lit(3) - F.pmod(b["r"] - lo, F.lit(3)), F.lit(3))
        size = b["n"] - skip
        return run(b["r"] + skip, b["q"] + skip, size - F.pmod(size, F.lit(3)))

    return F.filter(F.transform(runs, keep), lambda b: b["n"] > 0)


def compared(x: Column, y: Column, readable: str) -> Column:
    """(n, differ): places of two equally long texts at which both letters match `readable`, and those at which they differ."""
    part = lambda a, b: F.when(a.rlike(readable) & b.rlike(readable), F.when(a != b, F.lit((1 << 32) + 1)).otherwise(F.lit(1).cast("long"))).otherwise(F.lit(0).cast("long"))
    total = F.aggregate(F.zip_with(F.split(x, ""), F.split(y, ""), part), F.lit(0).cast("long"), lambda s, v: s + v, lambda s: F.struct(s.bitwiseAND((1 << 32) - 1).alias("n"), F.shiftright(s, 32).alias("differ")))
    return total


def percent(counts: Column) -> Column:
    """Differing places in a hundred compared ones; null if none compare."""
    return F.when(counts["n"] > 0, counts["differ"] * 100.0 / counts["n"])


def gap_audit(row: Column, runs: Column, lo: Column, hi: Column) -> Column:
    """(shifted, misphased) gaps of a projected row between its first and last covered column.

    Shifted gaps are no multiple of three long; misphased ones are, but do not begin at a codon.
    """
    held = clip(runs, lo, hi)
    first, last = F.get(held, F.lit(0)), F.get(held, F.size(held) - 1)
    span = cut(row, first["r"] - lo, last["r"] + last["n"] - lo)
    parts = F.regexp_extract_all(span, F.lit("(-+|[^-]+)"), F.lit(1))
    start = F.struct((first["r"] - lo).cast("int").alias("at"), F.lit(0).alias("shifted"), F.lit(0).alias("misphased"))

    def step(s: Column, p: Column) -> Column:
        gap, size = p.startswith(GAP), F.length(p)
        return F.struct((s["at"] + size).cast("int").alias("at"), (s["shifted"] + (gap & (size % 3 != 0)).cast("int")).alias("shifted"), (s["misphased"] + (gap & (size % 3 == 0) & (s["at"] % 3 != 0)).cast("int")).alias("misphased"))

    none = F.struct(F.lit(0).alias("shifted"), F.lit(0).alias("misphased"))
    return F.when(F.size(held) > 0, F.aggregate(parts, start, step, lambda s: F.struct(s["shifted"].alias("shifted"), s["misphased"].alias("misphased")))).otherwise(none)
