"""Sequence operators: seeds and diagonals, divergence, column consensus, codon comparison.

Seed joins are equi-joins on the seeds; alignment along a diagonal compares two substrings in one
expression.  Both stay inside Spark's generated code or its higher-order functions.  Letters by column are
counted in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blocks import AMINO_ACIDS, flat

SEED, MIN_ANCHORS, MIN_COMPARED, IMPLAUSIBLE_PERCENT = 12, 5, 50, 40.0
#: the references' seeds are broadcast up to this number, some 50 MB; more are joined by shuffle
BROADCAST_SEEDS = 1_000_000
#: letters that are counted at once, and what a null key counts as
CHUNK_LETTERS, NO_KEY = 1 << 20, (1 << 63) - 1
#: rows of counts that a task holds, and bits of its groups' numbers
HELD, GROUP_BITS = 1 << 21, 12
#: bits of the map of the references' seeds, 2 MB, and the base of their hashes
SLOT_BITS, HASH_BASE = 24, 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches the highest."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(df: DataFrame, key: str, text: str, name: str, k: int = SEED) -> DataFrame:
    """(key, name, seed): every k-letter window and its 0-based position."""
    # one pass of a pattern of no width: cutting each window out of the text would read it anew from its start
    window = rf"(?s)(?![\uDC00-\uDFFF])(?=(.{{{k}}}))"
    return df.select(key, F.posexplode(F.regexp_extract_all(text, F.lit(window), F.lit(1))).alias(name, "seed"))


def window_slots(texts: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, slot) of every k-letter window, some texts at a time: a hash of its letters, below 2**SLOT_BITS."""
    data, offsets = flat(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_LETTERS, "right")) - 1)
        part, ends = data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        if (part > 127).any():
            codes = np.frombuffer(part.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            ends = np.append(0, np.cumsum((part & 0xC0) != 0x80))[ends]
        else:
            codes = part.astype(np.uint64)
        # the hash of n letters followed by m others: doubled while k has further bits
        hashes, n = codes, 1
        for bit in bin(k)[3:]:
            hashes, n = hashes[: max(len(hashes) - n, 0)] * np.uint64(pow(HASH_BASE, n, 1 << 64)) + hashes[n:], 2 * n
            if bit == "1":
                hashes, n = hashes[: max(len(hashes) - 1, 0)] * np.uint64(HASH_BASE) + codes[n:], n + 1
        row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[: len(hashes)]
        place = np.arange(len(hashes)) - ends[row]
        whole = np.flatnonzero(place + k <= np.diff(ends)[row])
        slot = mix(hashes[whole]) >> np.uint64(64 - SLOT_BITS)
        yield row[whole] + at, place[whole], slot.astype(np.int64)
        at = to


def seed_map(references: DataFrame, text: str, k: int) -> np.ndarray:
    """Bytes of 2**SLOT_BITS bits: those of the slots of the references' windows.  The driver is sent the words in use, 4 MB at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, slot in window_slots(batch.column(0), k):
                slot = np.unique(slot)
                yield pa.RecordBatch.from_arrays([pa.array(slot >> 5), pa.array(np.int64(1) << (slot & 31))], ["word", "bits"])

    words = references.select(text).mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    bits = np.zeros(1 << (SLOT_BITS - 5), np.uint32)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return bits


def listed_seeds(df: DataFrame, key: str, text: str, name: str, k: int, bits: np.ndarray) -> DataFrame:
    """Those of `seeds` whose slot is set in the map: all that a reference has, and few others."""
    sent = df.sparkSession.sparkContext.broadcast(bits)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches:
            for row, place, slot in window_slots(batch.column(1), k):
                hit = np.flatnonzero((held[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1)
                row, place = row[hit], place[hit]
                text_of = dict(zip((own := np.unique(row)).tolist(), batch.column(1).take(pa.array(own)).to_pylist(), strict=True))
                found = [text_of[i][j : j + k] for i, j in zip(row.tolist(), place.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(place, pa.int32()), pa.array(found, pa.string())], [key, name, "seed"])

    return df.select(key, text).mapInArrow(run, f"{key} {kind}, {name} int, seed string")


def diagonals(queries: DataFrame, references: DataFrame, k: int = SEED, floor: int = MIN_ANCHORS) -> DataFrame:
    """(doc_id, item_id, diag, n): the diagonal with most seeds in common, at least `floor`.

    Ties go to the diagonal met first: the lowest query position, then the lowest reference position.
    Of the queries' seeds only those go on that a bit map of the references' seeds lists; they are joined letter by letter.
    Votes are counted map-side before the shuffle.  The references' seeds are counted first, and
    broadcast only if few: then the queries' seeds never leave their task.
    """
    q, r = listed_seeds(queries, "doc_id", "text", "pos", k, seed_map(references, "text", k)), seeds(references, "item_id", "text", "rpos", k)
    n = references.agg(F.sum(F.greatest(F.length("text") - k + 1, F.lit(0)))).first()[0] or 0
    votes = q.join(F.broadcast(r) if n <= BROADCAST_SEEDS else r, "seed").groupBy("doc_id", "item_id", (F.col("rpos") - F.col("pos")).alias("diag")).agg(F.count("*").alias("n"), F.min("pos").alias("q0"), F.min("rpos").alias("r0"))
    best = F.max_by(F.struct("diag", "n"), F.struct("n", -F.col("q0"), -F.col("r0"))).alias("m")
    return votes.filter(F.col("n") >= floor).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", F.col("m.diag").cast("long").alias("diag"), F.col("m.n").alias("n"))


def along(hits: DataFrame, queries: DataFrame, references: DataFrame) -> DataFrame:
    """The two texts of each hit where they overlap along its diagonal: columns q and r of equal length."""
    rows = hits.join(references.select("item_id", F.col("text").alias("__r")), "item_id").join(queries.select("doc_id", F.col("text").alias("__q")), "doc_id")
    lo = F.greatest(F.lit(0), -F.col("diag")).cast("int")
    size = (F.least(F.length("__q").cast("long"), F.length("__r") - F.col("diag")) - lo).cast("int")
    return rows.withColumn("q", F.substr("__q", lo + 1, size)).withColumn("r", F.substr("__r", (lo + F.col("diag") + 1).cast("int"), size)).drop("__q", "__r")


def divergence(rows: DataFrame, readable: str | None = None) -> DataFrame:
    """compared and mismatches of q and r; with `readable`, only positions where both letters match it.

    Both counts come from one pass over the letters: a mismatch adds 2**32 to the sum, a comparison 1.
    """
    def share(x: Column, y: Column) -> Column:
        both = F.when(x != y, F.lit((1 << 32) + 1)).otherwise(F.lit(1).cast("long"))
        return F.when(x.rlike(readable) & y.rlike(readable), both).otherwise(F.lit(0).cast("long")) if readable else F.when(x == "", F.lit(0).cast("long")).otherwise(both)

    total = F.aggregate(F.zip_with(F.split("q", ""), F.split("r", ""), share), F.lit(0).cast("long"), lambda s, x: s + x)
    out = rows.withColumn("__total", total)
    return out.withColumn("compared", F.col("__total").bitwiseAND((1 << 32) - 1)).withColumn("mismatches", F.shiftright("__total", 32)).drop("__total")


class Counts:
    """Counts of (group, position, code), and their least rank, as one sorted array: what a task has read so far.

    A key has GROUP_BITS of the group's number here, 31 bits of position and 21 of code.  What is held stays below HELD rows;
    `taken` gives what does not fit.
    """

    def __init__(self) -> None:
        self.groups: dict = {}
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, groups: list, row: np.ndarray, position: np.ndarray, code: np.ndarray, rank: np.ndarray) -> None:
        """Letters of rows: `groups` and `rank` are of the rows, the others of the letters."""
        number = np.array([self.groups.setdefault(g, len(self.groups)) for g in groups], np.uint64)
        key = (number[row] << np.uint64(52)) | (position.astype(np.uint64) << np.uint64(21)) | code.astype(np.uint64)
        self.parts.append(self._summed(key, np.ones(len(key), np.int64), rank[row]))

    def full(self, more: int) -> bool:
        """Whether the rows that are held, or their groups with `more` others, are too many."""
        if sum(len(p[0]) for p in self.parts) > HELD:
            self.parts = [self._summed(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))]
        return (bool(self.parts) and len(self.parts[0][0]) > HELD // 2) or len(self.groups) + more > 1 << GROUP_BITS

    @staticmethod
    def _summed(key: np.ndarray, n: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.argsort(key)
        key = key[order]
        head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        return (key[head], np.add.reduceat(n[order], head), np.minimum.reduceat(rank[order], head)) if len(key) else (key, n, rank)

    def taken(self) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(groups, number of group, position, code, n, least rank) of all that is held; nothing is held after."""
        key, n, rank = self._summed(*(np.concatenate(x) for x in zip(*self.parts, strict=True))) if self.parts else (np.zeros(0, np.uint64), *np.zeros((2, 0), np.int64))
        groups, self.groups, self.parts = list(self.groups), {}, []
        low = lambda at, bits: ((key >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64)
        return groups, (key >> np.uint64(52)).astype(np.int64), low(21, 31), low(0, 21), n, rank


def _in_parts(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of rows of some CHUNK_LETTERS letters, of which `ends` are the sums."""
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_LETTERS, "right")))
        to = min(to, at + (1 << GROUP_BITS) // 2)
        yield at, to
        at = to


def letter_counts(df: DataFrame, group: str, key: str, text: str) -> DataFrame:
    """(group, position, letter, n, first): how many rows of a group have a letter at a position, and their least key.

    Letters are counted where they are read, over all texts of a task, so what is shuffled are counts.
    Counts of one column may come in several rows.
    """
    kind = df.schema[group].dataType

    def given(counts: Counts, group_type: pa.DataType) -> pa.RecordBatch:
        groups, number, position, code, n, first = counts.taken()
        letters, which = np.unique(code, return_inverse=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(groups, group_type).take(pa.array(number)),
                pa.array(position, pa.int32()),
                pa.array([chr(x) for x in letters], pa.string()).take(pa.array(which)),
                pa.array(n),
                pa.array(first, pa.int64(), mask=first == NO_KEY),
            ],
            [group, "position", "letter", "n", "first"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, group_type = Counts(), None
        for batch in batches:
            group_type = batch.column(0).type
            groups, texts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rank = batch.column(1).fill_null(NO_KEY).to_numpy(zero_copy_only=False)
            ends = np.cumsum([len(x) if x else 0 for x in texts])
            for at, to in _in_parts(ends):
                if counts.full(to - at):
                    yield given(counts, group_type)
                codes = np.frombuffer("".join(x for x in texts[at:to] if x).encode("utf-32-le", "surrogatepass"), np.uint32)
                size = np.diff(ends[at:to], prepend=ends[at - 1] if at else 0)
                row = np.repeat(np.arange(to - at), size)
                counts.add(groups[at:to], row, np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size), codes, rank[at:to])
        if counts.parts:
            yield given(counts, group_type)

    rows = df.select(group, F.col(key).cast("long").alias("__key"), F.col(text).alias("__text"))
    return rows.mapInArrow(run, f"{group} {kind.simpleString()}, position int, letter string, n long, first long")


#: letters of codons in the order of their codes, and codons of a piece that meets its group's consensus
CODON_LETTERS, PIECE = "ACGNT", 4096
_CODON_DIGIT = np.zeros(256, np.int64)
_CODON_DIGIT[np.frombuffer(CODON_LETTERS.encode(), np.uint8)] = np.arange(len(CODON_LETTERS))
_CODONS = ["".join(x) for x in product(CODON_LETTERS, repeat=3)]
_READ = np.array([ord(AMINO_ACIDS["TCAG".index(c[0]) * 16 + "TCAG".index(c[1]) * 4 + "TCAG".index(c[2])]) if "N" not in c else 0 for c in _CODONS], np.uint8)


def codon_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all whole codons of texts of bases (A, C, G, N, T), in the codons' own order, and how many each text has."""
    data, offsets = flat(texts)
    size = np.diff(offsets)
    kept = size - size % 3
    digit = _CODON_DIGIT[data[np.arange(len(data)) - np.repeat(offsets[:-1], size) < np.repeat(kept, size)]]
    return digit[0::3] * 25 + digit[1::3] * 5 + digit[2::3], kept // 3


def codon_consensus(df: DataFrame, group: str, bases: str) -> DataFrame:
    """(group, position, code): the most frequent codon of each place of a group's texts of bases, the first by letters of equals."""

    def given(counts: Counts, group_type: pa.DataType) -> pa.RecordBatch:
        groups, number, position, code, n, _ = counts.taken()
        return pa.RecordBatch.from_arrays([pa.array(groups, group_type).take(pa.array(number)), pa.array(position, pa.int32()), pa.array(code, pa.int32()), pa.array(n)], [group, "position", "code", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, group_type = Counts(), None
        for batch in batches:
            group_type = batch.column(0).type
            groups = batch.column(0).to_pylist()
            for at, to in _in_parts(np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))):
                if counts.full(to - at):
                    yield given(counts, group_type)
                code, size = codon_codes(batch.column(1).slice(at, to - at))
                counts.add(groups[at:to], np.repeat(np.arange(to - at), size), np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size), code, np.zeros(to - at, np.int64))
        if counts.parts:
            yield given(counts, group_type)

    counts = df.select(group, bases).mapInArrow(run, f"{group} {df.schema[group].dataType.simpleString()}, position int, code int, n long")
    counts = counts.groupBy(group, "position", "code").agg(F.sum("n").alias("n"))
    return counts.groupBy(group, "position").agg(F.min_by("code", F.struct(-F.col("n"), "code")).alias("code"))


def codon_classes(df: DataFrame, key: str, group: str, bases: str, few: bool) -> DataFrame:
    """(key, assessable, synonymous, nonsynonymous, unreadable) of texts of bases against the consensus of their group; rows of one key are summed.

    Texts meet the consensus in pieces of PIECE codons; `few` says that it is small enough to be broadcast.  Rows without a group meet none.
    """
    ref = codon_consensus(df.filter(F.col(group).isNotNull()), group, bases).withColumn("piece", F.floor(F.col("position") / PIECE).cast("int"))
    ref = ref.groupBy(group, "piece").agg(F.array_sort(F.collect_list(F.struct("position", "code"))).alias("__c"))
    ref = ref.select(group, "piece", F.transform("__c", lambda c: c["code"].cast("byte")).alias("__codes"))
    last = F.floor((F.length(bases) - 3) / (3 * PIECE)).cast("int")
    pieces = df.filter(F.length(bases) >= 3).select(key, group, bases, F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    pieces = pieces.select(key, group, "piece", F.substr(bases, F.col("piece") * (3 * PIECE) + 1, F.lit(3 * PIECE)).alias("__part"))
    met = pieces.join(F.broadcast(ref) if few else ref, [group, "piece"]).select(key, "__part", "__codes")
    names = ["assessable", "synonymous", "nonsynonymous", "unreadable"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, size = codon_codes(batch.column(1))
            codes, row = batch.column(2), np.repeat(np.arange(batch.num_rows), size)
            begin = codes.offsets.to_numpy()[:-1].astype(np.int64)
            other = codes.values.to_numpy(zero_copy_only=False).astype(np.int64)[begin[row] + np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)]
            aa, ca = _READ[own], _READ[other]
            ok = (aa > 0) & (ca > 0)
            sums = [np.bincount(row[x], minlength=batch.num_rows) for x in (ok, ok & (own != other) & (aa == ca), ok & (aa != ca), aa == 0)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x.astype(np.int64)) for x in sums)], [key, *names])

    counted = met.mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names))
    return counted.groupBy(key).agg(*(F.sum(n).alias(n) for n in names))


def consensus(counts: DataFrame, group: str, first_seen: bool) -> DataFrame:
    """The most frequent letter of each column of `letter_counts`; ties go to the letter met first by key, or the lowest."""
    counts = counts.groupBy(group, "position", "letter").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    tie = -F.col("first") if first_seen else -F.ascii("letter")
    best = F.max_by(F.struct("letter", "n"), F.struct("n", tie)).alias("m")
    return counts.groupBy(group, "position").agg(best).select(group, "position", F.col("m.letter").alias("letter"), F.col("m.n").alias("n"))
