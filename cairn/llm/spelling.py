"""Spelling variants: words that differ by one letter, found by partition-and-enumerate signatures of their letters.

A word is seen as the set of its letters with their numbers of occurrence: ("a", 1), ("a", 2), ("b", 1) for
"aab".  One letter put in, left out or replaced changes at most two members.  The members are dealt to PARTS
parts by a hash, so at least PARTS - 2 parts of two such words are equal: a word's signatures are hashes of its
members in each choice of PARTS - 2 parts, near words share one of them, and words that share one are
compared letter by letter.

A signature of more than CROWD words (words of the same few letters) makes no pairs.  Its words, and those of
LONG letters or more, meet by what is left of them without one letter: two words of the same length by the place and
the rest, others by the rest and the shorter word.  At most as many words share a place and a rest as there are
letters, and all of them are near.

Words are counted over all rows, a repeated row as often as it stands there.  Null and empty texts hold none; a null doc_id
counts as an empty one where words are altered.  Ties in n go to the smaller word by code points.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import crc
from .bytekit import LEAD, LOWER, Block, U, blocks, mix, stream
from .scratch import Scratch

SHORTEST = 7
LEAST = 2
#: a form is so many times as frequent as the word
TIMES = 10
#: one occurrence in so many loses a letter
ALTERED = 31
PARTS = 6
CROWD = 64
#: where Spark's edit distance gets dear
LONG = 64
CHOICES = tuple(combinations(range(PARTS), PARTS - 2))
ASCII_LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])


def block_words(block: Block, prefix: np.ndarray) -> pa.Array:
    """The words of a block's texts, altered where the checksum of document and word says so; `prefix` has each document's part of it."""
    buf = LOWER[block.buf]
    # the letters U+00C0 to U+00FF are the byte C3 and one byte more
    wide = buf == 0xC3
    letter = ASCII_LETTER[buf] | wide
    letter[1:] |= wide[:-1]
    starts, ends, docs = block.spans(letter)
    lead = LEAD[buf]
    leads = np.concatenate((np.flatnonzero(lead), [len(buf)]))
    points = np.concatenate(([0], np.cumsum(lead)))
    long = points[ends] - points[starts] >= SHORTEST
    starts, ends, docs = starts[long], ends[long], docs[long]
    length = points[ends] - points[starts]
    h = crc.joined(prefix[docs], crc.crc32(buf, starts, ends), ends - starts).astype(np.int64)
    altered = h % ALTERED == 0
    long = ~altered | (length > SHORTEST)
    starts, ends, length, h, altered = starts[long], ends[long], length[long], h[long], altered[long]
    at = points[starts[altered]] + h[altered] % length[altered]
    kept = np.zeros(len(buf) + 1, np.int8)
    kept[starts] += 1
    kept[ends] -= 1
    kept = np.cumsum(kept[:-1], dtype=np.int8).astype(bool)
    kept[leads[at]] = False
    wide = leads[at + 1] - leads[at] == 2
    kept[leads[at[wide]] + 1] = False
    sizes = ends - starts
    sizes[altered] -= leads[at + 1] - leads[at]
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(buf[kept])])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word stands in all texts, from LEAST on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in batch.column(0).to_pylist()], np.uint32)
            for block in blocks(batch.column(1)):
                counts = block_words(block, prefix[block.first : block.first + block.n]).value_counts()
                yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], ["word", "n"])

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)


def signatures(words: pa.Array) -> np.ndarray:
    """A row of len(CHOICES) signatures for each word."""
    n = len(words)
    letters = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).astype(U)
    owner = np.repeat(np.arange(n), pc.utf8_length(words).to_numpy(zero_copy_only=False))
    order = np.lexsort((letters, owner))
    letters, owner = letters[order], owner[order]
    new = np.ones(len(letters), bool)
    new[1:] = (letters[1:] != letters[:-1]) | (owner[1:] != owner[:-1])
    run = np.flatnonzero(new)
    nth = np.arange(len(letters)) - np.repeat(run, np.diff(np.append(run, len(letters))))
    with np.errstate(over="ignore"):
        member = mix((letters << U(32)) + nth.astype(U) + U(1))
        sums = np.zeros((n, PARTS), U)
        np.add.at(sums, (owner, (member % U(PARTS)).astype(np.int64)), mix(member))
        salt = stream(31, len(CHOICES))
        factor = stream(37, PARTS) | U(1)
        return np.stack([mix((sums[:, list(c)] * factor[list(c)]).sum(axis=1, dtype=U) + s) for c, s in zip(CHOICES, salt, strict=True)], axis=1)


def _signature_rows(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sig = signatures(batch.column(0))
                at = pa.array(np.repeat(np.arange(batch.num_rows), sig.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(sig.ravel().astype(np.int64)), batch.column(0).take(at), batch.column(1).take(at)], ["sig", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "sig long, word string, n long")


def rests(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each letter of the words: which word, its place, whether the next one differs, and the hash of the word without it; of each word its own hash."""
    n = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    letters = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).astype(U)
    owner = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    place = np.arange(len(letters)) - first[owner]
    with np.errstate(over="ignore"):
        base = stream(41, 1)[0] | U(1)
        powers = np.multiply.accumulate(np.append(base, np.full(n.max(initial=0), base)))
        values = mix(letters)
        whole = np.concatenate((np.zeros(1, U), np.cumsum(values * powers[place], dtype=U)))
        # letters after a gap stand one place further left: their sum is taken with powers one lower
        lower = np.concatenate((np.zeros(1, U), np.cumsum(values * powers[np.maximum(place - 1, 0)], dtype=U)))
        before = whole[:-1] - whole[first[owner]]
        after = lower[(first + n)[owner]] - lower[1:]
        rest = mix(before + after + (n[owner] - 1).astype(U))
        own = mix(whole[first + n] - whole[first] + n.astype(U))
    differs = np.ones(len(letters), bool)
    differs[:-1] = (letters[1:] != letters[:-1]) | (owner[1:] != owner[:-1])
    return owner, place, differs, rest, own


def _rest_rows(words: DataFrame) -> DataFrame:
    """(key, id, role): a row for each letter of a word under its place and rest (role 0) and the rest alone (1), and one for the word (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                owner, place, differs, rest, own = rests(batch.column(1))
                with np.errstate(over="ignore"):
                    placed = mix(rest + (place + 1).astype(U) * U(0x9E3779B97F4A7C15))
                # either of two equal neighbours leaves the same rest: it is listed once
                key = np.concatenate((placed, rest[differs], own)).view(np.int64)
                of = np.concatenate((owner, owner[differs], np.arange(len(own))))
                role = np.repeat(np.array([0, 1, 2], np.int8), [len(placed), int(differs.sum()), len(own)])
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0).take(pa.array(of)), pa.array(role)], ["key", "id", "role"])

    return words.select("id", "word").mapInArrow(run, "key long, id long, role byte")


def _near(left: str, right: str) -> Column:
    return (F.abs(F.length(left) - F.length(right)) <= 1) & (F.levenshtein(left, right, 1) == 1)


def one_apart(a: str, b: str) -> bool:
    """Whether one letter put in, left out or replaced makes one word of the other, in time linear in their length."""
    a, b = sorted((a, b), key=len)
    x, y = (np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in (a, b))
    other = x != y[: len(x)]
    if len(x) == len(y):
        return int(other.sum()) == 1
    at = int(other.argmax()) if other.any() else len(x)
    return len(x) + 1 == len(y) and bool((x[at:] == y[at + 1 :]).all())


def _long_near(rows: DataFrame) -> DataFrame:
    """Those of the rows whose words `x` and `y` are one apart, for words of any length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([one_apart(a, b) for a, b in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)], pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, na, b, nb): each pair of the words (word, n) that differ by one letter, once, a before b."""
    rows = scratch.save(_signature_rows(words.filter(F.length("word") <= LONG)), "signatures")
    sizes = scratch.save(rows.groupBy("sig").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    met = rows.join(sizes, "sig")
    few = scratch.save(met.filter(F.col("size") <= CROWD).select("sig", "word", "n"), "few")
    left, right = (few.select("sig", F.col("word").alias(x), F.col("n").alias(f"n{x}")) for x in "ab")
    pairs = left.join(right, "sig").filter((F.col("a") < F.col("b")) & _near("a", "b")).select("a", "na", "b", "nb")
    crowd = met.filter(F.col("size") > CROWD).select("word", "n").union(words.filter(F.length("word") >= LONG).select("word", "n")).distinct()
    crowd = scratch.save(crowd.withColumn("id", F.monotonically_increasing_id()), "crowd")
    keys = scratch.save(_rest_rows(crowd), "rests")
    left, right = (keys.select("key", F.col("id").alias(x), F.col("role").alias(f"r{x}")) for x in "ij")
    same = left.filter("ri = 0").join(right.filter("rj = 0"), "key").filter("i < j").select("i", "j")
    longer = left.filter("ri = 1").join(right.filter("rj = 2"), "key").select("i", "j")
    met = same.unionByName(longer).distinct()
    of = lambda i, w: crowd.select(F.col("id").alias(i), F.col("word").alias(w), F.col("n").alias(f"n{w}"))
    more = scratch.save(met.join(of("i", "x"), "i").join(of("j", "y"), "j").select("x", "nx", "y", "ny"), "met")
    short = F.greatest(F.length("x"), F.length("y")) <= LONG
    more = more.filter(short & _near("x", "y")).unionByName(_long_near(more.filter(~short)))
    first = F.col("x") < F.col("y")
    more = more.select(*(F.when(first, p).otherwise(q).alias(name) for name, p, q in (("a", F.col("x"), F.col("y")), ("na", F.col("nx"), F.col("ny")), ("b", F.col("y"), F.col("x")), ("nb", F.col("ny"), F.col("nx")))))
    return scratch.save(pairs.unionByName(more).distinct(), "pairs")


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of (word, form): every step doubles the way, and n grows tenfold at each form, so steps are few."""
    now = scratch.save(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("w"), F.col("root").alias("next"))
        new = scratch.save(now.join(onward, now.root == onward.w, "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        scratch.drop(now)
        if not new.filter("moved").limit(1).count():
            return new.select("word", "root")
        now = new.select("word", "root")
        now._cairn_path = new._cairn_path


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of the texts: see the contract of the query below."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.save(word_counts(docs), "words")
    pairs = near_words(words, scratch)
    both = pairs.select(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("other"), F.col("nb").alias("m"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("nb").alias("n"), F.col("a").alias("other"), F.col("na").alias("m")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("down"), "other")).alias("best"), F.first("n").alias("n"))
    is_form = -F.col("best.down") >= TIMES * F.col("n")
    best = scratch.save(best.select("word", "n_near", F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.down")).alias("form_n")), "best")
    roots = _roots(best.filter("form is not null"), scratch)
    out = words.join(best, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def op13_partenum_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_RUNS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')"

ORACLE_SQL = rf"""
WITH RECURSIVE o AS (SELECT doc_id, unnest({_RUNS}) AS run FROM documents),
u AS (SELECT row_number() OVER () AS k, *, coalesce(doc_id::VARCHAR, '') || ':' || run AS f FROM (SELECT doc_id, run, count(*) AS times FROM o WHERE length(run) >= {SHORTEST} GROUP BY doc_id, run)),{crc.sql("u", "k", "f")},
x AS (SELECT times, CASE WHEN crc % {ALTERED} = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word FROM u JOIN crc_of c ON c.k = u.k),
w AS (SELECT word, sum(times)::BIGINT AS n FROM x WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(times) >= {LEAST}),
d AS (SELECT word, n, length(word) AS size, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT a.word AS word, a.n, b.word AS other, b.n AS m FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, d.n, w.word, w.n FROM d JOIN w ON d.rest = w.word UNION SELECT w.word, w.n, d.word, d.n FROM d JOIN w ON d.rest = w.word),
q AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM p),
e AS (SELECT word, n_near, CASE WHEN m >= {TIMES} * n THEN other END AS form, CASE WHEN m >= {TIMES} * n THEN m END AS form_n FROM q WHERE place = 1),
t AS (SELECT word, word AS last, 0 AS step FROM w UNION ALL SELECT t.word, e.form, step + 1 FROM t JOIN e ON e.word = t.last WHERE e.form IS NOT NULL),
r AS (SELECT word, arg_max(last, step) AS root FROM t GROUP BY word)
SELECT w.word, form, root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n::BIGINT AS form_n FROM w JOIN r ON r.word = w.word LEFT JOIN e ON e.word = w.word
"""
