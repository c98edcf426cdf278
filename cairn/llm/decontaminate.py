r"""Benchmark decontamination by spaced seeds (operator 10, native).

A seed is a window of words of which a fixed mask reads only some; a substituted word at an
ignored position leaves the seed's hash as it was.  Hashes of the documents' windows meet those of
the benchmark's.  Each hit fixes an alignment (document, item, start); the alignments are made distinct, the words
of both are then joined to them and compared over the whole item, and the overlap is kept if most of them agree, or
most in some LOCAL words in a row: a document may hold a part of an item only.

The masks were chosen so that together they meet every way to substitute a quarter of 12, 15, 16, 20 or 24 words.

The documents' windows stream past a bit map of the benchmark's seeds, of fixed size, in one generated
stage; only windows with a set bit go on to the join on the hashes themselves.  The seed table has a row of three
numbers for each place; it is broadcast only if these rows, counted first, are at most BROADCAST_SEEDS.  Items of
equal words are one until the end.

Defined results: words are `[^\x20\x09-\x0D]+`, letters lowered.  Null, empty and texts shorter than an item's seeds
have no window.  Items of FEWEST to SPAN - 1 words are found word for word only; shorter ones cannot be told from a phrase, and are found
where a document's whole text is their words.  Repeated documents and items are reported each by their ids; of an item_id with several texts
the greatest counts; of a doc_id with several texts the best overlap of any.  Empty tables give an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .columns import foreign_names_kept
from .scratch import Scratch
from .sieve import bit_map, may_be_in, without

#: masks of five words each, in windows of up to SPAN; the last is for items shorter than SPAN words, of FEWEST at least
MASKS = ((0, 1, 3, 4, 5), (0, 1, 5, 7, 8), (0, 1, 2, 4, 9), (0, 4, 6, 8, 9), (0, 2, 5, 7, 8), (0, 1, 2, 3, 4))
SPAN, FEWEST, SHORT = 10, 5, len(MASKS) - 1
#: share of the aligned words that must agree, and their least number; or else the share in some LOCAL of them
MIN_PERCENT, MIN_WORDS, LOCAL = 75, 10, 16
#: places of seeds that may be broadcast: 24 bytes each
BROADCAST_SEEDS = 1_000_000
#: texts of one word and of fewer than FEWEST
FEW_WORDS = rf"\A[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++(?:[\x20\x09-\x0D]++[^\x20\x09-\x0D]++){{0,{FEWEST - 2}}}[\x20\x09-\x0D]*+\z"
#: bits of the seed map, as a power of two
MAP_BITS = 24


def _words(text: str) -> Column:
    """Hashes of a text's words."""
    plain = F.lower(F.coalesce(F.col(text), F.lit("")))
    return F.filter(F.split(plain, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _seeds(masks: list[int]) -> list[Column]:
    """The hash of each mask's words from word `i` of `h` on; null where the text ends before the mask."""
    word = lambda k: F.get("h", F.col("i") + k)
    return [F.when(F.col("i") + MASKS[m][-1] < F.size("h"), F.xxhash64(F.lit(m), *[word(k) for k in MASKS[m]])) for m in masks]


def _windows(df: DataFrame) -> DataFrame:
    """A row per window: its start `i` and the array `h` of the text's word hashes."""
    some = df.filter(F.size("h") >= FEWEST)
    return some.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("h") - FEWEST)))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, n_words, n_equal): where a document holds most of an item's words.

    `start` is the document's word at which the item begins (negative if its beginning is cut off),
    `n_words` the aligned words and `n_equal` those that agree.  One row per document and item, the
    best alignment.
    """
    scratch = Scratch(docs.sparkSession, "seeds")
    hashed = lambda text: F.transform(_words(text), lambda w: F.xxhash64(w))
    named = benchmark.groupBy("item_id").agg(F.max("text").alias("text")).select("item_id", hashed("text").alias("item"))
    named = scratch.save(named.select("item_id", "item", F.min("item_id").over(Window.partitionBy("item")).alias("one")), "items")
    items = named.filter("item_id = one").select(F.col("one"), F.col("item").alias("h"))
    seeds = F.when(F.size("h") < SPAN, F.array(*_seeds([SHORT]))).otherwise(F.array(*_seeds(list(range(SHORT)))))
    bank = _windows(items).select("one", F.size("h").alias("size"), F.col("i").alias("at"), F.explode(seeds).alias("seed")).filter("seed is not null")
    bank = scratch.save(bank, "bank")
    bits = bit_map(bank, "seed", MAP_BITS)
    places = F.broadcast(bank) if bank.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS else bank
    row = F.xxhash64("doc_id", "text").alias("row")
    windows = _windows(docs.select(row, hashed("text").alias("h"))).select("row", "i", F.explode(F.array(*_seeds(list(range(len(MASKS)))))).alias("seed"))
    hits = windows.filter(F.coalesce(may_be_in(bits, F.col("seed"), MAP_BITS), F.lit(False))).join(places, "seed")
    hits = scratch.save(hits.select("row", "one", "size", (F.col("i") - F.col("at")).alias("start")).distinct(), "hits")
    # only documents with a hit are read again, and shuffled, once each with all their alignments
    listed = bit_map(hits, "row")
    texts = docs.select("doc_id", "text", row).filter(may_be_in(listed, F.col("row"))).dropDuplicates(["doc_id", "row"])
    each = hits.groupBy("row").agg(F.collect_list(F.struct("one", "size", "start")).alias("hits"))
    met = texts.select("doc_id", "row", hashed("text").alias("h")).join(each, "row").select("doc_id", "h", F.explode("hits").alias("x"))
    # of a document's words only those along the item go on
    start, lo = F.col("x.start"), F.greatest(F.lit(0), -F.col("x.start"))
    hi = F.least(F.col("x.size"), F.size("h") - start)
    parts = met.select("doc_id", "x.one", "x.size", start.alias("start"), lo.alias("lo"), F.slice("h", start + lo + 1, hi - lo).alias("part"))
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda s, x: s + x)
    both = parts.join(items.select("one", F.col("h").alias("item")), "one")
    equal = F.zip_with("part", F.slice("item", F.col("lo") + 1, F.size("part")), lambda x, y: (x == y).cast("long"))
    seen = both.select("doc_id", "one", F.col("start").cast("long").alias("start"), "size", F.size("part").cast("long").alias("n_words"), equal.alias("equal"))
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("n_words") - LOCAL + 1).cast("int")), lambda i: total(F.slice("equal", i, LOCAL)))
    seen = seen.withColumn("n_equal", total("equal")).withColumn("n_local", F.array_max(runs))
    most = (100 * F.col("n_equal") >= MIN_PERCENT * F.col("n_words")) | (100 * F.col("n_local") >= MIN_PERCENT * LOCAL)
    good = seen.filter(F.when(F.col("size") < SPAN, F.col("n_equal") == F.col("size")).otherwise((F.col("n_equal") >= MIN_WORDS) & most))
    best = good.groupBy("doc_id", "one").agg(F.max(F.struct("n_equal", "n_words", (-F.col("start")).alias("s"))).alias("m"))
    best = best.select("doc_id", "one", (-F.col("m.s")).alias("start"), F.col("m.n_words").alias("n_words"), F.col("m.n_equal").alias("n_equal"))
    # items without a window: texts that are nothing else
    few = docs.filter(F.col("text").rlike(FEW_WORDS)).select("doc_id", hashed("text").alias("h"))
    n = F.size("h").cast("long")
    best = best.unionByName(few.join(items.filter(F.size("h") < FEWEST), "h").select("doc_id", "one", F.lit(0).cast("long").alias("start"), n.alias("n_words"), n.alias("n_equal")).distinct())
    return best.join(named.select("one", "item_id"), "one").select("doc_id", "item_id", "start", "n_words", "n_equal")


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark")))


@foreign_names_kept
def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the rows of documents that overlap a benchmark item."""
    leaky = Scratch(docs.sparkSession, "leaks").save(overlaps(docs, benchmark).select("doc_id").distinct(), "leaky")
    return without(docs, leaky, "doc_id")


def _seed_sql(masks: range | list[int]) -> str:
    words = lambda m: ", ".join(f"h[i + {k + 1}]" for k in MASKS[m])
    return ", ".join(f"CASE WHEN i + {MASKS[m][-1]} < len(h) THEN concat_ws(' ', {m}, {words(m)}) END" for m in masks)


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS h FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS h FROM benchmark WHERE text IS NOT NULL),
dw AS (SELECT doc_id, i, unnest([{_seed_sql(range(len(MASKS)))}]) AS seed FROM (SELECT doc_id, h, unnest(range(0, len(h) - {FEWEST - 1})) AS i FROM d WHERE len(h) >= {FEWEST})),
bw AS (
  SELECT item_id, i, unnest(CASE WHEN len(h) < {SPAN} THEN [{_seed_sql([SHORT])}] ELSE [{_seed_sql(range(SHORT))}] END) AS seed
  FROM (SELECT item_id, h, unnest(range(0, len(h) - {FEWEST - 1})) AS i FROM b WHERE len(h) >= {FEWEST})),
a AS (
  SELECT DISTINCT doc_id, item_id, dw.i - bw.i AS start FROM dw JOIN bw ON dw.seed = bw.seed
  UNION SELECT doc_id, item_id, 0 FROM d JOIN b ON d.h = b.h WHERE len(b.h) BETWEEN 1 AND {FEWEST - 1}),
p AS (
  SELECT doc_id, item_id, start, d.h AS dh, b.h AS bh, greatest(0, -start) AS lo, least(len(b.h), len(d.h) - start) AS hi FROM a JOIN d USING (doc_id) JOIN b USING (item_id)),
q AS (SELECT doc_id, item_id, start, len(bh) AS size, hi - lo AS n, list_transform(list_zip(dh[start + lo + 1 : start + hi], bh[lo + 1 : hi]), lambda z: CASE WHEN z[1] = z[2] THEN 1 ELSE 0 END) AS same FROM p),
e AS (
  SELECT doc_id, item_id, start, size, n::BIGINT AS n_words, list_sum(same)::BIGINT AS n_equal,
    list_max(list_transform(range(0, greatest(1, n - {LOCAL - 1})), lambda i: list_sum(same[i + 1 : i + {LOCAL}]))) AS n_local FROM q)
SELECT doc_id, item_id, start, n_words, n_equal FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, n_words DESC, start) AS rank FROM e
  WHERE CASE WHEN size < {SPAN} THEN n_equal = size ELSE n_equal >= {MIN_WORDS} AND (100 * n_equal >= {MIN_PERCENT} * n_words OR 100 * n_local >= {MIN_PERCENT * LOCAL}) END)
WHERE rank = 1
"""
