"""Queries of anchored alignments, coding segments and places in compound locations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import blocks
from ..operators import anchored, evidence, segments
from ..operators import sequence as seq
from .alignment import _DIAGONALS
from .registry import query
from .scalars import _BASES, AMINO_ACIDS, _bases


@query()
def q_anchored_block(t):
    """Documents that share a diagonal with an item, as bases, in that item's columns: codons placed by residues."""
    hits = seq.diagonals(t.documents, t.benchmark).select("doc_id", F.col("item_id").alias("ref_id"))
    none = F.lit(None).cast("struct<start:int,end:int,strand:string,codon_start:int>")
    records = hits.join(t.documents.select("doc_id", _bases().alias("sequence")), "doc_id").withColumns({"cds": none, "bypass": F.lit(False)})
    bases = t.benchmark.select(F.col("item_id").alias("ref_id"), _bases().alias("reference"))
    whole = (F.length("reference") - F.length("reference") % 3).cast("int")
    rows = anchored.anchored_block(records, bases.withColumns({"lo": F.lit(0), "hi": whole}))
    return rows.select("doc_id", F.col("ref_id").alias("item_id"), "strand", "method", "internal_stop", "recovered", "row", "shifted", "misphased")


_AA = f"array_to_string(list_transform(regexp_extract_all(whole, '[A-Z][A-Z][A-Z]'), lambda k: CASE WHEN instr(k, 'N') > 0 THEN 'X' ELSE substr('{AMINO_ACIDS}', (instr('TCAG', k[1]) - 1) * 16 + (instr('TCAG', k[2]) - 1) * 4 + instr('TCAG', k[3]), 1) END), '')"


@query(f"""
WITH d AS (SELECT doc_id, b, length(b) AS n, doc_id % 2 = 1 AS turned, doc_id % 3 + 1 AS codon_start FROM (SELECT doc_id, {_BASES} AS b FROM documents) s WHERE length(b) >= 60),
p AS (SELECT *, substr(b, 4, n // 3 - 3) AS one, substr(b, n // 2, n - 5 - n // 2) AS two, CASE WHEN turned THEN reverse(translate(b, 'ACGTN', 'TGCAN')) ELSE b END AS oriented FROM d),
s AS (SELECT *, substr(CASE WHEN turned THEN reverse(translate(two, 'ACGTN', 'TGCAN')) || reverse(translate(one, 'ACGTN', 'TGCAN')) ELSE one || two END, codon_start) AS cod FROM p),
w AS (SELECT *, substr(cod, 1, length(cod) - length(cod) % 3) AS whole FROM s),
a AS (SELECT *, {_AA} AS r FROM w)
SELECT doc_id, CASE WHEN turned THEN '-' ELSE '+' END AS strand, substr(oriented, 1, CASE WHEN turned THEN 6 ELSE 3 END) AS ncr5, substr(oriented, CASE WHEN turned THEN n - 2 ELSE n - 5 END) AS ncr3,
  CASE WHEN ends_with(r, '*') THEN substr(whole, 1, length(whole) - 3) ELSE whole END AS orf_nt, translate(CASE WHEN ends_with(r, '*') THEN substr(r, 1, length(r) - 1) ELSE r END, '*', 'X') AS aa,
  (length(r) - length(replace(r, '*', '')) - CASE WHEN ends_with(r, '*') THEN 1 ELSE 0 END)::INTEGER AS n_internal_stops FROM a""")
def q_annotated_segments(t):
    """Two parts of each document's bases, on one strand or the other, as its coding text, with its flanks."""
    docs = t.documents.select(F.col("doc_id").alias("record_id"), blocks.bases_once("text").alias("sequence")).filter(F.length("sequence") >= 60)
    sizes = t.documents.select(F.col("doc_id").alias("record_id"), blocks.n_bases_once("text").cast("int").alias("n")).filter("n >= 60")
    ids = t.documents.select(F.col("doc_id").alias("record_id"))  # those without parts are passed over
    n, turned = F.col("n"), F.col("record_id") % 2 == 1
    third, half = F.floor(n / 3).cast("int"), F.floor(n / 2).cast("int")
    strand = F.when(turned, "-").otherwise("+")
    part = lambda first, a, b: F.struct(F.when(turned, 3 - first).otherwise(first).alias("part_ordinal"), a.alias("start_1based"), b.alias("end_1based_inclusive"), strand.alias("strand"))
    parts = sizes.select(F.col("record_id").alias("feature_id"), F.explode(F.array(part(1, F.lit(4), third), part(2, half, n - 6))).alias("p")).select("feature_id", "p.*")
    features = ids.select(F.col("record_id").alias("feature_id"), "record_id", F.lit(1).alias("feature_ordinal"), F.lit("CDS").alias("feature_key"))
    said = ids.select(F.col("record_id").alias("feature_id"), F.lit(1).alias("qualifier_ordinal"), F.lit(1).alias("value_ordinal"), F.lit("codon_start").alias("qualifier_name"), (F.col("record_id") % 3 + 1).cast("string").alias("qualifier_value"))
    rows = segments.annotated(docs, segments.primary_cds(features, parts, said))
    return rows.select(F.col("record_id").alias("doc_id"), "strand", "ncr5", "ncr3", "orf_nt", "aa", "n_internal_stops")


_LOCATIONS = """
m AS (
  SELECT l_orderkey AS f, l_linenumber AS part_ordinal, l_linenumber * 40 + 1 AS lo, l_linenumber * 40 + l_quantity::BIGINT AS hi, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand,
    coalesce(sum(l_quantity::BIGINT) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins, l_quantity::BIGINT AS size
  FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY ALL))"""


def _locations(t):
    """Lines of an order as parts of a compound location: neighbours may overlap, returned ones are turned; lines of one number are one part."""
    lines = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"), F.max("l_returnflag").alias("l_returnflag"))
    start = F.col("l_linenumber") * 40 + 1
    return lines.select(F.col("l_orderkey").alias("feature_id"), F.col("l_linenumber").alias("part_ordinal"), start.alias("start_1based"), (start - 1 + F.col("l_quantity").cast("long")).alias("end_1based_inclusive"), F.when(F.col("l_returnflag") == "R", "-").otherwise("+").alias("strand"))


@query(f"""
WITH {_LOCATIONS}, q AS (SELECT o_orderkey, o_custkey % 150 AS spliced FROM orders)
SELECT o_orderkey, spliced, part_ordinal, strand, (CASE WHEN strand = '-' THEN hi - (spliced - begins) ELSE lo + (spliced - begins) END)::BIGINT AS position
FROM q LEFT JOIN m ON f = o_orderkey AND spliced >= begins AND spliced < begins + size""")
def q_spliced_to_record(t):
    places = t.orders.select(F.col("o_orderkey").alias("feature_id"), (F.col("o_custkey") % 150).alias("spliced"))
    return segments.to_record(places, _locations(t)).withColumnRenamed("feature_id", "o_orderkey")


@query(f"""
WITH {_LOCATIONS}, q AS (SELECT o_orderkey, o_custkey % 300 AS position FROM orders)
SELECT o_orderkey, position, part_ordinal, strand, (begins + CASE WHEN strand = '-' THEN hi - position ELSE position - lo END)::BIGINT AS spliced
FROM q LEFT JOIN m ON f = o_orderkey AND position BETWEEN lo AND hi""")
def q_record_to_spliced(t):
    positions = t.orders.select(F.col("o_orderkey").alias("feature_id"), (F.col("o_custkey") % 300).alias("position"))
    return segments.to_spliced(positions, _locations(t)).withColumnRenamed("feature_id", "o_orderkey")


@query("""
WITH g AS (SELECT item_id, regexp_replace(regexp_replace(text, '[^a-z]', '-', 'g'), 'e', '-', 'g') AS q, regexp_replace(regexp_replace(text, '[^a-z]', '-', 'g'), 't', '-', 'g') AS r FROM benchmark),
c AS (SELECT item_id, i, r[i] <> '-' AS in_r, q[i] <> '-' AS in_q FROM g, range(1, length(g.r) + 1) x(i)),
s AS (SELECT *, sum(CASE WHEN in_r THEN 3 ELSE 0 END) OVER w - 3 AS rp, sum(CASE WHEN in_q THEN 3 ELSE 0 END) OVER w - 3 AS qp, sum(CASE WHEN in_r AND in_q THEN 0 ELSE 1 END) OVER w AS island FROM c WINDOW w AS (PARTITION BY item_id ORDER BY i ROWS UNBOUNDED PRECEDING))
SELECT item_id, min(rp)::BIGINT AS r, min(qp)::BIGINT AS q, 3 * count(*)::BIGINT AS n FROM s WHERE in_r AND in_q GROUP BY item_id, island""")
def q_codon_runs(t):
    """Two gapped rows of residues as runs of codons: what both have, in the places of either's bases."""
    letters = F.regexp_replace("text", "[^a-z]", "-")
    runs = blocks.of_gapped(F.translate(letters, "t", "-"), F.translate(letters, "e", "-"), F.lit(0), F.lit(0), 3)
    return t.benchmark.select("item_id", F.explode(runs).alias("b")).select("item_id", F.col("b.r").cast("long").alias("r"), F.col("b.q").cast("long").alias("q"), F.col("b.n").cast("long").alias("n"))


_EVIDENCE = f"""
WITH {_DIAGONALS},
x AS (SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN reverse(translate(b, 'ACGTN', 'TGCAN')) ELSE b END AS b FROM (SELECT doc_id, {_BASES} AS b FROM documents WHERE doc_id IN (SELECT doc_id FROM d)) s),
y AS (SELECT doc_id, '+' AS strand, b FROM x UNION ALL SELECT doc_id, '-', reverse(translate(b, 'ACGTN', 'TGCAN')) FROM x),
f AS (SELECT item_id, {_BASES} AS b, length({_BASES}) // 3 AS near FROM benchmark),
qk AS (SELECT doc_id, strand, i AS pos, substr(b, i + 1, {seq.SEED}) AS k FROM y, range(0, greatest(length(b) - {seq.SEED - 1}, 0)) g(i)),
rk AS (SELECT item_id, near, i AS rpos, substr(b, i + 1, {seq.SEED}) AS k FROM f, range(0, greatest(length(b) - {seq.SEED - 1}, 0)) g(i)),
w AS (SELECT unnest([false, true]) AS wide),
s AS (
  SELECT doc_id, item_id, strand, wide, rpos - pos AS diag, count(*) AS n, min(pos) AS q0 FROM qk JOIN rk ON qk.k = rk.k JOIN d USING (doc_id, item_id), w WHERE wide OR rpos >= near GROUP BY 1, 2, 3, 4, 5),
b AS (SELECT doc_id, item_id, strand, wide, diag FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id, strand, wide ORDER BY n DESC, q0, q0 + diag) AS i FROM s) WHERE i = 1 AND n >= {seq.MIN_ANCHORS}),
l AS (SELECT b.*, y.b AS q, f.b AS r, greatest(CASE WHEN wide THEN 0 ELSE near END, diag) AS lo, least(length(f.b), length(y.b) + diag) AS hi FROM b JOIN y USING (doc_id, strand) JOIN f USING (item_id)),
p AS (SELECT doc_id, item_id, strand, wide, lo, i, substr(r, CAST(i + 1 AS BIGINT), 1) AS a, substr(q, CAST(i - diag + 1 AS BIGINT), 1) AS c FROM l, range(lo, hi) g(i)),
k AS (
  SELECT doc_id, item_id, strand, wide, (i - lo) // {evidence.CHUNK} AS chunk, count(*) FILTER (NOT wide OR a <> 'N' AND c <> 'N') AS n, count(*) FILTER (a <> c AND (NOT wide OR a <> 'N' AND c <> 'N')) AS bad FROM p GROUP BY ALL),
m AS (SELECT doc_id, item_id, strand, wide, sum(n) AS compared, sum(bad) * 100.0 / sum(n) AS pct FROM k GROUP BY ALL HAVING sum(n) > 0),
h AS (
  SELECT m.doc_id, m.item_id, m.strand, m.wide, count(*) >= {evidence.CHUNKS_LEAST} AND bool_and(abs(bad * 100.0 / n - pct) <= {evidence.DEVIATION}) AS even FROM m JOIN k USING (doc_id, item_id, strand, wide) WHERE n >= {evidence.CHUNK_LEAST} GROUP BY ALL),
g AS (
  SELECT m.*, row_number() OVER (PARTITION BY doc_id, item_id, wide ORDER BY compared DESC, strand) AS best FROM m LEFT JOIN h USING (doc_id, item_id, strand, wide)
  WHERE compared >= {seq.MIN_COMPARED} AND pct <= {seq.IMPLAUSIBLE_PERCENT} AND (coalesce(even, false) OR NOT wide AND compared >= {evidence.GUARDED_BELOW}))
SELECT doc_id, item_id, pct AS percent, compared::BIGINT AS compared, strand, CASE WHEN wide THEN '{evidence.WIDE}' ELSE '{evidence.REGION}' END AS basis
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY wide) AS first FROM g WHERE best = 1) WHERE first = 1"""


@query(_EVIDENCE)
def q_strand_evidence(t):
    """Bases of documents, every second one turned, against an item they share a diagonal with: its last two thirds, else all of it."""
    hits = seq.diagonals(t.documents, t.benchmark).select("doc_id", F.col("item_id").alias("ref_id"))
    given = F.when(F.col("doc_id") % 2 == 1, blocks.reverse_complement(_bases())).otherwise(_bases())
    records = hits.join(t.documents.select("doc_id", given.alias("sequence")), "doc_id").withColumn("by_band", F.lit(False))
    size = F.length("reference")
    refs = t.benchmark.select(F.col("item_id").alias("ref_id"), _bases().alias("reference")).withColumns({"region_lo": F.floor(size / 3).cast("int"), "region_hi": size, "wide_lo": F.lit(0)})
    rows = evidence.measure_evidence(records, refs)
    return rows.select("doc_id", F.col("ref_id").alias("item_id"), "percent", F.col("compared").cast("long").alias("compared"), "strand", "basis")
