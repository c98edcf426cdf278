"""Queries of sequence and alignment operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from ..operators import distance, pairwise, tiles
from ..operators import sequence as seq
from .registry import query
from .scalars import _BASES, AMINO_ACIDS, _bases, translate_codon

L = F.lit

_DIAGONALS = f"""
q AS (SELECT doc_id, i AS pos, substr(text, i + 1, {seq.SEED}) AS k FROM documents, range(0, greatest(length(text) - {seq.SEED - 1}, 0)) g(i)),
r AS (SELECT item_id, i AS rpos, substr(text, i + 1, {seq.SEED}) AS k FROM benchmark, range(0, greatest(length(text) - {seq.SEED - 1}, 0)) g(i)),
v AS (SELECT doc_id, item_id, rpos - pos AS diag, count(*) AS n, min(pos) AS q0, min(rpos) AS r0 FROM q JOIN r ON q.k = r.k GROUP BY 1, 2, 3 HAVING count(*) >= {seq.MIN_ANCHORS}),
d AS (SELECT doc_id, item_id, diag, n::BIGINT AS n FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n DESC, q0, r0) AS i FROM v) WHERE i = 1)"""
_POSITIONS = """
p AS (SELECT d.doc_id, d.item_id, d.diag, substr(x.text, CAST(i + 1 AS BIGINT), 1) AS a, substr(b.text, CAST(i + diag + 1 AS BIGINT), 1) AS b
  FROM d JOIN documents x ON x.doc_id = d.doc_id JOIN benchmark b ON b.item_id = d.item_id, range(greatest(0, -diag), least(length(x.text), length(b.text) - diag)) g(i))"""


@query(f"WITH {_DIAGONALS} SELECT doc_id, item_id, diag, n FROM d")
def q_kmer_diagonal(t):
    return seq.diagonals(t.documents, t.benchmark)


def _measured(t, readable=None):
    rows = seq.along(seq.diagonals(t.documents, t.benchmark), t.documents, t.benchmark)
    return seq.divergence(rows, readable).select("doc_id", "item_id", "diag", "compared", "mismatches")


@query(f"WITH {_DIAGONALS}, {_POSITIONS} SELECT doc_id, item_id, count(*)::BIGINT AS compared, count(*) FILTER (a <> b)::BIGINT AS mismatches FROM p GROUP BY 1, 2 HAVING count(*) >= 50 AND 100 * count(*) FILTER (a <> b) <= 40 * count(*)")
def q_ungapped_divergence(t):
    """Mismatches along the best diagonal, where at least 50 letters compare and at most 40 % differ."""
    rows = _measured(t).filter((F.col("compared") >= seq.MIN_COMPARED) & (100 * F.col("mismatches") <= seq.IMPLAUSIBLE_PERCENT * F.col("compared")))
    return rows.select("doc_id", "item_id", "compared", "mismatches")


_LETTERS = "^[A-Za-z]$"


@query(f"WITH {_DIAGONALS}, {_POSITIONS} SELECT doc_id, item_id, count(*)::BIGINT AS compared, count(*) FILTER (a <> b)::BIGINT AS mismatches FROM p WHERE regexp_matches(a, '{_LETTERS}') AND regexp_matches(b, '{_LETTERS}') GROUP BY 1, 2 HAVING count(*) >= 50")
def q_masked_divergence(t):
    """The same, only where both letters can be read."""
    return _measured(t, _LETTERS).filter(F.col("compared") >= seq.MIN_COMPARED).select("doc_id", "item_id", "compared", "mismatches")


@query(f"""
WITH {_DIAGONALS}, {_POSITIONS}, f AS (SELECT doc_id, min(CASE WHEN c >= 200 THEN m END) AS full_m, min(m) AS any_m FROM (SELECT doc_id, item_id, count(*) AS c, count(*) FILTER (a <> b)::BIGINT AS m FROM p GROUP BY 1, 2) GROUP BY 1)
SELECT doc_id, coalesce(full_m, any_m) AS mismatches, CASE WHEN full_m IS NOT NULL THEN 'long' ELSE 'fallback' END AS basis FROM f""")
def q_fallback_measure(t):
    """The measure over long overlaps, else over any, and which it is."""
    by_doc = _measured(t).groupBy("doc_id").agg(F.min(F.when(F.col("compared") >= 200, F.col("mismatches"))).alias("full"), F.min("mismatches").alias("any"))
    return by_doc.select("doc_id", F.coalesce("full", "any").alias("mismatches"), F.when(F.col("full").isNotNull(), "long").otherwise("fallback").alias("basis"))


_COLUMNS = "c AS (SELECT lang, doc_id, i - 1 AS position, letter FROM (SELECT lang, doc_id, unnest(string_split(text, '')) AS letter, generate_subscripts(string_split(text, ''), 1) AS i FROM documents) WHERE letter <> ''), n AS (SELECT lang, position, letter, count(*) AS n, min(doc_id) AS first FROM c GROUP BY 1, 2, 3)"


@query(f"WITH {_COLUMNS} SELECT lang, position::BIGINT AS position, letter, n::BIGINT AS n FROM (SELECT *, row_number() OVER (PARTITION BY lang, position ORDER BY n DESC, first) AS i FROM n) WHERE i = 1")
def q_column_consensus(t):
    counts = seq.letter_counts(t.documents, "lang", "doc_id", "text")
    return seq.consensus(counts, "lang", first_seen=True).withColumn("position", F.col("position").cast("long"))


@query(f"WITH {_COLUMNS} SELECT lang, position::BIGINT AS position, CASE WHEN letter = '-' THEN '0' ELSE letter END AS code, n::BIGINT AS n FROM (SELECT *, row_number() OVER (PARTITION BY lang, position ORDER BY n DESC, ord(letter)) AS i FROM n) WHERE i = 1")
def q_column_consensus_code(t):
    counts = seq.letter_counts(t.documents, "lang", "doc_id", "text")
    rows = seq.consensus(counts, "lang", first_seen=False)
    return rows.select("lang", F.col("position").cast("long").alias("position"), F.when(F.col("letter") == "-", "0").otherwise(F.col("letter")).alias("code"), "n")


_CODONS = f"""
k AS (SELECT doc_id, lang, generate_subscripts(ks, 1) AS i, unnest(ks) AS codon FROM (SELECT doc_id, lang, regexp_extract_all({_BASES}, '[A-Z][A-Z][A-Z]') AS ks FROM documents) s),
a AS (SELECT *, CASE WHEN instr(codon, 'N') > 0 THEN 'X' ELSE substr('{AMINO_ACIDS}', (instr('TCAG', codon[1]) - 1) * 16 + (instr('TCAG', codon[2]) - 1) * 4 + instr('TCAG', codon[3]), 1) END AS aa FROM k)"""


def _codons(df):
    rows = df.select("doc_id", "lang", _bases().alias("b")).filter(F.length("b") >= 3)
    at = rows.select("doc_id", "lang", F.posexplode(F.regexp_extract_all("b", L("(.{3})"), L(1))).alias("i", "codon"))
    return at.withColumn("aa", translate_codon(F.col("codon")))


@query(f"""
WITH {_CODONS}, r AS (SELECT * FROM a WHERE doc_id = (SELECT min(doc_id) FROM documents))
SELECT a.doc_id, count(*)::BIGINT AS compared, count(*) FILTER (a.aa <> r.aa)::BIGINT AS different FROM a JOIN r ON a.i = r.i WHERE a.aa <> 'X' AND r.aa <> 'X' GROUP BY 1""")
def q_codon_distance(t):
    """Residues against the first record's; codons that cannot be read are skipped."""
    codons = _codons(t.documents).filter("aa <> 'X'")
    first = t.documents.agg(F.min("doc_id")).scalar()
    ref = codons.filter(F.col("doc_id") == first).select("i", F.col("aa").alias("ref"))
    return codons.join(ref, "i").groupBy("doc_id").agg(F.count("*").alias("compared"), F.count_if(F.col("aa") != F.col("ref")).alias("different"))


@query(f"""
WITH {_CODONS}, c AS (SELECT lang, i, codon AS cc, aa AS ca FROM (SELECT lang, i, codon, aa, row_number() OVER (PARTITION BY lang, i ORDER BY count(*) DESC, codon) AS rk FROM a GROUP BY lang, i, codon, aa) WHERE rk = 1)
SELECT a.doc_id, count(*) FILTER (a.aa <> 'X' AND ca <> 'X')::BIGINT AS assessable, count(*) FILTER (a.aa <> 'X' AND ca <> 'X' AND codon <> cc AND a.aa = ca)::BIGINT AS synonymous, count(*) FILTER (a.aa <> 'X' AND ca <> 'X' AND a.aa <> ca)::BIGINT AS nonsynonymous, count(*) FILTER (a.aa = 'X')::BIGINT AS unreadable
FROM a JOIN c ON a.lang = c.lang AND a.i = c.i GROUP BY 1""")
def q_codon_classify(t):
    """Codons against their group's consensus: same residue, another, or not to be told."""
    # places of all groups: the longest text of each, and no more
    widest = t.documents.groupBy("lang").agg(F.max(F.length("text")).alias("n")).agg(F.sum("n")).first()[0] or 0
    rows = t.documents.select("doc_id", "lang", _bases().alias("b"))
    return seq.codon_classes(rows, "doc_id", "lang", "b", widest // 3 <= seq.BROADCAST_SEEDS)


@query(r"""
SELECT page_id, CASE WHEN instr(html, '<article>') > 0 THEN 'annotated' WHEN instr(html, '<p>') > 0 THEN 'inferred' ELSE 'none' END AS basis,
  CASE WHEN instr(html, '<article>') > 0 THEN split_part(substr(html, instr(html, '<article>') + 9), '</article>', 1) WHEN instr(html, '<p>') > 0 THEN split_part(substr(html, instr(html, '<p>') + 3), '</p>', 1) ELSE '' END AS segment,
  CASE WHEN instr(html, '<article>') = 0 AND instr(html, '<p>') = 0 THEN 'no segment found' ELSE '' END AS reason FROM pages""")
def q_segment_fallback(t):
    """The annotated segment, else one inferred, else none and why."""
    at = lambda mark: F.instr("html", mark)
    cut = lambda mark: F.substring_index(F.substr("html", at(mark) + len(mark)), mark.replace("<", "</"), 1)
    annotated, inferred = at("<article>") > 0, at("<p>") > 0
    return t.pages.select("page_id", F.when(annotated, "annotated").when(inferred, "inferred").otherwise("none").alias("basis"), F.when(annotated, cut("<article>")).when(inferred, cut("<p>")).otherwise("").alias("segment"), F.when(annotated | inferred, "").otherwise("no segment found").alias("reason"))


@query("""
SELECT d.doc_id, concat(coalesce(h.block, '------------'), coalesce(m.block, '--------------------'), coalesce(x.block, '------------')) AS stitched,
  concat_ws(';', CASE WHEN h.block IS NULL THEN 'head: too short' END, CASE WHEN m.block IS NULL THEN 'core: not labelled' END, CASE WHEN x.block IS NULL THEN 'tail: too short' END) AS absent
FROM documents d LEFT JOIN (SELECT doc_id, split_part(text, chr(10), 1) AS block FROM documents WHERE n_chars >= 100) h ON h.doc_id = d.doc_id
LEFT JOIN (SELECT b.doc_id, split_part(text, chr(10), 2) AS block FROM documents b JOIN labels l ON l.doc_id = b.doc_id) m ON m.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, split_part(text, chr(10), -1) AS block FROM documents WHERE n_chars >= 500) x ON x.doc_id = d.doc_id""")
def q_stitch_blocks(t):
    """Three blocks side by side in one row; an absent block is a run of gaps, and why it is absent is kept."""
    d = t.documents
    head = d.filter("n_chars >= 100").select("doc_id", F.split_part("text", L("\n"), L(1)).alias("head"))
    core = d.join(t.labels.select("doc_id"), "doc_id").select("doc_id", F.split_part("text", L("\n"), L(2)).alias("core"))
    tail = d.filter("n_chars >= 500").select("doc_id", F.split_part("text", L("\n"), L(-1)).alias("tail"))
    rows = d.select("doc_id").join(head, "doc_id", "left").join(core, "doc_id", "left").join(tail, "doc_id", "left")
    block = lambda c, w: F.coalesce(c, L("-" * w))
    why = lambda c, reason: F.when(F.col(c).isNull(), f"{c}: {reason}")
    return rows.select("doc_id", F.concat(block("head", 12), block("core", 20), block("tail", 12)).alias("stitched"), F.concat_ws(";", why("head", "too short"), why("core", "not labelled"), why("tail", "too short")).alias("absent"))


@query("""
WITH l AS (SELECT vec_id AS land, embedding AS e FROM embeddings WHERE vec_id < 20), p AS (
  SELECT v.vec_id, land, len(list_filter(list_zip(v.embedding, l.e), lambda z: abs(z[1]) > 0.05 AND abs(z[2]) > 0.05)) AS shared FROM embeddings v, l)
SELECT vec_id, count(*) FILTER (shared >= 10)::BIGINT AS resolved, quantile_cont(shared, 0.5)::DOUBLE AS median_shared, count(*) FILTER (shared >= 10) >= 18 AND quantile_cont(shared, 0.5) >= 12 AS confident FROM p GROUP BY 1""")
def q_landmark_confidence(t):
    """Each row against twenty landmarks: how many can be compared, and over how many columns."""
    e = t.embeddings
    readable = lambda x: F.abs(x) > 0.05
    marks = e.filter("vec_id < 20").agg(F.sort_array(F.collect_list(F.struct("vec_id", "embedding"))).alias("m")).scalar()
    rows = e.select("vec_id", "embedding", F.explode(marks).alias("l"))
    shared = F.size(F.filter(F.zip_with("embedding", F.col("l.embedding"), lambda x, y: readable(x) & readable(y)), lambda z: z))
    counts = rows.select("vec_id", shared.alias("shared")).groupBy("vec_id").agg(F.count_if(F.col("shared") >= 10).alias("resolved"), F.percentile("shared", 0.5).alias("median_shared"))
    return counts.withColumn("confident", (F.col("resolved") >= 18) & (F.col("median_shared") >= 12))


@query("""
WITH x AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), v AS (SELECT label, i, avg(x::DOUBLE) AS x FROM x GROUP BY 1, 2),
d AS (SELECT a.label AS a, b.label AS b, sum((a.x - b.x) ** 2) AS s FROM v a JOIN v b ON a.i = b.i GROUP BY 1, 2)
SELECT a, b, round(-0.5 * (s - avg(s) OVER (PARTITION BY a) - avg(s) OVER (PARTITION BY b) + avg(s) OVER ()), 6) + 0.0 AS centered FROM d""")
def q_double_center(t):
    """Squared distances of the groups' means without their row, column and grand means."""
    from pyspark.sql import Window

    v = distance.means(t.embeddings, "label", "embedding")
    a, b = v.select(F.col("label").alias("a"), "i", "x"), v.select(F.col("label").alias("b"), "i", F.col("x").alias("y"))
    d = a.join(b, "i").groupBy("a", "b").agg(F.sum((F.col("x") - F.col("y")) * (F.col("x") - F.col("y"))).alias("s"))
    mean = lambda *keys: F.avg("s").over(Window.partitionBy(*keys))
    return d.select("a", "b", (F.round(-0.5 * (F.col("s") - mean("a") - mean("b") + mean()), 6) + 0.0).alias("centered"))


@query()
def q_pairwise_align(t):
    """Each item against the part of a document around their best diagonal, ends free, in batches."""
    hits = seq.diagonals(t.documents, t.benchmark).join(t.benchmark.select("item_id", F.col("text").alias("p")), "item_id").join(t.documents.select("doc_id", "text"), "doc_id")
    start = F.greatest(L(0), -F.col("diag") - pairwise.MARGIN).cast("int")
    end = (F.length("p") - F.col("diag") + pairwise.MARGIN).cast("int")
    pairs = hits.select("doc_id", "item_id", "p", F.substr("text", start + 1, end - start).alias("q"))

    def run(batches):
        for pdf in batches:
            got = [pairwise.align(p, q) for p, q in zip(pdf.p, pdf.q, strict=True)]
            yield pd.DataFrame({"doc_id": pdf.doc_id, "item_id": pdf.item_id, "score": [float(g[0]) for g in got], "width": [len(p) + len(q) - sum(n for _, _, n in g[1]) for p, q, g in zip(pdf.p, pdf.q, got, strict=True)]})

    return pairs.mapInPandas(run, "doc_id long, item_id long, score double, width long")


#: what the dimensions of a vector are read as: five letters by size, and "-" near 0
_LETTERED = "array_to_string(list_transform(embedding, lambda x: CASE WHEN abs(x::DOUBLE) < 0.02 THEN '-' ELSE substr('abcde', (least(greatest(floor((x::DOUBLE + 1) * 2.5), 0), 4) + 1)::INTEGER, 1) END), '')"
_PAIRS = f"""
c AS (SELECT vec_id, string_split({_LETTERED}, '') AS k FROM embeddings),
p AS (SELECT a.vec_id, b.vec_id AS other, len(list_filter(list_zip(a.k, b.k), lambda z: z[1] <> '-' AND z[2] <> '-')) AS shared, len(list_filter(list_zip(a.k, b.k), lambda z: z[1] <> '-' AND z[1] = z[2])) AS equal FROM c a JOIN c b ON a.vec_id <> b.vec_id)"""
_FLOOR = 56


def _lettered(t):
    one = lambda x: F.when(F.abs(x) < 0.02, "-").otherwise(F.substr(L("abcde"), F.least(F.greatest(F.floor((x + 1) * 2.5), L(0)), L(4)).cast("int") + 1, L(1)))
    return t.embeddings.select(F.col("vec_id").alias("id"), F.array_join(F.transform(F.col("embedding").cast("array<double>"), one), "").alias("row"), "label")


@query(f"""
WITH {_PAIRS} SELECT vec_id, count(*) FILTER (shared >= {_FLOOR})::BIGINT AS comparable, coalesce(sum(shared) FILTER (shared >= {_FLOOR}), 0)::BIGINT AS shared, coalesce(sum(equal) FILTER (shared >= {_FLOOR}), 0)::BIGINT AS equal,
  arg_min(other, (1 - equal / shared, other)) FILTER (shared >= {_FLOOR}) AS nearest, min(1 - equal / shared) FILTER (shared >= {_FLOOR}) AS distance FROM p GROUP BY vec_id""")
def q_all_pairs(t):
    """Every row against every other one, tile by tile: how many compare, over how much, and the nearest."""
    return tiles.summarized(_lettered(t), "abcde", _FLOOR).withColumnRenamed("id", "vec_id")


@query()
def q_comparable_set(t):
    """A greedy set of rows all of which can be compared with each other, in the order of their admission."""
    chosen = tiles.comparable_set(_lettered(t), "abcde", _FLOOR)
    rank = t.spark.createDataFrame(pa.table([pa.array(range(len(chosen)), pa.int64()), pa.array(chosen, pa.int64())], ["place", "id"]))
    return _lettered(t).join(rank, "id").select(F.col("id").alias("vec_id"), "place", "label")


_SELECTIONS = {"all": "TRUE", "short": "n_chars < 2000", "en": "lang = 'en'", "other": "lang <> 'en'"}
_REGIONS = {"head": (0, 60), "middle": (60, 300), "rest": (300, 700)}


@query(f"""
WITH s(selection, reference) AS (VALUES {", ".join(f"('{n}', (SELECT min(doc_id) FROM documents WHERE {c}))" for n, c in _SELECTIONS.items())}),
g(region, lo, hi) AS (VALUES {", ".join(f"('{n}', {lo}, {hi})" for n, (lo, hi) in _REGIONS.items())}),
m AS ({" UNION ALL ".join(f"SELECT '{n}' AS selection, doc_id, text FROM documents WHERE {c}" for n, c in _SELECTIONS.items())}),
x AS (
  SELECT m.selection, g.region, m.doc_id, string_split(rpad(substr(m.text, lo + 1, hi - lo), hi - lo, '-'), '') AS a, string_split(rpad(substr(r.text, lo + 1, hi - lo), hi - lo, '-'), '') AS b
  FROM m JOIN s ON s.selection = m.selection JOIN documents r ON r.doc_id = s.reference, g)
SELECT selection, region, doc_id, len(list_filter(a, lambda c: regexp_matches(c, '^[a-z]$')))::BIGINT AS coverage,
  len(list_filter(list_zip(a, b), lambda z: regexp_matches(z[1], '^[a-z]$') AND regexp_matches(z[2], '^[a-z]$')))::BIGINT AS comparable,
  len(list_filter(list_zip(a, b), lambda z: regexp_matches(z[1], '^[a-z]$') AND regexp_matches(z[2], '^[a-z]$') AND z[1] <> z[2]))::BIGINT AS mismatches, comparable < 30 AS excluded FROM x""")
def q_selection_panels(t):
    """Four selections of documents, each against its first one, in three regions, in one plan."""
    rows = t.documents.select(F.col("doc_id").alias("id"), F.col("text").alias("row"), "lang", "n_chars")
    first = rows.agg(*(F.min(F.when(F.expr(c), F.col("id"))).alias(n) for n, c in _SELECTIONS.items())).first()
    selections = {n: (F.expr(c), first[n]) for n, c in _SELECTIONS.items() if first[n] is not None}
    return tiles.panels(rows, selections, _REGIONS, "a-z", 30).withColumnRenamed("id", "doc_id")


@query()
def q_mds_embed(t):
    """Landmarks, the groups' means, by classical scaling; every row is placed among them."""
    labels, x = distance.landmarks(t.embeddings, "label", "embedding")
    d = distance.cosine(x, x)
    coords, explained, negative = distance.scale(d)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                xy = distance.place(distance.cosine(np.stack(pdf.embedding.to_numpy()), x), d, coords)
                yield pd.DataFrame({"vec_id": pdf.vec_id, "x": xy[:, 0].round(6), "y": xy[:, 1].round(6), "explained": explained, "negative": negative})

    return t.embeddings.select("vec_id", "embedding").mapInPandas(run, "vec_id long, x double, y double, explained double, negative double")


@query()
def q_nj_tree(t):
    """A rooted neighbor-joining tree of the groups' means, with its layout."""
    labels, x = distance.landmarks(t.embeddings, "label", "embedding")
    edges, low, total = distance.clamp(distance.neighbor_joining(distance.cosine(x, x)))
    edges = distance.midpoint_root(edges) if edges else []
    at = distance.ladder_layout(edges) if edges else {}
    rows = [(p, c, labels[c] if c < len(labels) else None, round(length, 6), round(at[c][0], 6), float(at[c][1]), at[c][2], low, float(total)) for p, c, length in edges]
    return t.spark.createDataFrame(rows, "parent long, child long, label int, length double, x double, y double, tips long, clamped long, clamped_total double")
