"""Queries of scalar functions: text, dates, arithmetic, arrays, maps and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import blocks as B
from ..functions import dates, text
from .registry import query

L = F.lit


@query(r"""
SELECT doc_id, trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g')) AS collapsed,
  length(trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g')))::BIGINT AS n_collapsed FROM documents""")
def q_collapse(t):
    c = text.collapse(F.col("text"))
    return t.documents.select("doc_id", c.alias("collapsed"), F.length(c).cast("long").alias("n_collapsed"))




@query("SELECT doc_id, sha256(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')) AS digest FROM documents")
def q_sha256(t):
    upper = F.translate("text", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return t.documents.select("doc_id", F.sha2(upper, 256).alias("digest"))


@query(r"""
SELECT p_partkey, i::BIGINT AS ordinal, name FROM (
  SELECT p_partkey, unnest(names) AS name, generate_subscripts(names, 1) AS i FROM (
    SELECT p_partkey, list_filter(list_transform(string_split(p_name, ' '), lambda x: trim(x)), lambda x: x <> '') AS names FROM part))""")
def q_split_explode(t):
    names = F.filter(F.transform(F.split("p_name", " "), lambda x: F.trim(x)), lambda x: x != "")
    return t.part.select("p_partkey", F.posexplode(names).alias("i", "name")).select("p_partkey", (F.col("i") + 1).cast("long").alias("ordinal"), "name")


@query("SELECT doc_id, reverse(translate(text, 'ACGTUacgtu', 'TGCAAtgcaa')) AS rc FROM documents")
def q_reverse_complement(t):
    return t.documents.select("doc_id", text.reverse_complement(F.col("text")).alias("rc"))


@query("""
SELECT page_id, split_part(url, ':', 1) AS scheme,
  CASE WHEN instr(url, ':') > 0 THEN substr(url, instr(url, ':') + 1) ELSE '' END AS remainder,
  split_part(url, '.', 1) AS base FROM pages""")
def q_split_first_colon(t):
    return t.pages.select("page_id", text.before_first(F.col("url"), ":").alias("scheme"), text.after_first(F.col("url"), ":").alias("remainder"), text.before_first(F.col("url"), ".").alias("base"))


_GEO = "CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN n_name WHEN c_custkey % 5 = 2 THEN concat(n_name, ':') WHEN c_custkey % 5 = 3 THEN concat(n_name, ': ', r_name) ELSE concat(n_name, ':  ', r_name, ',  ', c_mktsegment) END"


@query(f"""
WITH g AS (SELECT c_custkey, trim(regexp_replace({_GEO}, ' +', ' ', 'g')) AS t FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
r AS (SELECT *, trim(CASE WHEN instr(t, ':') > 0 THEN substr(t, instr(t, ':') + 1) ELSE '' END) AS rest FROM g)
SELECT c_custkey, trim(split_part(t, ':', 1)) AS country, trim(split_part(rest, ',', 1)) AS admin1,
  CASE WHEN instr(rest, ',') > 0 THEN rest ELSE '' END AS locality,
  CASE WHEN t = '' THEN 'no_geography_deposited' WHEN rest = '' THEN 'no_admin1_deposited' WHEN instr(rest, ',') > 0 THEN 'deposited_locality' ELSE 'admin1_only' END AS basis,
  rest AS unsuppressed FROM r""")
def q_geo_parse(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    g = rows.select("c_custkey", F.expr(_GEO).alias("deposited")).select("c_custkey", text.geo(F.col("deposited")).alias("g"), F.trim(text.after_first(text.collapse(F.col("deposited")), ":")).alias("unsuppressed"))
    return g.select("c_custkey", "g.country", "g.admin1", "g.locality", "g.basis", "unsuppressed")


_NAME = "CASE p_partkey % 8 WHEN 0 THEN concat('Human poliovirus ', CAST(p_partkey % 3 + 1 AS STRING)) WHEN 1 THEN 'Human poliovirus 30/ROU/2008' WHEN 2 THEN concat('Coxsackievirus A', CAST(p_size AS STRING)) WHEN 3 THEN concat('Echovirus ', CAST(p_size AS STRING)) WHEN 4 THEN concat('Enterovirus D', CAST(p_size AS STRING)) WHEN 5 THEN 'Enterovirus J115' WHEN 6 THEN concat('poliovirus type ', CAST(p_partkey % 3 + 1 AS STRING)) ELSE p_name END"
_TYPE_SQL = r"""CASE
  WHEN regexp_matches(n, '(?i)\bpoliovirus\s+(type\s+)?[123]([^0-9]|$)') THEN concat('PV', regexp_extract(n, '(?i)\bpoliovirus\s+(type\s+)?([123])([^0-9]|$)', 2))
  WHEN regexp_matches(n, '(?i)\bcoxsackievirus\s+[ab][0-9]+\b') THEN concat('CV', upper(regexp_extract(n, '(?i)\bcoxsackievirus\s+([ab][0-9]+)\b', 1)))
  WHEN regexp_matches(n, '(?i)\bechovirus\s+(type\s+)?[0-9]+\b') THEN concat('E', regexp_extract(n, '(?i)\bechovirus\s+(type\s+)?([0-9]+)\b', 2))
  WHEN regexp_matches(n, '(?i)\benterovirus\s+[a-d][0-9]+\b') THEN concat('EV-', upper(regexp_extract(n, '(?i)\benterovirus\s+([a-d][0-9]+)\b', 1)))
  WHEN regexp_matches(n, '(?i)\brhinovirus\s+[a-c][0-9]+\b') THEN concat('RV-', upper(regexp_extract(n, '(?i)\brhinovirus\s+([a-c][0-9]+)\b', 1)))
  ELSE '' END"""


@query(f"SELECT p_partkey, n AS name, {_TYPE_SQL} AS virus_type FROM (SELECT p_partkey, {_NAME} AS n FROM part)")
def q_type_parse(t):
    return t.part.select("p_partkey", F.expr(_NAME).alias("name")).withColumn("virus_type", text.virus_type(F.col("name")))


@query(f"""
SELECT p_partkey, ty AS virus_type, CASE WHEN ty = '' THEN 'unknown' WHEN ty LIKE 'PV%' THEN 'Poliovirus' WHEN ty LIKE 'CVA%' THEN 'Coxsackie A' WHEN ty LIKE 'CVB%' THEN 'Coxsackie B'
  WHEN ty LIKE 'EV-%' THEN 'Enterovirus' WHEN ty LIKE 'RV-%' THEN 'Rhinovirus' ELSE 'Echovirus' END AS family
FROM (SELECT p_partkey, {_TYPE_SQL} AS ty FROM (SELECT p_partkey, {_NAME} AS n FROM part))""")
def q_family_ladder(t):
    rows = t.part.select("p_partkey", text.virus_type(F.expr(_NAME)).alias("virus_type"))
    return rows.withColumn("family", text.family(F.col("virus_type")))


#: specimen categories and the words that name them
CATEGORIES = (("steel", "(?i)STEEL"), ("brass", "(?i)BRASS"), ("small", "(?i)SMALL"), ("promo", "(?i)PROMO"), ("plated", "(?i)PLATED"))


@query("""
SELECT p_partkey, n::BIGINT AS n_categories, CASE WHEN n = 1 THEN c[1] ELSE '' END AS value,
  CASE n WHEN 1 THEN '' WHEN 0 THEN 'no keyword' ELSE concat('ambiguous: ', array_to_string(c, '/')) END AS reason
FROM (SELECT *, len(c) AS n FROM (SELECT p_partkey, list_filter([""" + ", ".join(f"CASE WHEN regexp_matches(p_type, '{p}') THEN '{c}' END" for c, p in CATEGORIES) + """], lambda x: x IS NOT NULL) AS c FROM part))""")
def q_keyword_ambiguity(t):
    found = F.array_compact(F.array(*[F.when(F.col("p_type").rlike(p), c) for c, p in CATEGORIES]))
    rows = t.part.select("p_partkey", found.alias("c")).withColumn("n_categories", F.size("c").cast("long"))
    n = F.col("n_categories")
    return rows.select("p_partkey", "n_categories", F.when(n == 1, F.get("c", L(0))).otherwise("").alias("value"), F.when(n == 1, "").when(n == 0, "no keyword").otherwise(F.concat(L("ambiguous: "), F.array_join("c", "/"))).alias("reason"))


_VOCABULARY = ("vaccine", "wild", "clone")
_REFINE = (("(?i)the [a-z]*n[a-z]* ", "wild"), ("(?i)de la ", "vaccine"), ("(?i)(der|die) ", "clone"), ("(?i)[0-9]{4}", "undated"))


@query("""
SELECT doc_id, CASE WHEN hit IN ('vaccine', 'wild', 'clone') THEN hit ELSE '' END AS refinement FROM (
  SELECT doc_id, CASE """ + " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{v}'" for p, v in _REFINE) + """ END AS hit FROM (SELECT doc_id, concat_ws(' ', lang, source, text) AS t FROM documents))""")
def q_text_refinement(t):
    joined = F.concat_ws(" ", "lang", "source", "text")
    hit = F.coalesce(*[F.when(joined.rlike(p), v) for p, v in _REFINE])
    return t.documents.select("doc_id", F.when(hit.isin(*_VOCABULARY), hit).otherwise("").alias("refinement"))


_FALLBACK = (("mail", "[a-z.0-9]+@[a-z0-9.]+[a-z]"), ("address", "[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+"), ("number", "[0-9]{6,}"))


@query("SELECT doc_id, CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{k}'" for k, p in _FALLBACK) + " ELSE '' END AS value, CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN regexp_extract(text, '{p}')" for k, p in _FALLBACK) + " ELSE '' END AS matched FROM documents")
def q_text_fallback(t):
    hits = [F.when(F.col("text").rlike(p), F.struct(L(k).alias("value"), F.regexp_extract("text", p, 0).alias("matched"))) for k, p in _FALLBACK]
    best = F.coalesce(*hits, F.struct(L("").alias("value"), L("").alias("matched")))
    return t.documents.select("doc_id", best.alias("b")).select("doc_id", "b.value", "b.matched")


@query("""
SELECT p_partkey, p_brand AS brand, p_type AS kind, CAST(p_size AS VARCHAR) AS size_text, 2::BIGINT + 1 AS n_attributes FROM part""")
def q_labelled_attrs(t):
    packed = F.concat(L("brand="), "p_brand", L("; kind = "), "p_type", L(";; size="), F.col("p_size").cast("string"))
    m = t.part.select("p_partkey", text.labelled(packed).alias("m"))
    return m.select("p_partkey", F.col("m")["brand"].alias("brand"), F.col("m")["kind"].alias("kind"), F.col("m")["size"].alias("size_text"), F.size("m").cast("long").alias("n_attributes"))


_MON = "CASE month(o_orderdate) " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(dates.MONTHS, 1)) + " END"
_RENDER = """CASE o_orderkey % 8 WHEN 0 THEN concat(lpad(CAST(day(o_orderdate) AS STRING), 2, '0'), '-', {mon}, '-', CAST(year(o_orderdate) AS STRING))
  WHEN 1 THEN {iso} WHEN 2 THEN concat({mon}, '-', CAST(year(o_orderdate) AS STRING)) WHEN 3 THEN substr({iso}, 1, 7) WHEN 4 THEN CAST(year(o_orderdate) AS STRING)
  WHEN 5 THEN concat(CAST(year(o_orderdate) AS STRING), '/', CAST(year(o_orderdate) + o_orderkey % 4 AS STRING)) WHEN 6 THEN '' ELSE concat('>', CAST(year(o_orderdate) AS STRING)) END"""
_ISO = "concat(CAST(year(o_orderdate) AS STRING), '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '-', lpad(CAST(day(o_orderdate) AS STRING), 2, '0'))"
_DEPOSITED = _RENDER.format(mon=_MON, iso=_ISO)
_DATE_SQL = f"""SELECT o_orderkey, o_orderdate, d AS deposited,
  CASE o_orderkey % 8 WHEN 0 THEN iso WHEN 1 THEN iso WHEN 2 THEN substr(iso, 1, 7) WHEN 3 THEN substr(iso, 1, 7) WHEN 4 THEN substr(iso, 1, 4)
    WHEN 5 THEN CAST((2 * year(o_orderdate) + o_orderkey % 4) // 2 AS VARCHAR) ELSE '' END AS iso,
  CASE o_orderkey % 8 WHEN 0 THEN 'day' WHEN 1 THEN 'day' WHEN 2 THEN 'month' WHEN 3 THEN 'month' WHEN 4 THEN 'year' WHEN 5 THEN 'range' ELSE 'NA' END AS precision
FROM (SELECT o_orderkey, o_orderdate, {_DEPOSITED} AS d, {_ISO} AS iso FROM orders)"""


def _dated(t):
    rows = t.orders.select("o_orderkey", "o_orderdate", F.expr(_DEPOSITED).alias("deposited"))
    return rows.withColumn("n", dates.normalized(F.col("deposited"))).select("o_orderkey", "deposited", "n.iso", "n.precision")


@query(f"SELECT o_orderkey, deposited, iso, precision, substr(iso, 1, 4) AS first_year FROM ({_DATE_SQL})")
def q_date_normalize(t):
    return _dated(t).withColumn("first_year", F.substring("iso", 1, 4))


@query(f"""
SELECT o_orderkey, CASE WHEN precision = 'range' THEN substr(deposited, 1, 4) ELSE '' END AS year_from,
  CASE WHEN precision = 'range' THEN substr(deposited, 6, 4) ELSE '' END AS year_to FROM ({_DATE_SQL})""")
def q_date_range_bounds(t):
    end = lambda k: F.when(F.col("precision") == "range", F.regexp_extract("deposited", "^([0-9]{4})[/-]([0-9]{4})$", k)).otherwise("")
    return _dated(t).select("o_orderkey", end(1).alias("year_from"), end(2).alias("year_to"))


@query(f"""
SELECT outcome, count(*)::BIGINT AS n FROM (
  SELECT CASE WHEN precision <> 'NA' THEN precision WHEN trim(deposited) = '' THEN 'NA' ELSE 'declined: unreadable' END AS outcome FROM ({_DATE_SQL})) GROUP BY 1""")
def q_date_precision(t):
    outcome = F.when(F.col("precision") != "NA", F.col("precision")).when(F.trim("deposited") == "", "NA").otherwise("declined: unreadable")
    return _dated(t).groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


@query(f"""
SELECT o_orderkey, round(CASE precision WHEN 'day' THEN y + (s + d - 0.5) / 365 WHEN 'month' THEN y + (s + 15) / 365.0 WHEN 'year' THEN y + 0.5 WHEN 'range' THEN y + 0.5 END, 6) AS year
FROM (SELECT o_orderkey, precision, TRY_CAST(substr(iso, 1, 4) AS DOUBLE) AS y, [0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334][TRY_CAST(substr(iso, 6, 2) AS INTEGER)]::DOUBLE AS s, TRY_CAST(substr(iso, 9, 2) AS DOUBLE) AS d FROM ({_DATE_SQL}))""")
def q_decimal_year(t):
    return _dated(t).select("o_orderkey", F.round(dates.decimal_year(F.col("iso"), F.col("precision")), 6).alias("year"))


@query("""
SELECT l_orderkey, l_linenumber, CAST(ceil(l_quantity / 3) AS BIGINT) AS codons, CAST(floor(least(300, 0.5 * l_quantity)) AS BIGINT) AS shared_floor FROM lineitem""")
def q_unit_conversion(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.ceil(F.col("l_quantity") / 3).alias("codons"), F.floor(F.least(L(300.0), 0.5 * F.col("l_quantity"))).alias("shared_floor"))


@query("""
SELECT c_custkey, ('0x' || substr(h, 1, 2))::BIGINT % 201 - 100 AS dx, ('0x' || substr(h, 3, 2))::BIGINT % 201 - 100 AS dy
FROM (SELECT c_custkey, sha256(c_name) AS h FROM customer)""")
def q_hash_jitter(t):
    h = F.sha2("c_name", 256)
    byte = lambda at: F.conv(F.substring(h, at, 2), 16, 10).cast("long") % 201 - 100
    return t.customer.select("c_custkey", byte(1).alias("dx"), byte(3).alias("dy"))


@query("SELECT c.conv_id, string_agg(c.text, '|' ORDER BY c.turn) AS spliced, count(*)::BIGINT AS n_parts FROM conversations c GROUP BY 1")
def q_ordered_concat(t):
    parts = F.array_sort(F.collect_list(F.struct("turn", "text")))
    return t.conversations.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "|").alias("spliced"), F.count("*").alias("n_parts"))


@query("""
SELECT event_id, k AS leaf, json_extract_string(props, concat('$."', k, '"')) AS leaf_value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def q_json_leaves(t):
    return t.events.select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("leaf", "leaf_value"))


@query("""
SELECT doc_id, list_distinct_ordered AS words, len(string_split(list_distinct_ordered, ' '))::BIGINT AS n FROM (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS list_distinct_ordered FROM (
    SELECT doc_id, w, min(i) AS i FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents) GROUP BY 1, 2) GROUP BY 1)""")
def q_array_distinct(t):
    words = F.array_distinct(F.split("text", " "))
    return t.documents.select("doc_id", F.array_join(words, " ").alias("words"), F.size(words).cast("long").alias("n"))


@query("SELECT doc_id, ceil(length(text) / 70.0)::BIGINT AS n_lines, CASE WHEN length(text) = 0 THEN 0 ELSE (length(text) - 1) % 70 + 1 END::BIGINT AS last_length FROM documents")
def q_fasta_wrap(t):
    wrapped = F.split(F.regexp_replace(F.translate("text", "\r\n", "  "), r"(?s)(.{70})(?!\z)", "$1\n"), "\n")
    return t.documents.select("doc_id", F.when(F.length("text") == 0, 0).otherwise(F.size(wrapped)).cast("long").alias("n_lines"), F.length(F.element_at(wrapped, -1)).cast("long").alias("last_length"))


_CODE = "translate(lower(text), 'acgtun', '123445')"


@query(f"""
SELECT doc_id, regexp_replace({_CODE}, '[^1-5]', '0', 'g') AS codes, length(regexp_replace({_CODE}, '[^1-4]', '', 'g'))::BIGINT AS readable FROM documents""")
def q_alphabet_encode(t):
    code = F.translate(F.lower("text"), "acgtun", "123445")
    return t.documents.select("doc_id", F.regexp_replace(code, "[^1-5]", "0").alias("codes"), F.length(F.regexp_replace(code, "[^1-4]", "")).cast("long").alias("readable"))


@query("""
SELECT doc_id, seg AS segment, length(seg)::BIGINT AS n FROM (
  SELECT doc_id, arg_max(s, length(s) * 100000 - i) AS seg FROM (SELECT doc_id, unnest(string_split(text, '.')) AS s, generate_subscripts(string_split(text, '.'), 1) AS i FROM documents) GROUP BY 1)""")
def q_longest_segment(t):
    parts = t.documents.select("doc_id", F.posexplode(F.split("text", r"\.")).alias("i", "s"))
    best = parts.groupBy("doc_id").agg(F.max_by("s", F.struct(F.length("s"), -F.col("i"))).alias("segment"))
    return best.withColumn("n", F.length("segment").cast("long"))


@query("""
SELECT s_suppkey, greatest(0.0, s_acctbal) AS clamped, sum(greatest(0.0, -s_acctbal)) OVER () >= 0 AS any_removed, round((SELECT sum(greatest(0.0, -s_acctbal)) FROM supplier), 2) AS removed_total FROM supplier""")
def q_clamp(t):
    removed = t.supplier.agg(F.round(F.sum(F.greatest(L(0.0), -F.col("s_acctbal"))), 2)).scalar()
    return t.supplier.select("s_suppkey", F.greatest(L(0.0), "s_acctbal").alias("clamped"), (removed >= 0).alias("any_removed"), removed.alias("removed_total"))


#: the standard genetic code, in the order T C A G of each position
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
_BASES = "translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACCCGGGTTTAACCNGTACGTTACGT')"


def _bases():
    return B.bases_of("text")


def translate_codon(codon):
    """The residue of a codon; X if a base cannot be read."""
    at = lambda i: F.instr(L("TCAG"), F.substring(codon, i, 1)) - 1
    index = at(1) * 16 + at(2) * 4 + at(3)
    readable = codon.rlike("^[TCAG]{3}$")
    return F.when(readable, F.substr(L(AMINO_ACIDS), index + 1, L(1))).otherwise("X")


@query(f"""
WITH c AS (SELECT doc_id, regexp_extract_all({_BASES}, '[A-Z][A-Z][A-Z]') AS ks FROM documents),
a AS (SELECT doc_id, generate_subscripts(ks, 1) AS i, unnest(ks) AS k FROM c)
SELECT doc_id, string_agg(CASE WHEN instr(k, 'N') > 0 THEN 'X' ELSE substr('{AMINO_ACIDS}', (instr('TCAG', k[1]) - 1) * 16 + (instr('TCAG', k[2]) - 1) * 4 + instr('TCAG', k[3]), 1) END, '' ORDER BY i) AS residues, count(*)::BIGINT AS n_codons FROM a GROUP BY 1""")
def q_translate_codons(t):
    """Whole codons only; a partial codon at the end is dropped.

    A text is translated where it is read, and residues are shuffled; rows of one doc_id stand under each other, place by place.
    """
    rows = t.documents.select("doc_id", B.residues_of(_bases()).alias("r")).filter("r <> ''")
    each = rows.groupBy("doc_id").agg(F.collect_list("r").alias("rs"))
    placed = F.flatten(F.transform("rs", lambda r: F.zip_with(F.sequence(L(1), F.length(r)), F.split(r, ""), lambda i, x: F.struct(i.alias("i"), x.alias("x")))))
    together = F.array_join(F.transform(F.array_sort(F.filter(placed, lambda p: p["x"] != "")), lambda p: p["x"]), "")
    out = each.select("doc_id", F.when(F.size("rs") == 1, F.get("rs", L(0))).otherwise(together).alias("residues"))
    return out.withColumn("n_codons", F.length("residues").cast("long"))


_GAPPED = "regexp_replace(text, '[^a-z]', '-', 'g')"


@query(f"SELECT doc_id, regexp_replace(regexp_replace({_GAPPED}, '([a-z])', '\\1\\1\\1', 'g'), '-', '---', 'g') AS nucleotides, 3 * length({_GAPPED})::BIGINT AS width FROM documents")
def q_backtranslate(t):
    """A residue becomes its codon, a gap three gaps; the width is three times the residues' exactly."""
    residues = F.regexp_replace("text", "[^a-z]", "-")
    spread = F.regexp_replace(F.regexp_replace(residues, "([a-z])", "$1$1$1"), "-", "---")
    return t.documents.select("doc_id", spread.alias("nucleotides"), F.length(spread).cast("long").alias("width"))


@query("SELECT item_id, rpad(text, (SELECT max(length(text)) FROM benchmark)::INTEGER, '-') AS projected FROM benchmark")
def q_projection(t):
    """Each row copied into a gap row as wide as the widest."""
    width = t.benchmark.agg(F.max(F.length("text"))).scalar()
    return t.benchmark.withColumn("width", width).select("item_id", F.concat("text", F.repeat(L("-"), F.col("width") - F.length("text"))).alias("projected"))


@query("""
SELECT l_orderkey, l_linenumber, greatest(l_shipdate, TIMESTAMP '1995-01-01') AS clipped_start, least(l_shipdate + INTERVAL 30 DAY, TIMESTAMP '1996-01-01') AS clipped_end
FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01' AND l_shipdate + INTERVAL 30 DAY > TIMESTAMP '1995-01-01'""")
def q_interval_clip(t):
    lo, hi = F.expr("TIMESTAMP_NTZ '1995-01-01'"), F.expr("TIMESTAMP_NTZ '1996-01-01'")
    # the bound on the column itself reaches the scan
    rows = t.lineitem.filter((F.col("l_shipdate") < hi) & (F.col("l_shipdate") > F.expr("TIMESTAMP_NTZ '1994-12-02'")))
    return rows.select("l_orderkey", "l_linenumber", F.greatest("l_shipdate", lo).alias("clipped_start"), F.least(F.col("l_shipdate") + F.expr("INTERVAL 30 DAY"), hi).alias("clipped_end"))


@query("""
WITH r AS (SELECT i FROM (SELECT unnest(string_split(text, '')) AS x, generate_subscripts(string_split(text, ''), 1) AS i FROM documents WHERE doc_id = (SELECT min(doc_id) FROM documents)) WHERE regexp_matches(x, '^[A-Za-z]$')),
c AS (SELECT doc_id, unnest(string_split(text, '')) AS x, generate_subscripts(string_split(text, ''), 1) AS i FROM documents)
SELECT d.doc_id, coalesce(k.kept, '') AS kept FROM documents d LEFT JOIN (SELECT doc_id, string_agg(x, '' ORDER BY c.i) AS kept FROM c JOIN r ON c.i = r.i GROUP BY doc_id) k ON k.doc_id = d.doc_id""")
def q_column_mask(t):
    """Only the columns at which the reference row, the first, has a letter."""
    letters = F.transform(F.split(F.min_by("text", "doc_id"), ""), lambda x: x.rlike("^[A-Za-z]$"))
    mask = t.documents.agg(letters.alias("mask")).scalar()
    rows = t.documents.select("doc_id", "text", mask.alias("mask"))
    kept = F.filter(F.split("text", ""), lambda x, i: F.coalesce(F.get("mask", i), L(False)))
    return rows.select("doc_id", F.array_join(kept, "").alias("kept"))
