"""Queries of rules, decisions and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import rules
from ..operators.rules import decide, decline, ladder
from .registry import ansi, query
from .scalars import _DATE_SQL, _GEO, _dated

L = F.lit

CUSTOMERS = rules.Registry()


@CUSTOMERS.rule("segment", bases=("decision", "deposited"))
def _segment(p):
    c = F.col("c_custkey")
    return ladder((c % 17 == 0, decide("REVIEWED", "decision", "ledger", "REVIEWED", True)), (c % 5 != 0, decide(F.col("c_mktsegment"), "deposited", "c_mktsegment", F.col("c_mktsegment"))), otherwise=decline("segment not deposited", "c_mktsegment"))


@CUSTOMERS.rule("band", parameters=("within_below", "outside_from"), bases=("measured",))
def _band(p):
    b = F.col("c_acctbal")
    return ladder((b < float(p["within_below"]), decide("within", "measured", "c_acctbal", b)), (b >= float(p["outside_from"]), decide("outside", "measured", "c_acctbal", b)), otherwise=decline("between the bounds", "c_acctbal", b))


@CUSTOMERS.rule("geography", bases=("deposited",), fields=("country", "locality"))
def _geography(p):
    g = text.geo(F.col("deposited"))
    none = F.trim("deposited") == ""
    return {"country": ladder((~none, decide(g["country"], "deposited", "deposited", F.col("deposited"))), otherwise=decline("no geography", "deposited")), "locality": ladder((~none, decide(g["locality"], "deposited", "deposited", F.col("deposited"))), otherwise=decline("no geography", "deposited"))}


CATALOG = [
    {"rule_id": "R-SEGMENT-1", "rule_version": "1.0.0", "field_name": "segment", "description": "The ledger's segment, else the deposited one.", "implementation": "segment", "parameters": {}, "status": "active"},
    {"rule_id": "R-BAND-1", "rule_version": "1.0.0", "field_name": "band", "description": "Within below 1000, outside from 5000, else declined.", "implementation": "band", "parameters": {"within_below": "1000", "outside_from": "5000"}, "status": "active"},
    {"rule_id": "R-GEOGRAPHY-1", "rule_version": "1.0.0", "field_name": "country", "description": "Country and locality of the deposited text.", "implementation": "geography", "parameters": {}, "status": "active"},
]

_VIEW = f"SELECT c_custkey, c_mktsegment, c_acctbal, {_GEO} AS deposited FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


def _views(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select("c_custkey", "c_mktsegment", "c_acctbal", F.expr(_GEO).alias("deposited"))


@query(f"""
WITH v AS ({_VIEW}), g AS (SELECT *, trim(regexp_replace(deposited, ' +', ' ', 'g')) AS t FROM v), r AS (SELECT *, trim(CASE WHEN instr(t, ':') > 0 THEN substr(t, instr(t, ':') + 1) ELSE '' END) AS rest FROM g)
SELECT c_custkey, 'segment' AS canonical_field, CASE WHEN c_custkey % 17 = 0 THEN 'REVIEWED' WHEN c_custkey % 5 <> 0 THEN c_mktsegment ELSE '' END AS final_value, 'R-SEGMENT-1' AS winning_rule_id, CASE WHEN c_custkey % 17 = 0 THEN 'decision' WHEN c_custkey % 5 <> 0 THEN 'deposited' ELSE '' END AS evidence_basis, CASE WHEN c_custkey % 17 <> 0 AND c_custkey % 5 = 0 THEN 'segment not deposited' ELSE '' END AS unresolved_reason, c_custkey % 17 = 0 AS manual_override FROM r
UNION ALL SELECT c_custkey, 'band', CASE WHEN c_acctbal < 1000 THEN 'within' WHEN c_acctbal >= 5000 THEN 'outside' ELSE '' END, 'R-BAND-1', CASE WHEN c_acctbal < 1000 OR c_acctbal >= 5000 THEN 'measured' ELSE '' END, CASE WHEN c_acctbal < 1000 OR c_acctbal >= 5000 THEN '' ELSE 'between the bounds' END, FALSE FROM r
UNION ALL SELECT c_custkey, 'country', trim(split_part(t, ':', 1)), 'R-GEOGRAPHY-1', CASE WHEN t = '' THEN '' ELSE 'deposited' END, CASE WHEN t = '' THEN 'no geography' ELSE '' END, FALSE FROM r
UNION ALL SELECT c_custkey, 'locality', CASE WHEN instr(rest, ',') > 0 THEN rest ELSE '' END, 'R-GEOGRAPHY-1', CASE WHEN t = '' THEN '' ELSE 'deposited' END, CASE WHEN t = '' THEN 'no geography' ELSE '' END, FALSE FROM r""")
def q_rule_projection(t):
    """Every rule over every view, as provenance rows."""
    projected = rules.project(_views(t), CUSTOMERS.bind(CATALOG), "c_custkey")
    return projected.drop("source_field", "source_value")


@query("""
WITH v AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT doc_id, CASE WHEN toxic = 1 THEN 'excluded_partition' WHEN quality = 0 THEN 'low_partition' WHEN lang = 'en' THEN 'named' WHEN n_chars >= 5000 THEN 'large' WHEN n_chars < 500 THEN 'small' ELSE '' END AS partition,
  CASE WHEN toxic = 1 THEN 'decision' WHEN quality = 0 THEN 'entailed' WHEN lang = 'en' THEN 'name' WHEN n_chars >= 5000 OR n_chars < 500 THEN 'measured' ELSE '' END AS basis, coalesce(toxic = 1, FALSE) AS manual_override,
  CASE WHEN coalesce(toxic, 0) <> 1 AND coalesce(quality, 1) <> 0 AND lang <> 'en' AND n_chars BETWEEN 500 AND 4999 THEN 'between the bounds' ELSE '' END AS unresolved_reason,
  CASE WHEN toxic = 1 THEN 'excluded' WHEN coalesce(quality, 1) <> 0 AND lang <> 'en' AND n_chars BETWEEN 500 AND 4999 THEN '' WHEN quality IS NULL THEN 'provisional' ELSE 'vouched' END AS curation_status FROM v""")
def q_partition_ladder(t):
    """Decision, entailment, name, measured band, or a decline; the status follows the partition."""
    v = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left")
    n, toxic = F.col("n_chars"), F.coalesce(F.col("toxic"), L(0)) == 1
    o = ladder(
        (toxic, decide("excluded_partition", "decision", override=True)),
        (F.coalesce(F.col("quality"), L(1)) == 0, decide("low_partition", "entailed")),
        (F.col("lang") == "en", decide("named", "name")),
        (n >= 5000, decide("large", "measured")),
        (n < 500, decide("small", "measured")),
        otherwise=decline("between the bounds"),
    )
    rows = v.select("doc_id", "quality", toxic.alias("toxic"), o.alias("o"))
    status = F.when(F.col("toxic"), "excluded").when(F.col("o.unresolved_reason") != "", "").when(F.col("quality").isNull(), "provisional").otherwise("vouched")
    return rows.select("doc_id", F.col("o.value").alias("partition"), F.col("o.evidence_basis").alias("basis"), "o.manual_override", "o.unresolved_reason", status.alias("curation_status"))


#: by the last digit of the key's remainder: below it, like the vaccine
CEILINGS = {0: "1.00", 1: "0.60", 2: "1.00"}
WILD_FROM = "15.00"

ansi("q_band_classify", """
SELECT s_suppkey, CASE WHEN pct < ceiling THEN 'like' WHEN pct >= 15.00 THEN 'wild' ELSE '' END AS class, CASE WHEN pct >= ceiling AND pct < 15.00 THEN 'between the bounds' ELSE '' END AS unresolved_reason FROM (
  SELECT s_suppkey, CAST(ABS(s_acctbal) / 400 AS DECIMAL(10, 2)) AS pct, CAST(CASE s_suppkey % 3 WHEN 1 THEN 0.60 ELSE 1.00 END AS DECIMAL(10, 2)) AS ceiling FROM @supplier) s""")


@query("""
SELECT event_id, CASE WHEN event_id % 29 = 0 THEN 'reviewed' WHEN event_type = 'purchase' THEN 'host' WHEN event_id % 5 = 0 THEN 'in_scope' WHEN event_type IN ('error', 'view') THEN 'text' ELSE '' END AS origin,
  CASE WHEN event_id % 29 = 0 THEN 'decision' WHEN event_type = 'purchase' THEN 'host' WHEN event_id % 5 = 0 THEN 'scope' WHEN event_type IN ('error', 'view') THEN 'specimen' ELSE '' END AS basis,
  CASE WHEN event_id % 29 = 0 THEN 'reviewed' WHEN event_type IN ('error', 'view') THEN 'environmental' WHEN event_id % 5 = 0 THEN 'in_scope' ELSE '' END AS stream FROM events""")
def q_origin_ladder(t):
    """Two rules over the same record that read scope and text in different order."""
    decided, host, scope, said = F.col("event_id") % 29 == 0, F.col("event_type").rlike("(?i)^purchase$"), F.col("event_id") % 5 == 0, F.col("event_type").rlike("(?i)^(error|view)$")
    origin = ladder((decided, decide("reviewed", "decision", override=True)), (host, decide("host", "host")), (scope, decide("in_scope", "scope")), (said, decide("text", "specimen")), otherwise=decline("nothing tells"))
    stream = ladder((decided, decide("reviewed", "decision", override=True)), (said, decide("environmental", "text")), (scope, decide("in_scope", "scope")), otherwise=decline("nothing tells"))
    return t.events.select("event_id", origin.alias("o"), stream.alias("s")).select("event_id", F.col("o.value").alias("origin"), F.col("o.evidence_basis").alias("basis"), F.col("s.value").alias("stream"))


@query("""
WITH l AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'superseded' WHEN 1 THEN 'retired' ELSE 'active' END AS status, doc_id % 11 = 0 AS excl, doc_id % 13 <> 0 AS has_column, CASE WHEN doc_id % 4 = 0 THEN 'en' ELSE 'reviewed' END AS decided FROM labels),
j AS (SELECT l.*, d.doc_id IS NOT NULL AND doc_id2 IS NULL AS present, CASE WHEN d.n_chars < 800 THEN '' ELSE d.lang END AS without FROM l LEFT JOIN documents d ON d.doc_id = l.doc_id AND d.source <> 'src0' LEFT JOIN (SELECT doc_id AS doc_id2 FROM labels WHERE doc_id % 11 = 0 AND doc_id % 22 <> 0) x ON x.doc_id2 = l.doc_id)
SELECT doc_id, CASE WHEN status <> 'active' THEN 'not_active' WHEN excl AND present THEN 'exclusion_not_effective' WHEN excl THEN 'exclusion_verified' WHEN NOT present THEN 'subject_not_in_corpus' WHEN NOT has_column THEN 'no_canonical_column'
  WHEN doc_id % 17 = 0 THEN 'overridden_by_rule' WHEN without = decided THEN 'applied_unchanged' WHEN without = '' THEN 'applied_filled_unresolved' ELSE 'applied_changed' END AS status FROM j""")
def q_decision_outcomes(t):
    """What each decision of the ledger did, from the rule's value with and without decisions."""
    k = F.col("doc_id")
    ledger = t.labels.select("doc_id", (~(k % 7).isin(0, 1)).alias("active"), (k % 11 == 0).alias("excludes"), (k % 13 != 0).alias("has_column"), F.when(k % 4 == 0, "en").otherwise("reviewed").alias("decided"))
    gone = ledger.filter("doc_id % 11 = 0 and doc_id % 22 <> 0").select("doc_id")
    corpus = t.documents.filter("source <> 'src0'").join(gone, "doc_id", "left_anti")
    # withheld: the rule alone; given: the decision rules, but for records whose rule comes before the ledger
    rule = F.when(F.col("n_chars") < 800, "").otherwise(F.col("lang"))
    cells = corpus.select("doc_id", rule.alias("without"), L(True).alias("present"))
    rows = ledger.join(cells, "doc_id", "left")
    with_ = F.when(k % 17 == 0, F.concat(F.col("decided"), L("*"))).otherwise(F.col("decided"))
    status = rules.decision_status(F.coalesce("present", L(False)), F.col("without"), with_, F.col("decided"), F.col("excludes"), F.col("has_column"), F.col("active"))
    return rows.select("doc_id", status.alias("status"))


@query("""
SELECT d.doc_id, CASE WHEN d.lang IN ('en', 'de') THEN CAST(l.quality AS VARCHAR) ELSE CAST(l.toxic AS VARCHAR) END AS governing, CASE WHEN CASE WHEN d.lang IN ('en', 'de') THEN l.quality ELSE l.toxic END = 1 THEN 'backbone' ELSE 'addon' END AS tier FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def q_tier_choice(t):
    """Backbone exactly if the column that governs its group says so; blank is addon."""
    rows = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    governing = F.when(F.col("lang").isin("en", "de"), F.col("quality")).otherwise(F.col("toxic"))
    return rows.select("doc_id", governing.cast("string").alias("governing"), F.when(governing == 1, "backbone").otherwise("addon").alias("tier"))


@query("""
WITH l AS (SELECT doc_id, concat('D-', lpad(CAST(CASE WHEN doc_id % 50 = 3 THEN doc_id - 1 ELSE doc_id END AS VARCHAR), 12, '0')) AS id, CASE WHEN doc_id % 40 = 7 THEN 'pending' ELSE 'active' END AS status FROM labels)
SELECT 'duplicate_id' AS "check", id AS "key", count(*)::BIGINT AS n FROM l GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'bad_status', id, 1::BIGINT FROM l WHERE status NOT IN ('active', 'superseded', 'retired')
UNION ALL SELECT 'bad_pattern', id, 1::BIGINT FROM l WHERE NOT regexp_matches(id, '^D-[0-9a-f]{12,64}$')""")
def q_constraint_violations(t):
    k = F.col("doc_id")
    ledger = t.labels.select(F.concat(L("D-"), F.lpad(F.when(k % 50 == 3, k - 1).otherwise(k).cast("string"), 12, "0")).alias("key"), F.when(k % 40 == 7, "pending").otherwise("active").alias("status"))
    one = L(1).cast("long").alias("n")
    repeated = ledger.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(L("duplicate_id").alias("check"), "key", "n")
    status = ledger.filter(~F.col("status").isin("active", "superseded", "retired")).select(L("bad_status").alias("check"), "key", one)
    pattern = ledger.filter(~F.col("key").rlike("^D-[0-9a-f]{12,64}$")).select(L("bad_pattern").alias("check"), "key", one)
    return repeated.union(status).union(pattern)


_PLANTED = "CASE WHEN c_custkey % 31 = 0 THEN 'deposited_locality' ELSE basis END"


@query(f"""
WITH v AS ({_VIEW}), g AS (SELECT *, trim(regexp_replace(deposited, ' +', ' ', 'g')) AS t FROM v), r AS (SELECT *, trim(CASE WHEN instr(t, ':') > 0 THEN substr(t, instr(t, ':') + 1) ELSE '' END) AS rest FROM g),
b AS (SELECT c_custkey, t, rest, CASE WHEN instr(rest, ',') > 0 THEN rest ELSE '' END AS locality, CASE WHEN c_custkey % 31 = 0 THEN 'deposited_locality' WHEN t = '' THEN 'no_geography_deposited' WHEN rest = '' THEN 'no_admin1_deposited' WHEN instr(rest, ',') > 0 THEN 'deposited_locality' ELSE 'admin1_only' END AS basis FROM r)
SELECT c_custkey, basis, CASE WHEN basis = 'deposited_locality' AND locality = '' THEN 'locality_missing' WHEN basis = 'no_geography_deposited' AND t <> '' THEN 'geography_present' END AS violation FROM b
WHERE basis = 'deposited_locality' AND locality = '' OR basis = 'no_geography_deposited' AND t <> ''""")
def q_invariant_geo(t):
    """Each basis implies what must be present; some rows are planted to break it."""
    rows = _views(t).select("c_custkey", text.collapse(F.col("deposited")).alias("t"), text.geo(F.col("deposited")).alias("g"))
    rows = rows.select("c_custkey", "t", "g.locality", "g.country", F.when(F.col("c_custkey") % 31 == 0, "deposited_locality").otherwise(F.col("g.basis")).alias("basis"))
    broken = (
        F.when((F.col("basis") == "deposited_locality") & (F.col("locality") == ""), "locality_missing")
        .when((F.col("basis") == "no_geography_deposited") & (F.col("t") != ""), "geography_present")
        .when((F.col("basis") == "no_admin1_deposited") & (F.col("country") == ""), "country_missing")
        .when((F.col("basis") == "admin1_only") & (F.col("locality") != ""), "locality_present")
    )
    return rows.select("c_custkey", "basis", broken.alias("violation")).filter("violation is not null")


@query(f"""
SELECT o_orderkey, iso, precision FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE iso END AS iso, CASE WHEN o_orderkey % 41 = 0 THEN 'NA' ELSE precision END AS precision FROM ({_DATE_SQL})) WHERE (iso = '') <> (precision = 'NA')""")
def q_invariant_date(t):
    """A date is blank exactly if its precision does not apply; some rows are planted to break it."""
    k = F.col("o_orderkey")
    planted = _dated(t).select("o_orderkey", F.when(k % 37 == 0, "").otherwise(F.col("iso")).alias("iso"), F.when(k % 41 == 0, dates.NOT_APPLICABLE).otherwise(F.col("precision")).alias("precision"))
    return planted.filter((F.col("iso") == "") != (F.col("precision") == dates.NOT_APPLICABLE))


ansi("q_coverage_consistency", """
SELECT doc_id, declared, readable, CASE WHEN declared = 1 AND readable = 0 THEN 'declared present, block empty' WHEN declared = 0 AND readable > 0 THEN 'declared absent, block filled' END AS violation FROM (
  SELECT doc_id, CASE WHEN doc_id % 43 = 0 THEN 0 ELSE CASE WHEN n_chars > 200 THEN 1 ELSE 0 END END AS declared, CASE WHEN n_chars > 200 AND doc_id % 47 <> 0 THEN CAST(LENGTH(SUBSTR(text, 201, 100)) AS BIGINT) ELSE CAST(0 AS BIGINT) END AS readable FROM @documents) s
WHERE declared = 1 AND readable = 0 OR declared = 0 AND readable > 0""")
