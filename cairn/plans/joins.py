"""Queries of scans, predicates, joins and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import relational as rel
from ..operators import sequence as seq
from .registry import ansi, query

L = F.lit


@query(r"""
SELECT conv_id, turn, i::BIGINT AS line_ordinal, line FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM conversations)""")
def q_normalize_explode(t):
    lines = t.conversations.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return lines.select("conv_id", "turn", (F.col("i") + 1).cast("long").alias("line_ordinal"), "line")


@query("""
SELECT conv_id, turn, role, dense_rank() OVER (PARTITION BY conv_id ORDER BY first_turn)::BIGINT AS name_ordinal, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn)::BIGINT AS value_ordinal
FROM (SELECT *, min(turn) OVER (PARTITION BY conv_id, role) AS first_turn FROM conversations)""")
def q_nested_ordinals(t):
    by_role = Window.partitionBy("conv_id", "role")
    rows = t.conversations.withColumn("first_turn", F.min("turn").over(by_role))
    names = F.dense_rank().over(Window.partitionBy("conv_id").orderBy("first_turn")).cast("long")
    values = F.row_number().over(by_role.orderBy("turn")).cast("long")
    return rows.select("conv_id", "turn", "role", names.alias("name_ordinal"), values.alias("value_ordinal"))


@query("SELECT user_id, arg_min(value, (ts, event_id)) AS value, arg_min(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def q_first_wins(t):
    return rel.first_wins(t.events, ["user_id"], ["ts", "event_id"], ["value", "event_type"])


@query("""
SELECT p_brand, arg_min(w, (p_partkey, i)) AS first_token FROM (SELECT p_brand, p_partkey, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part) WHERE w LIKE 'b%' GROUP BY 1""")
def q_prefix_first(t):
    words = t.part.select("p_brand", "p_partkey", F.posexplode(F.split("p_name", " ")).alias("i", "first_token")).filter(F.col("first_token").startswith("b"))
    return rel.first_wins(words, ["p_brand"], ["p_partkey", "i"], ["first_token"])


_STATUS = "CASE doc_id % 7 WHEN 0 THEN 'superseded' WHEN 1 THEN 'retired' ELSE 'active' END"
_KIND = "CASE doc_id % 3 WHEN 0 THEN 'membership_exclusion' WHEN 1 THEN 'carve_exclusion' ELSE 'correction' END"
ansi("q_ledger_active", f"SELECT doc_id, {_KIND} AS decision_type, {_KIND} IN ('membership_exclusion', 'carve_exclusion') AS excludes FROM @labels WHERE {_STATUS} = 'active'")
ansi("q_typed_relational", """
SELECT TRY_CAST(NULLIF(k, '') AS BIGINT) AS orderkey, NULLIF(p, '') AS priority, TRY_CAST(NULLIF(v, '') AS DOUBLE) AS price, TRY_CAST(NULLIF(p, '') AS BIGINT) IS NULL AS unreadable FROM (
  SELECT CAST(o_orderkey AS VARCHAR(20)) AS k, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS p, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_totalprice AS VARCHAR(30)) END AS v FROM @orders) s""")


@query("""
WITH excluded AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0), rescued AS (SELECT c_custkey FROM customer WHERE c_acctbal > 9000),
named AS (SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1)
SELECT c_custkey, c_custkey IN (SELECT c_custkey FROM named) AS by_lineage, c_custkey IN (SELECT c_custkey FROM rescued) AS by_rescue,
  (SELECT count(*) FROM excluded)::BIGINT AS n_excluded FROM customer
WHERE c_custkey NOT IN (SELECT c_custkey FROM excluded) AND (c_custkey IN (SELECT c_custkey FROM named) OR c_custkey IN (SELECT c_custkey FROM rescued))""")
def q_carve(t):
    """Exclusion first; then lineage or rescue."""
    excluded = t.customer.filter("c_acctbal < 0").select("c_custkey")
    rescued = t.customer.filter("c_acctbal > 9000").select("c_custkey", L(True).alias("by_rescue"))
    named = t.nation.filter("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"), L(True).alias("by_lineage"))
    left = t.customer.join(excluded, "c_custkey", "left_anti").join(named, "c_nationkey", "left").join(rescued, "c_custkey", "left")
    flags = [F.coalesce(c, L(False)).alias(c) for c in ("by_lineage", "by_rescue")]
    n = excluded.agg(F.count("*")).scalar()
    return left.select("c_custkey", *flags, n.alias("n_excluded")).filter("by_lineage or by_rescue")


@query("SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1")
def q_lineage_set(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("flags"))


@query("""
SELECT d.doc_id, coalesce(l.toxic, 0) = 1 AS own_flag, coalesce(max(l.toxic) OVER (PARTITION BY sha256(d.text)), 0) = 1 AS promoted FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def q_twin_promotion(t):
    """One row's flag holds for every row of the same content; flags combine before the join."""
    d = t.documents.select("doc_id", F.sha2("text", 256).alias("sha")).join(t.labels.select("doc_id", "toxic"), "doc_id", "left")
    flagged = d.filter("toxic = 1").select("sha").distinct().withColumn("promoted", L(True))
    return d.join(flagged, "sha", "left").select("doc_id", F.coalesce(F.col("toxic") == 1, L(False)).alias("own_flag"), F.coalesce("promoted", L(False)).alias("promoted"))


ansi("q_length_window", """
SELECT fate, COUNT(*) AS n, MIN(n_chars) AS shortest, MAX(n_chars) AS longest FROM (
  SELECT n_chars, CASE WHEN n_chars = 0 THEN 'empty' WHEN n_chars < 200 THEN 'below_minimum' WHEN n_chars > 8000 THEN 'oversized' ELSE 'included' END AS fate FROM @documents) s GROUP BY fate""")


@query("""
WITH c AS (SELECT lang, i, letter, count(*) AS n FROM (SELECT lang, unnest(string_split(text, '')) AS letter, generate_subscripts(string_split(text, ''), 1) AS i FROM documents) WHERE letter <> '' GROUP BY 1, 2, 3),
r AS (SELECT lang, i, arg_max(letter, n * 2000000 - ord(letter)) AS letter FROM c GROUP BY 1, 2)
SELECT a, b, shared, matches, CASE WHEN shared >= 40 THEN round(1 - matches / shared, 6) END AS distance FROM (
  SELECT p.lang AS a, q.lang AS b, count(*) FILTER (regexp_matches(p.letter, '^[a-z]$') AND regexp_matches(q.letter, '^[a-z]$'))::BIGINT AS shared, count(*) FILTER (regexp_matches(p.letter, '^[a-z]$') AND p.letter = q.letter)::BIGINT AS matches
  FROM r p JOIN r q ON p.i = q.i AND p.lang < q.lang GROUP BY 1, 2)""")
def q_masked_distance(t):
    """Distances of the groups' consensus rows; columns that either row cannot read do not count."""
    rows = seq.consensus(seq.letter_counts(t.documents, "lang", "doc_id", "text"), "lang", first_seen=False)
    a = rows.select(F.col("lang").alias("a"), "position", F.col("letter").alias("p"))
    b = rows.select(F.col("lang").alias("b"), "position", F.col("letter").alias("q"))
    pairs = a.join(b, "position").filter("a < b")
    readable = F.col("p").rlike("^[a-z]$") & F.col("q").rlike("^[a-z]$")
    out = pairs.groupBy("a", "b").agg(F.count_if(readable).alias("shared"), F.count_if(readable & (F.col("p") == F.col("q"))).alias("matches"))
    return out.withColumn("distance", F.when(F.col("shared") >= 40, F.round(1 - F.col("matches") / F.col("shared"), 6)))


@query("""
SELECT c_custkey, c_mktsegment, CAST(ROW_NUMBER() OVER (ORDER BY c_mktsegment, c_custkey) AS BIGINT) AS position
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def q_population_select(t):
    """Selected rows with their place in one order of all, numbered slice by slice."""
    rows = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")
    return rel.numbered(rows, [], ["c_mktsegment", "c_custkey"], "position")


@query("""
SELECT c_mktsegment, count(o_orderkey)::BIGINT AS n_orders, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0))::BIGINT AS n_orphans
FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_acctbal >= 0 GROUP BY 1""")
def q_orphans(t):
    """Rows without a canonical row are counted and dropped."""
    canonical = t.customer.filter("c_acctbal >= 0")
    orphans = t.orders.join(canonical.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti").agg(F.count("*")).scalar()
    kept = canonical.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
    return kept.groupBy("c_mktsegment").agg(F.count("o_orderkey").alias("n_orders")).withColumn("n_orphans", orphans)


ansi("q_view_filter", "SELECT event_id, event_type, value FROM @events WHERE event_type IN ('click', 'purchase') AND value BETWEEN 5 AND 50 AND value >= 0 AND event_id > 100 AND event_id <= 9000")


@query("""
SELECT page_id, split_part(kv, '=', 1) AS key, split_part(kv, '=', 2) AS value, split_part(kv, '=', 1) IN ('page', 'id', 'q') AS known FROM (
  SELECT page_id, unnest(string_split(split_part(split_part(url, '#', 1), '?', 2), '&')) AS kv FROM pages WHERE instr(url, '?') > 0)""")
def q_view_params(t):
    query_text = F.split_part(F.split_part("url", L("#"), L(1)), L("?"), L(2))
    pairs = t.pages.filter(F.instr("url", "?") > 0).select("page_id", F.explode(F.split(query_text, "&")).alias("kv"))
    part = lambda i: F.split_part("kv", L("="), L(i))
    return pairs.select("page_id", part(1).alias("key"), part(2).alias("value"), part(1).isin("page", "id", "q").alias("known"))


ansi("q_hash_join", """
SELECT p_brand, ROUND(SUM(l_extendedprice * (1 - l_discount)), 2) AS revenue, COUNT(*) AS n FROM @lineitem JOIN @part ON l_partkey = p_partkey GROUP BY p_brand""")


@query("""
SELECT o_orderkey, n_name, o_totalprice >= 0 AS price_ok, c_custkey IS NOT NULL AS has_customer, extract(year FROM o_orderdate)::BIGINT AS year
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def q_enrich_verify(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select("o_orderkey", "n_name", (F.col("o_totalprice") >= 0).alias("price_ok"), F.col("c_custkey").isNotNull().alias("has_customer"), F.year("o_orderdate").cast("long").alias("year"))


@query("""
WITH o AS (SELECT o_custkey, count(*)::BIGINT AS n_orders, max(o_totalprice) AS top FROM orders GROUP BY 1), s AS (SELECT s_nationkey, count(*)::BIGINT AS n_suppliers FROM supplier GROUP BY 1)
SELECT c_custkey, n_name, r_name, coalesce(n_orders, 0) AS n_orders, top AS top_price, coalesce(n_suppliers, 0) AS n_suppliers
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN o ON o_custkey = c_custkey LEFT JOIN s ON s_nationkey = c_nationkey""")
def q_record_view(t):
    """A star of six inputs around each record, folded into a map and read back."""
    o = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.max("o_totalprice").alias("top_price"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.count("*").alias("n_suppliers"))
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.create_map(L("nation"), "n_name", L("region"), "r_name").alias("names"))
    view = t.customer.join(nation, "c_nationkey", "left").join(o, "c_custkey", "left").join(s, "c_nationkey", "left")
    zero = lambda c: F.coalesce(c, L(0)).alias(c)
    return view.select("c_custkey", F.col("names")["nation"].alias("n_name"), F.col("names")["region"].alias("r_name"), zero("n_orders"), "top_price", zero("n_suppliers"))


ansi("q_span_agg", """
SELECT l_orderkey, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship, CASE WHEN COUNT(DISTINCT l_returnflag) = 1 THEN MIN(l_returnflag) ELSE '' END AS only_flag FROM @lineitem GROUP BY l_orderkey""")
ansi("q_semi_join", """
SELECT o_orderkey, o_orderpriority FROM @orders o WHERE EXISTS (SELECT 1 FROM @lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""")


@query("""
SELECT l_orderkey, gap_start, gap_end FROM (SELECT l_orderkey, l_shipdate AS gap_start, lead(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber) AS gap_end FROM lineitem) WHERE gap_end > gap_start""")
def q_interval_tiling(t):
    return rel.gaps_between(t.lineitem, "l_orderkey", "l_shipdate", "l_linenumber")


@query("""
WITH k AS (SELECT sha256(text) AS sha, min(doc_id) AS twin FROM documents WHERE source = 'src0' GROUP BY 1)
SELECT d.doc_id, k.twin FROM documents d JOIN k ON sha256(d.text) = k.sha WHERE d.source <> 'src0'""")
def q_byte_twin_rescue(t):
    d = t.documents.select("doc_id", "source", F.sha2("text", 256).alias("sha"))
    kept = d.filter("source = 'src0'").groupBy("sha").agg(F.min("doc_id").alias("twin"))
    return d.filter("source <> 'src0'").join(kept, "sha").select("doc_id", "twin")


@query("""
WITH k AS (SELECT sha256(text) AS sha, min(doc_id) AS twin FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY 1)
SELECT d.doc_id, d.lang, CASE WHEN twin IS NOT NULL THEN 'byte_identical' WHEN n_chars >= 5000 THEN 'measured' END AS membership_basis, coalesce(twin, -1) AS byte_identical_twin
FROM documents d LEFT JOIN k ON sha256(d.text) = k.sha WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND (twin IS NOT NULL OR n_chars >= 5000)""")
def q_rescue_report(t):
    d = t.documents.select("doc_id", "lang", "n_chars", F.sha2("text", 256).alias("sha"))
    known = t.labels.select("doc_id")
    twins = d.join(known, "doc_id", "left_semi").groupBy("sha").agg(F.min("doc_id").alias("twin"))
    rows = d.join(known, "doc_id", "left_anti").join(twins, "sha", "left")
    basis = F.when(F.col("twin").isNotNull(), "byte_identical").when(F.col("n_chars") >= 5000, "measured")
    return rows.select("doc_id", "lang", basis.alias("membership_basis"), F.coalesce("twin", L(-1)).alias("byte_identical_twin")).filter("membership_basis is not null").orderBy("doc_id")


ansi("q_two_sided_band", """
SELECT s_suppkey, CASE WHEN s_acctbal < 1000 THEN 'within' WHEN s_acctbal >= 5000 THEN 'outside' ELSE '' END AS band, CASE WHEN s_acctbal >= 1000 AND s_acctbal < 5000 THEN 'between the bounds' ELSE '' END AS unresolved_reason FROM @supplier""")


@query("""
WITH e AS (SELECT *, event_id % 4 = 0 AS blank FROM events), g AS (
  SELECT user_id, event_type, count(DISTINCT floor(value / 20)) AS n, min(floor(value / 20)) AS v FROM e WHERE NOT blank GROUP BY 1, 2)
SELECT e.event_id, CAST(CASE WHEN NOT blank THEN floor(e.value / 20) WHEN n = 1 THEN v END AS BIGINT) AS label, CASE WHEN NOT blank THEN 'own' WHEN n = 1 THEN 'linked' WHEN n > 1 THEN 'siblings_disagree' ELSE 'no_siblings' END AS basis
FROM e LEFT JOIN g ON e.user_id = g.user_id AND e.event_type = g.event_type""")
def q_linked_inference(t):
    """A blank label is filled only if all firm rows of its group agree; only own labels are firm."""
    e = t.events.withColumn("blank", F.col("event_id") % 4 == 0).withColumn("v", F.floor(F.col("value") / 20))
    firm = e.filter("not blank").groupBy("user_id", "event_type").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    rows = e.join(firm, ["user_id", "event_type"], "left")
    agree = F.col("lo") == F.col("hi")
    label = F.when(~F.col("blank"), F.col("v")).when(agree, F.col("lo"))
    basis = F.when(~F.col("blank"), "own").when(agree, "linked").when(F.col("lo").isNotNull(), "siblings_disagree").otherwise("no_siblings")
    return rows.select("event_id", label.alias("label"), basis.alias("basis"))


@query("SELECT a.o_custkey, a.o_orderkey AS lo, a.o_orderkey AS lo_id, b.o_orderkey AS hi, b.o_orderkey AS hi_id FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderkey > a.o_orderkey AND b.o_orderkey - a.o_orderkey <= 200")
def q_range_join(t):
    return rel.range_join(t.orders, "o_custkey", "o_orderkey", "o_orderkey", 200)


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer""")
def q_pivot_canonical(t):
    """Long assertions to one wide row each; a declined cell contributes nothing."""
    cells = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("segment"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("name"), F.col("c_nationkey").cast("string").alias("nation"))
    long = cells.unpivot("c_custkey", ["segment", "name", "nation"], "field", "value").filter("value is not null")
    return long.groupBy("c_custkey").pivot("field", ["segment", "name", "nation"]).agg(F.first("value"))


@query("""
SELECT o_orderkey, field, value FROM (
  SELECT o_orderkey, 'status' AS field, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE o_orderstatus END AS value FROM orders
  UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders UNION ALL SELECT o_orderkey, 'flagged', 'TRUE' FROM orders WHERE o_orderkey % 9 = 0) WHERE value <> ''""")
def q_unpivot_emit(t):
    """One assertion per non-empty field; a constant only where its condition holds."""
    status = F.when(F.col("o_orderkey") % 6 == 0, "").otherwise(F.col("o_orderstatus"))
    rows = t.orders.select("o_orderkey", status.alias("status"), F.col("o_orderpriority").alias("priority"), F.when(F.col("o_orderkey") % 9 == 0, "TRUE").alias("flagged"))
    return rows.unpivot("o_orderkey", ["status", "priority", "flagged"], "field", "value").filter("value <> ''")


ansi("q_semi_flag", """
SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM @orders WHERE o_totalprice > 400000) AS has_large_order FROM @customer""")
ansi("q_lineage_child", """
SELECT conv_id, turn, next_role FROM (SELECT conv_id, turn, role, LEAD(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role, MIN(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id) AS first_user FROM @conversations) s WHERE turn = first_user""")


@query("""
WITH r AS (SELECT p_brand, min(p_partkey) AS slot FROM part WHERE p_size >= 48 GROUP BY 1) SELECT p.p_partkey, coalesce(slot, -1) AS slot FROM part p LEFT JOIN r ON p.p_brand = r.p_brand""")
def q_reference_slot(t):
    slots = t.part.filter("p_size >= 48").groupBy("p_brand").agg(F.min("p_partkey").alias("slot"))
    return t.part.join(slots, "p_brand", "left").select("p_partkey", F.coalesce("slot", L(-1)).alias("slot"))


@query("""
SELECT (SELECT count(*) FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus <> 'P') WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))::BIGINT AS only_left,
  (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'))::BIGINT AS only_right,
  (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'))::BIGINT AS shared""")
def q_set_accounting(t):
    return rel.set_difference_counts(t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k")), t.lineitem.select(F.col("l_orderkey").alias("k")), "k")


@query("""
WITH a AS (SELECT c_custkey FROM customer WHERE c_nationkey < 15), b AS (SELECT c_custkey FROM customer WHERE c_nationkey >= 10)
SELECT 'union' AS op, count(*)::BIGINT AS n FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'intersect', count(*)::BIGINT FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
UNION ALL SELECT 'left_only', count(*)::BIGINT FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'missing', count(*)::BIGINT FROM (SELECT c_custkey FROM customer EXCEPT (SELECT * FROM a UNION SELECT * FROM b))""")
def q_setop_partition(t):
    a, b = t.customer.filter("c_nationkey < 15").select("c_custkey"), t.customer.filter("c_nationkey >= 10").select("c_custkey")
    count = lambda op, df: df.agg(F.count("*").alias("n")).select(L(op).alias("op"), "n")
    parts = [count("union", a.union(b).distinct()), count("intersect", a.intersect(b)), count("left_only", a.exceptAll(b)), count("missing", t.customer.select("c_custkey").exceptAll(a.union(b).distinct()))]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("""
WITH s AS (SELECT doc_id, lang, source FROM documents WHERE source <> 'src3'), n AS (SELECT doc_id, CASE WHEN doc_id % 23 = 0 THEN '' ELSE lang END AS lang, source FROM documents WHERE source NOT IN ('src1', 'src2'))
SELECT coalesce(s.doc_id, n.doc_id) AS doc_id, CASE WHEN s.doc_id IS NULL THEN 'added' ELSE 'dropped' END AS change, CASE WHEN s.doc_id IS NULL THEN 'new_record' WHEN n.doc_id IS NULL AND s.source = 'src1' THEN 'carved' WHEN n.doc_id IS NULL THEN 'absent_from_canonical' WHEN n.lang = '' THEN 'type_lost' ELSE 'relabelled' END AS reason
FROM s FULL JOIN n ON s.doc_id = n.doc_id WHERE s.doc_id IS NULL OR n.doc_id IS NULL OR s.lang <> n.lang""")
def q_delta_reasons(t):
    """Both sides of a rebuild in one full join; each difference has one reason of a closed list."""
    d = t.documents
    s = d.filter("source <> 'src3'").select(F.col("doc_id").alias("sid"), F.col("lang").alias("sl"), F.col("source").alias("ss"))
    n = d.filter("source not in ('src1', 'src2')").select(F.col("doc_id").alias("nid"), F.when(F.col("doc_id") % 23 == 0, "").otherwise(F.col("lang")).alias("nl"))
    both = s.join(n, F.col("sid") == F.col("nid"), "full").filter("sid is null or nid is null or sl <> nl")
    added, gone = F.col("sid").isNull(), F.col("nid").isNull()
    reason = F.when(added, "new_record").when(gone & (F.col("ss") == "src1"), "carved").when(gone, "absent_from_canonical").when(F.col("nl") == "", "type_lost").otherwise("relabelled")
    return both.select(F.coalesce("sid", "nid").alias("doc_id"), F.when(added, "added").otherwise("dropped").alias("change"), reason.alias("reason"))


@query("""
SELECT s_suppkey, arg_min(c_custkey, (round(abs(c_acctbal - s_acctbal), 2), -c_custkey)) AS nearest, round(min(abs(c_acctbal - s_acctbal)), 2) AS apart FROM supplier JOIN customer ON s_nationkey = c_nationkey GROUP BY 1""")
def q_argmin_composite(t):
    """The nearest by balance, ties to the larger key; suppliers meet the balances next to their own, not all customers of their nation."""
    c = t.customer.select(F.col("c_nationkey").alias("group"), F.col("c_acctbal").alias("x"), F.col("c_custkey").alias("key"))
    s = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("group"), F.col("s_acctbal").alias("x"))
    near = rel.nearest_rounded(s.select("group", "x"), c, "group", "x", "key", 2)
    rows = s.join(near, (s.group == near.group) & s.x.eqNullSafe(near.x)).groupBy("s_suppkey")
    best = F.min_by("key", F.struct(F.col("apart").isNull(), "apart", -F.col("key")))
    return rows.agg(best.alias("nearest"), F.min("apart").alias("apart"))


@query("""
SELECT doc_id, string_agg(concat(field, '=', value), ';' ORDER BY field) AS ledger FROM (
  SELECT doc_id, 'quality' AS field, CAST(quality AS VARCHAR) AS value FROM labels WHERE doc_id % 7 > 1 UNION ALL SELECT doc_id, 'toxic', CAST(toxic AS VARCHAR) FROM labels WHERE doc_id % 7 > 1 AND toxic = 1) GROUP BY 1""")
def q_ledger_map(t):
    """Active assertions of each subject as one map; blank ones are skipped."""
    active = t.labels.filter("doc_id % 7 > 1").select("doc_id", F.col("quality").cast("string").alias("quality"), F.when(F.col("toxic") == 1, "1").alias("toxic"))
    cells = active.unpivot("doc_id", ["quality", "toxic"], "field", "value").filter("value is not null")
    m = cells.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("m"))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], L("="), e["value"])), ";")
    return m.select("doc_id", text.alias("ledger"))
