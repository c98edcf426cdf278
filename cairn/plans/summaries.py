"""Queries of aggregations, windows, sorts and limits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import relational as rel
from .registry import ansi, query

L = F.lit

ansi("q_status_tally", "SELECT o_orderstatus, COUNT(*) AS n FROM @orders GROUP BY o_orderstatus")
ansi("q_ranked_counts", """
SELECT key, n, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, key) AS BIGINT) AS position FROM (
  SELECT CASE WHEN p_size % 10 = 0 THEN 'unknown' ELSE p_brand END AS key, COUNT(*) AS n FROM @part GROUP BY CASE WHEN p_size % 10 = 0 THEN 'unknown' ELSE p_brand END) s""")
ansi("q_declines", """
SELECT field, declined, expected, declined = expected AS as_declared FROM (
  SELECT 'lang' AS field, COUNT(CASE WHEN doc_id % 4 = 0 THEN 1 END) AS declined, COUNT(CASE WHEN doc_id % 4 = 0 THEN 1 END) AS expected FROM @documents
  UNION ALL SELECT 'source', COUNT(CASE WHEN n_chars < 300 THEN 1 END), CAST(0 AS BIGINT) FROM @documents) s""")
ansi("q_conditional_counts", """
SELECT COUNT(*) AS n, COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS returned, COUNT(CASE WHEN l_discount > 0.05 THEN 1 END) AS discounted, COUNT(CASE WHEN l_tax = 0 AND l_linestatus = 'O' THEN 1 END) AS untaxed_open, COUNT(DISTINCT l_suppkey) AS suppliers FROM @lineitem""")
ansi("q_having_floor", "SELECT p_brand, COUNT(*) AS n FROM @part WHERE p_size >= 30 GROUP BY p_brand HAVING COUNT(*) >= 5")
ansi("q_trait_catalog", """
SELECT trait, n_present, n_distinct FROM (SELECT 'lang' AS trait, COUNT(NULLIF(lang, '')) AS n_present, COUNT(DISTINCT lang) AS n_distinct FROM @documents
  UNION ALL SELECT 'source', COUNT(NULLIF(source, '')), COUNT(DISTINCT source) FROM @documents UNION ALL SELECT 'n_chars', COUNT(n_chars), COUNT(DISTINCT n_chars) FROM @documents) s""")
ansi("q_ratio_over_threshold", """
SELECT ROUND(SUM(CASE WHEN l_quantity > 30 THEN l_extendedprice ELSE 0 END) / SUM(l_extendedprice), 6) AS share, COUNT(CASE WHEN l_quantity > 30 THEN 1 END) AS exceeding FROM @lineitem""")
ansi("q_concordance", """
SELECT label, COUNT(*) AS n FROM (SELECT CASE WHEN o_orderkey IS NULL THEN 'unaligned' WHEN c_acctbal > 5000 AND o_totalprice > 200000 OR c_acctbal <= 5000 AND o_totalprice <= 200000 THEN 'concordant' ELSE 'discordant' END AS label
  FROM @customer LEFT JOIN @orders ON c_custkey = o_custkey) s GROUP BY label""")
ansi("q_numeric_extent", "SELECT MIN(b) AS low, MAX(b) AS high, COUNT(*) - COUNT(b) AS missing FROM (SELECT CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE s_acctbal END AS b FROM @supplier) s")


@query("""
SELECT o_orderpriority, price AS median FROM (SELECT o_orderpriority, o_totalprice AS price, ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) - 1 AS i, COUNT(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) s
WHERE i = (n - n % 2) / 2""")
def q_upper_median(t):
    """The middle value of each of a few groups, the upper one of two, by numbers within slices."""
    rows = rel.numbered(t.orders.select("o_orderpriority", "o_totalprice", "o_orderkey"), ["o_orderpriority"], ["o_totalprice", "o_orderkey"])
    middle = t.orders.groupBy("o_orderpriority").agg((F.floor(F.count("*") / 2) + 1).alias("place"))
    return rows.join(middle, ["o_orderpriority", "place"]).select("o_orderpriority", F.col("o_totalprice").alias("median"))


@query("""
SELECT o_orderkey, previous FROM (SELECT o_orderkey, o_custkey, LAG(o_custkey) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS previous FROM orders) s WHERE previous > o_custkey""")
def q_sort_order_check(t):
    """Rows that stand after a greater one, in the order of each of a few groups."""
    rows = rel.numbered(t.orders.select("o_orderstatus", "o_orderkey", "o_custkey"), ["o_orderstatus"], ["o_orderkey"])
    before = rows.select("o_orderstatus", (F.col("place") + 1).alias("place"), F.col("o_custkey").alias("previous"))
    return rows.join(before, ["o_orderstatus", "place"]).filter("previous > o_custkey").select("o_orderkey", "previous")


ansi("q_topk_stable", "SELECT doc_id, n_chars FROM @documents ORDER BY n_chars DESC, doc_id LIMIT 100")


@query("""
SELECT concat('Q-', substr(sha256(concat_ws('|', 'text', lang, source)), 1, 12)) AS queue_id, lang, source, count(*)::BIGINT AS n, array_to_string((array_agg(doc_id ORDER BY doc_id))[1:3], ',') AS examples
FROM documents WHERE n_chars < 1000 GROUP BY lang, source ORDER BY 1""")
def q_queue_groups(t):
    """Declined rows as work items with ids from their content; three examples are kept by rank, not by list."""
    declined = t.documents.filter("n_chars < 1000")
    count = declined.groupBy("lang", "source").agg(F.count("*").alias("n"))
    best = rel.top_n(declined.select("lang", "source", "doc_id"), ["lang", "source"], [F.col("doc_id")], 3)
    examples = best.groupBy("lang", "source").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), ",").alias("examples"))
    return count.join(examples, ["lang", "source"]).select(rel.content_id("Q-", L("text"), "lang", "source").alias("queue_id"), "lang", "source", "n", "examples").orderBy("queue_id")


@query("""
SELECT column_name, count(value) FILTER (value <> '')::BIGINT AS filled, count(*) FILTER (value = '')::BIGINT AS blank, count(*) FILTER (value IS NULL)::BIGINT AS declined FROM (
  SELECT 'segment' AS column_name, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS value FROM customer UNION ALL SELECT 'name', c_name FROM customer) GROUP BY 1""")
def q_column_coverage(t):
    segment = F.when(F.col("c_custkey") % 5 == 0, L(None)).when(F.col("c_custkey") % 7 == 0, "").otherwise(F.col("c_mktsegment"))
    cells = t.customer.select("c_custkey", segment.alias("segment"), F.col("c_name").alias("name")).unpivot("c_custkey", ["segment", "name"], "column_name", "value")
    return cells.groupBy("column_name").agg(F.count_if(F.col("value") != "").alias("filled"), F.count_if(F.col("value") == "").alias("blank"), F.count_if(F.col("value").isNull()).alias("declined"))


@query("""
SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand)::BIGINT AS code, (SELECT count(DISTINCT p_brand) / count(p_brand) <= 0.5 FROM part) AS encoded FROM part""")
def q_dictionary_encode(t):
    """Codes are ranked among the distinct values, a small table, and joined back."""
    values = t.part.select("p_brand").distinct().withColumn("code", F.row_number().over(Window.orderBy("p_brand")).cast("long"))
    worth = t.part.agg(F.count_distinct("p_brand") / F.count("p_brand") <= 0.5).scalar()
    return t.part.join(values, "p_brand").select("p_partkey", "code", worth.alias("encoded"))


@query("SELECT c_mktsegment, count(*)::BIGINT AS n, sha256(string_agg(CAST(c_custkey AS VARCHAR), chr(10) ORDER BY CAST(c_custkey AS VARCHAR))) AS digest FROM customer GROUP BY 1")
def q_population_digest(t):
    ids = F.array_sort(F.collect_list(F.col("c_custkey").cast("string")))
    return t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.sha2(F.array_join(ids, "\n"), 256).alias("digest"))


@query("SELECT c_nationkey, sha256(string_agg(concat(c_name, chr(10)), '' ORDER BY c_custkey)) AS digest FROM customer GROUP BY 1")
def q_ordered_digest(t):
    rows = F.array_sort(F.collect_list(F.struct("c_custkey", "c_name")))
    return t.customer.groupBy("c_nationkey").agg(F.sha2(F.array_join(F.transform(rows, lambda r: F.concat(r["c_name"], L("\n"))), ""), 256).alias("digest"))


@query("SELECT l_orderkey, arg_max(l_linenumber, (l_quantity, -l_linenumber, -l_partkey)) AS line, max(l_quantity) AS width FROM lineitem GROUP BY 1")
def q_argmax_tiebreak(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.max_by("l_linenumber", F.struct("l_quantity", -F.col("l_linenumber"), -F.col("l_partkey"))).alias("line"), F.max("l_quantity").alias("width"))


@query("""
WITH w AS (SELECT p_partkey, p_brand, concat(unnest(string_split(p_name, ' ')), p_size, p_type) AS token FROM part), n AS (SELECT token, count(*) AS n, min(p_brand) AS owner FROM w GROUP BY 1)
SELECT owner, count(*)::BIGINT AS rare FROM n WHERE n = 1 GROUP BY 1 ORDER BY rare DESC, owner LIMIT 10""")
def q_singleton_owners(t):
    """Tokens few rows use, and the ten owners with most of them."""
    words = t.part.select("p_brand", F.explode(F.split("p_name", " ")).alias("w"), F.concat("p_size", "p_type").alias("kind")).select("p_brand", F.concat("w", "kind").alias("token"))
    rare = words.groupBy("token").agg(F.count("*").alias("n"), F.min("p_brand").alias("owner")).filter("n = 1")
    return rare.groupBy("owner").agg(F.count("*").alias("rare")).orderBy(F.desc("rare"), "owner").limit(10)


_SHARES = {"low": 0.0, "p10": 0.1, "median": 0.5, "p90": 0.9, "high": 1.0}


@query("""
SELECT l_returnflag, """ + ", ".join(f"max(CASE WHEN i = least(n - 1, CAST(floor({f} * n) AS BIGINT)) THEN q END) AS {k}" for k, f in _SHARES.items()) + """
FROM (SELECT l_returnflag, l_quantity AS q, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) - 1 AS i, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem) GROUP BY 1""")
def q_nearest_rank(t):
    """Ranks come from cumulated counts of distinct values, so no group is sorted in one task."""
    counts = t.lineitem.groupBy("l_returnflag", "l_quantity").agg(F.count("*").alias("c"))
    w = Window.partitionBy("l_returnflag").orderBy("l_quantity")
    ranked = counts.withColumn("end", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy("l_returnflag")))
    index = lambda f: F.least(F.col("n") - 1, F.floor(L(f) * F.col("n")))
    at = lambda f: (F.col("end") > index(f)) & (F.col("end") - F.col("c") <= index(f))
    return ranked.groupBy("l_returnflag").agg(*[F.max(F.when(at(f), F.col("l_quantity"))).alias(k) for k, f in _SHARES.items()])


@query("SELECT event_type, quantile_cont(CASE WHEN event_id % 5 <> 0 THEN value END, 0.5) AS median FROM events GROUP BY 1")
def q_null_median(t):
    """The interpolated median, without nulls."""
    return t.events.groupBy("event_type").agg(F.percentile(F.when(F.col("event_id") % 5 != 0, F.col("value")), 0.5).alias("median"))


@query("""
SELECT finding, n FROM (
  SELECT 'short documents' AS finding, count(*)::BIGINT AS n FROM documents WHERE n_chars < 100 UNION ALL SELECT 'labels without document', count(*)::BIGINT FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
  UNION ALL SELECT 'negative balances', count(*)::BIGINT FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'orders without lines', count(*)::BIGINT FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
  UNION ALL SELECT 'pages without host', count(*)::BIGINT FROM pages WHERE instr(url, '//') = 0) WHERE n > 0""")
def q_data_quality(t):
    count = lambda finding, df: df.agg(F.count("*").alias("n")).select(L(finding).alias("finding"), "n")
    found = [
        count("short documents", t.documents.filter("n_chars < 100")),
        count("labels without document", t.labels.join(t.documents.select("doc_id"), "doc_id", "left_anti")),
        count("negative balances", t.customer.filter("c_acctbal < 0")),
        count("orders without lines", t.orders.join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")),
        count("pages without host", t.pages.filter(F.instr("url", "//") == 0)),
    ]
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out.filter("n > 0")


@query("""
WITH c AS (SELECT CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_brand END AS brand, count(*) AS n FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, brand) AS i FROM c WHERE brand IS NOT NULL)
SELECT category, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN i <= 7 THEN brand ELSE 'Other' END AS category, n FROM r UNION ALL SELECT 'missing', n FROM c WHERE brand IS NULL) GROUP BY 1""")
def q_topk_other(t):
    """The seven most frequent values; the others, and what is missing, together."""
    counts = t.part.groupBy(F.when(F.col("p_partkey") % 9 != 0, F.col("p_brand")).alias("brand")).agg(F.count("*").alias("n"))
    top = counts.filter("brand is not null").orderBy(F.desc("n"), "brand").limit(7).select(F.col("brand").alias("b"))
    category = F.when(F.col("brand").isNull(), "missing").when(F.col("b").isNotNull(), F.col("brand")).otherwise("Other")
    return counts.join(top, F.col("brand") == F.col("b"), "left").groupBy(category.alias("category")).agg(F.sum("n").alias("n"))


@query("SELECT p_brand, p_partkey, p_retailprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey)::BIGINT AS rank FROM part) WHERE rank <= 2")
def q_topn_per_group(t):
    return rel.top_n(t.part, ["p_brand"], [F.desc("p_retailprice"), F.col("p_partkey")], 2).select("p_brand", "p_partkey", "p_retailprice", "rank")


@query("""
WITH s AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS st FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS run FROM s)
SELECT user_id, run, event_type, count(*)::BIGINT AS length, count(*) % 3 <> 0 AS shifts_frame FROM r GROUP BY 1, 2, 3""")
def q_gaps_islands(t):
    return rel.islands(t.events, ["user_id"], ["ts", "event_id"], "event_type").withColumn("shifts_frame", F.col("length") % 3 != 0)


@query("""
SELECT e.event_id, e.user_id FROM events e JOIN (SELECT user_id, min((ts, event_id)) AS lo, max((ts, event_id)) AS hi FROM events WHERE event_type = 'purchase' GROUP BY 1) p ON e.user_id = p.user_id AND (e.ts, e.event_id) BETWEEN lo AND hi""")
def q_covered_span(t):
    """Rows between the first and the last of a kind."""
    at = F.struct("ts", "event_id")
    ends = t.events.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    return t.events.join(ends, "user_id").filter(at.between(F.col("lo"), F.col("hi"))).select("event_id", "user_id")


@query("""
WITH r AS (SELECT l_returnflag, l_discount, (row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey) - 1) // 150 AS chunk FROM lineitem),
o AS (SELECT l_returnflag, avg(CASE WHEN l_discount > 0.05 THEN 100.0 ELSE 0 END) AS overall FROM r GROUP BY 1), c AS (SELECT l_returnflag, chunk, count(*) AS n, avg(CASE WHEN l_discount > 0.05 THEN 100.0 ELSE 0 END) AS rate FROM r GROUP BY 1, 2)
SELECT c.l_returnflag, count(*)::BIGINT AS chunks, count(*) >= 2 AND bool_and(abs(rate - overall) <= 15) AS homogeneous, count(*) FILTER (abs(rate - overall) > 15)::BIGINT AS deviating FROM c JOIN o ON c.l_returnflag = o.l_returnflag WHERE n >= 30 GROUP BY 1""")
def q_chunk_homogeneity(t):
    """Each chunk of 150 rows against the overall rate; one chunk alone proves nothing."""
    placed = rel.numbered(t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_discount"), ["l_returnflag"], ["l_orderkey", "l_linenumber", "l_partkey"])
    rows = placed.select("l_returnflag", F.floor((F.col("place") - 1) / 150).alias("chunk"), F.when(F.col("l_discount") > 0.05, 1).otherwise(0).alias("hit"))
    chunks = rows.groupBy("l_returnflag", "chunk").agg(F.count("*").alias("n"), F.sum("hit").alias("hits"))
    overall = chunks.groupBy("l_returnflag").agg((100 * F.sum("hits") / F.sum("n")).alias("overall"))
    off = F.abs(100 * F.col("hits") / F.col("n") - F.col("overall")) > 15
    judged = chunks.filter("n >= 30").join(overall, "l_returnflag").groupBy("l_returnflag")
    return judged.agg(F.count("*").alias("chunks"), ((F.count("*") >= 2) & (F.count_if(off) == 0)).alias("homogeneous"), F.count_if(off).alias("deviating"))


@query("""
SELECT doc_id, sha, retired, disagrees FROM (SELECT doc_id, sha256(text) AS sha, row_number() OVER (PARTITION BY sha256(text) ORDER BY n_chars DESC, doc_id) AS i, count(*) OVER (PARTITION BY sha256(text)) - 1 AS retired,
  min(lang) OVER (PARTITION BY sha256(text)) <> max(lang) OVER (PARTITION BY sha256(text)) AS disagrees FROM documents) WHERE i = 1""")
def q_precedence_dedupe(t):
    d = t.documents.select("doc_id", "n_chars", "lang", F.sha2("text", 256).alias("sha"))
    return rel.governing(d, "sha", [F.desc("n_chars"), F.col("doc_id")], "lang").select("doc_id", "sha", "retired", "disagrees")


@query("""
SELECT doc_id, concat('D-', substr(sha256(concat_ws('|', CAST(quality AS VARCHAR), CAST(toxic AS VARCHAR), CAST(doc_id % 50 AS VARCHAR))), 1, 12), CASE WHEN i > 1 THEN concat('-', CAST(i AS VARCHAR)) ELSE '' END) AS decision_id
FROM (SELECT *, row_number() OVER (PARTITION BY quality, toxic, doc_id % 50 ORDER BY doc_id) AS i FROM labels)""")
def q_content_ids(t):
    """Ids from content; further occurrences of the same content are numbered."""
    rows = t.labels.withColumn("rest", F.col("doc_id") % 50)
    w = Window.partitionBy("quality", "toxic", "rest").orderBy("doc_id")
    i = F.row_number().over(w)
    base = rel.content_id("D-", F.col("quality").cast("string"), F.col("toxic").cast("string"), F.col("rest").cast("string"))
    return rows.select("doc_id", F.concat(base, F.when(i > 1, F.concat(L("-"), i.cast("string"))).otherwise("")).alias("decision_id"))


@query("""
SELECT user_id, session, count(*)::BIGINT AS n, min(ts) AS began, max(ts) AS ended FROM (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS session FROM (
  SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS nw FROM events)) GROUP BY 1, 2""")
def q_sessionize(t):
    return rel.sessions(t.events, ["user_id"], "ts", "event_id", 1800).groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("ts").alias("began"), F.max("ts").alias("ended"))
