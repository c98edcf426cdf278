r"""Chat formatting: quotation linking (operator 1, native).

Lines that begin with `>` marks are quotes; the number of marks is their level.  Lines of one level in a row are
a passage.  A quoted passage is normalised (letters lowered, white space and line breaks collapsed), hashed, and joined to the
first earlier message of its conversation that holds the passage unquoted, however its lines are broken; a passage that nobody is
found to have written whole is joined line by line.  A message's parent is the origin of its
shallowest linked passage: of several, the one with most quoted characters, then the latest.  A
message that quotes nothing known follows the message of the turn before it.

Reply order is the order of `path`: the turns that lead to a message through quotations, written equally wide
within a conversation; it is null for messages without a turn.  A reply
stands right below the message that it quotes.  Paths are built by pointer jumping, in rounds
logarithmic in the length of a conversation, so a conversation that holds a third of all messages is
never gathered in one task.

Defined results: null and empty texts quote nothing and stay as they are.  Rows that repeat a
conversation and turn are one message for linking, and a row each in the result.  Null conversations
are one conversation; messages without a turn are roots.  Attribution lines ("... wrote:") go with
the quote below them.  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import Scratch

# one class, not a group that repeats: Java would call itself once a mark
MARKS = r"^[ \t]*(>[> \t]*)"
QUOTED_LINE = r"(?m)^[ \t]*>[^\n]*(?:\n|\z)"
ATTRIBUTION = r"(?mi)^[^\n>]{0,200}(?:wrote|writes|schrieb|écrit|escribió)[^\n]{0,40}:[ \t]*\n(?=[ \t]*>)"


def _passages(rows: DataFrame) -> DataFrame:
    """A row per passage, lines of one level between blank ones: t (which text), its number, level, and the bodies of its lines."""
    body = lambda x: F.trim(F.regexp_replace(F.lower(F.regexp_replace(x, MARKS, "")), r"\s+", " "))
    level = lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), "[^>]", ""))
    lines = F.transform(F.split("text", "\n", -1), lambda x: F.struct(level(x).alias("level"), body(x).alias("body")))
    rows = rows.select("c", "turn", F.xxhash64("text").alias("t"), lines.alias("lines")).filter("lines is not null")
    at = lambda i: F.get("lines", i)
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    parted = lambda i, j: F.coalesce((at(j)["body"] == "") | (at(j)["level"] != at(i)["level"]), F.lit(True))
    ends = lambda step: F.filter(places, lambda i: (at(i)["body"] != "") & ((i + step < 0) | parted(i, i + step)))
    spans = F.zip_with(ends(-1), ends(1), lambda i, j: F.struct(at(i)["level"].alias("level"), F.slice("lines", i + 1, j - i + 1)["body"].alias("bodies")))
    return rows.select("c", "turn", "t", F.posexplode(spans).alias("passage", "p")).select("c", "turn", "t", "passage", "p.*")


def _units(passages: DataFrame, *keys: str) -> DataFrame:
    """What can be quoted of each passage: the whole, with its lines joined, and each line of it: hashes, characters and lines."""
    unit = lambda whole, text, n: F.struct(F.lit(whole).alias("whole"), text.alias("body"), n.alias("n"))
    single = F.when(F.size("bodies") > 1, F.transform("bodies", lambda x: unit(False, x, F.lit(1)))).otherwise(F.array().cast("array<struct<whole:boolean,body:string,n:int>>"))
    every = F.concat(F.array(unit(True, F.array_join("bodies", " "), F.size("bodies"))), single)
    rows = passages.select(*keys, F.explode(every).alias("u"))
    return rows.select(*keys, "u.whole", F.xxhash64("u.body").alias("h"), F.xxhash64(F.lit(1), "u.body").alias("h2"), F.length("u.body").alias("size"), "u.n")


def _heads(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(c, turn, head): the message at which the run of unquoting messages that holds a turn begins.

    Only turns whose head is not found yet are joined again: each round doubles their way.
    """
    onward = F.col("parent").isNull() & F.col("follows")
    at = scratch.save(nodes.select("c", "turn", F.when(onward, F.col("turn") - 1).otherwise(F.col("turn")).alias("head"), (~onward).alias("found")), "heads")
    while at.filter("not found").limit(1).count():
        up = at.select(F.col("c").alias("uc"), F.col("turn").alias("ut"), F.col("head").alias("uh"), F.col("found").alias("uf"))
        more = at.filter("not found").join(up, (F.col("c") == F.col("uc")) & (F.col("head") == F.col("ut")))
        new = scratch.save(at.filter("found").unionByName(more.select("c", "turn", F.col("uh").alias("head"), F.col("uf").alias("found"))), "heads")
        scratch.drop(at)
        at = new
    return at.select("c", "turn", "head")


def _paths(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(c, turn, path): turns from the root down to each message, through quotations; only paths that are not whole are joined again."""
    at = scratch.save(nodes.select("c", "turn", "up", F.array("turn").alias("path")), "paths")
    while at.filter("up is not null").limit(1).count():
        above = at.select(F.col("c").alias("uc"), F.col("turn").alias("ut"), F.col("up").alias("uu"), F.col("path").alias("upath"))
        both = at.filter("up is not null").join(above, (F.col("c") == F.col("uc")) & (F.col("up") == F.col("ut")), "left")
        more = both.select("c", "turn", F.col("uu").alias("up"), F.when(F.col("upath").isNull(), F.col("path")).otherwise(F.concat("upath", "path")).alias("path"))
        new = scratch.save(at.filter("up is null").unionByName(more), "paths")
        scratch.drop(at)
        at = new
    return at


def link_quotes(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without quotes, and of each message its quotation links and place."""
    scratch = Scratch(messages.sparkSession, "quotes")
    c = F.coalesce(F.col("conv_id").cast("long"), F.lit(-(1 << 63)))
    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.col("text").cast("string").alias("text"), c.alias("c"))
    placed = rows.filter("turn is not null")
    quoting = placed.filter(F.col("text").rlike(r"(?m)^[ \t]*>")).select("c", "turn", "text").distinct()
    quoted = scratch.save(_passages(quoting).filter("level > 0"), "quoted")
    units = scratch.save(_units(quoted, "c", "turn", "t", "passage", "level"), "units")
    # the first message that holds a passage or line unquoted; one that thousands hold meets in partial minimums
    asked = units.select("c", "h", "h2").distinct()
    origins = _units(_passages(placed).filter("level = 0"), "c", "turn").groupBy("c", "h", "h2").agg(F.min("turn").alias("origin")).join(asked, ["c", "h", "h2"], "left_semi")
    met = units.join(origins, ["c", "h", "h2"]).filter("origin < turn")
    # lines speak only for passages that nobody is found to have written whole
    spoken = F.max("whole").over(Window.partitionBy("c", "turn", "t", "passage"))
    met = met.withColumn("spoken", spoken).filter("whole = spoken")
    linked = met.groupBy("c", "turn", "level", "origin").agg(F.sum("size").alias("chars"), F.sum("n").alias("lines"))
    parents = linked.groupBy("c", "turn").agg(F.max(F.struct(-F.col("level"), "chars", "origin")).alias("m"), F.sum("lines").alias("n_linked")).select("c", "turn", F.col("m.origin").alias("parent"), "n_linked")
    counts = quoted.groupBy("c", "turn").agg(F.sum(F.size("bodies")).alias("n_quoted"), F.max("level").alias("max_level"))

    ids = placed.select("c", "turn").distinct()
    before = ids.select(F.col("c").alias("bc"), (F.col("turn") + 1).alias("bt"))
    nodes = ids.join(before, (F.col("c") == F.col("bc")) & (F.col("turn") == F.col("bt")), "left").select("c", "turn", F.col("bc").isNotNull().alias("follows"))
    nodes = nodes.join(parents, ["c", "turn"], "left").join(counts, ["c", "turn"], "left")
    nodes = scratch.save(nodes, "nodes")
    heads = _heads(nodes, scratch)
    quoting = nodes.filter("parent is not null").select(F.col("c").alias("hc"), F.col("turn").alias("ht"), F.col("parent").alias("up"))
    hung = heads.join(quoting, (F.col("c") == F.col("hc")) & (F.col("head") == F.col("ht")), "left").select("c", "turn", "up")
    paths = _paths(hung, scratch).select("c", "turn", "path")
    # turns are written as wide as the conversation's widest, so that paths sort as numbers do
    width = ids.groupBy("c").agg(F.max(F.length(F.col("turn").cast("string"))).alias("width"))
    paths = paths.join(width, "c").withColumn("path", F.transform("path", lambda x: F.lpad(x.cast("string"), F.col("width"), F.lit("0"))))
    about = nodes.join(paths, ["c", "turn"]).select(F.col("c").alias("nc"), F.col("turn").alias("nt"), "parent", "follows", "n_linked", "n_quoted", "max_level", "path")

    clean = F.rtrim(F.regexp_replace(F.regexp_replace("text", ATTRIBUTION, ""), QUOTED_LINE, ""))
    out = rows.join(about, (F.col("c") == F.col("nc")) & (F.col("turn") == F.col("nt")), "left")
    parent = F.coalesce("parent", F.when(F.col("follows"), F.col("turn") - 1))
    return out.select(
        "conv_id", "turn", "role",
        F.when(F.col("n_quoted").isNull(), F.col("text")).otherwise(clean).alias("text"),
        F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
        F.coalesce("max_level", F.lit(0)).cast("long").alias("max_level"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        parent.alias("parent_turn"),
        F.when(F.col("parent").isNotNull(), "quote").when(F.col("follows"), "sequence").otherwise("root").alias("link"),
        F.array_join("path", ".").alias("path"),
    )


def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE_SQL = rf"""
WITH RECURSIVE a AS (SELECT row_number() OVER () AS r, conv_id, turn, string_split(text, chr(10)) AS ls FROM (SELECT DISTINCT conv_id, turn, text FROM conversations)),
e AS (SELECT r, conv_id, turn, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM a),
l AS (
  SELECT r, conv_id, turn, i, length(regexp_replace(regexp_extract(line, '{MARKS}', 1), '[^>]', '', 'g')) AS level, trim(regexp_replace(lower(regexp_replace(line, '{MARKS}', '')), '\s+', ' ', 'g')) AS body FROM e),
f AS (SELECT *, CASE WHEN body <> '' AND (coalesce(lag(body) OVER w, '') = '' OR lag(level) OVER w <> level) THEN 1 ELSE 0 END AS begins FROM l WINDOW w AS (PARTITION BY r ORDER BY i)),
g AS (SELECT *, sum(begins) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING) AS passage FROM f),
j AS (SELECT r, conv_id, turn, level, passage, string_agg(body, ' ' ORDER BY i) AS body, count(*) AS n FROM g WHERE body <> '' GROUP BY ALL),
q AS (SELECT * FROM g WHERE level > 0 AND body <> ''),
y AS (
  SELECT r, conv_id, turn, level, passage, body, n, 1 AS whole FROM j
  UNION ALL SELECT g.r, g.conv_id, g.turn, g.level, g.passage, g.body, 1, 0 FROM g JOIN j ON j.r = g.r AND j.passage = g.passage WHERE g.body <> '' AND j.n > 1),
o AS (SELECT conv_id, body, min(turn) AS origin FROM y WHERE level = 0 GROUP BY ALL),
m AS (SELECT y.*, o.origin, max(whole) OVER (PARTITION BY y.r, y.passage) AS spoken FROM y JOIN o ON o.conv_id = y.conv_id AND o.body = y.body WHERE level > 0 AND o.origin < y.turn),
k AS (SELECT conv_id, turn, level, origin, sum(length(body)) AS chars, sum(n) AS n FROM m WHERE whole = spoken GROUP BY ALL),
p AS (SELECT conv_id, turn, arg_max(origin, (-level, chars, origin)) AS parent, sum(n) AS n_linked FROM k GROUP BY ALL),
c AS (SELECT conv_id, turn, count(*) AS n_quoted, max(level) AS max_level FROM q GROUP BY ALL),
i AS (SELECT DISTINCT conv_id, turn FROM conversations),
z AS (SELECT conv_id, max(length(CAST(turn AS VARCHAR)))::INTEGER AS width FROM i GROUP BY conv_id),
n AS (
  SELECT i.conv_id, i.turn, p.parent, p.n_linked, c.n_quoted, c.max_level, b.turn IS NOT NULL AS follows
  FROM i LEFT JOIN p ON p.conv_id = i.conv_id AND p.turn = i.turn LEFT JOIN c ON c.conv_id = i.conv_id AND c.turn = i.turn LEFT JOIN i b ON b.conv_id = i.conv_id AND b.turn = i.turn - 1),
h AS (SELECT *, max(CASE WHEN parent IS NOT NULL OR NOT follows THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS head FROM n),
u AS (SELECT h.conv_id, h.turn, g.parent AS up FROM h JOIN n g ON g.conv_id = h.conv_id AND g.turn = h.head),
t AS (
  SELECT u.conv_id, turn, lpad(CAST(turn AS VARCHAR), width, '0') AS path FROM u JOIN z ON z.conv_id = u.conv_id WHERE up IS NULL
  UNION ALL SELECT u.conv_id, u.turn, t.path || '.' || lpad(CAST(u.turn AS VARCHAR), width, '0') FROM t JOIN u ON u.conv_id = t.conv_id AND u.up = t.turn JOIN z ON z.conv_id = u.conv_id)
SELECT r.conv_id, r.turn, r.role,
  CASE WHEN n_quoted IS NULL THEN r.text ELSE rtrim(regexp_replace(regexp_replace(r.text, '{ATTRIBUTION.replace("(?=[ ", "([ ")}', '\1', 'g'), '{QUOTED_LINE}', '', 'g')) END AS text,
  coalesce(n_quoted, 0)::BIGINT AS n_quoted, coalesce(max_level, 0)::BIGINT AS max_level, coalesce(n_linked, 0)::BIGINT AS n_linked,
  coalesce(parent, CASE WHEN follows THEN r.turn - 1 END) AS parent_turn, CASE WHEN parent IS NOT NULL THEN 'quote' WHEN follows THEN 'sequence' ELSE 'root' END AS link, t.path
FROM conversations r JOIN n ON n.conv_id = r.conv_id AND n.turn = r.turn JOIN t ON t.conv_id = r.conv_id AND t.turn = r.turn
"""
