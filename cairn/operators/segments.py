"""Coding segments of records: positions through compound locations, annotated segments, and inference where there are none.

Features, parts and qualifiers are the relations of `sources.flatfile`: a feature has parts in order, each a span of
the record on one strand; spliced, they are the feature's own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import blocks as B

# Which annotated segments are taken as they are, and which inferred ones at all.
ANNOTATED_MOST_STOPS, ANNOTATED_LEAST, INFERRED_LEAST, INFERRED_MOST_X = 1, 20, 20, 0.4
NO_CDS, REJECTED = "no_cds_untranslatable", "annotated_rejected_untranslatable"


def coordinate_map(parts: DataFrame) -> DataFrame:
    """`parts` with from and to: the places that each part has in its feature's spliced text, counted from 0."""
    size = F.col("end_1based_inclusive").cast("long") - F.col("start_1based").cast("long") + 1
    before = Window.partitionBy("feature_id").orderBy(F.col("part_ordinal").cast("long")).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(size).over(before), F.lit(0))
    return parts.select("feature_id", F.col("part_ordinal").cast("long").alias("part_ordinal"), F.col("start_1based").cast("long").alias("start"), F.col("end_1based_inclusive").cast("long").alias("end"), "strand", start.alias("from"), (start + size).alias("to"))


def _through(rows: DataFrame, parts: DataFrame, low: str, high: str, column: str, out: str) -> DataFrame:
    """`rows` with the parts that hold the place in `column`, and the other place of the two."""
    m = coordinate_map(parts).withColumn("past", F.col("end") + 1)
    m = m.select(*(F.col(c).alias(f"__{c}") for c in m.columns))
    at, turned = F.col(column), F.col("__strand") == "-"
    inside = (F.col("feature_id") == F.col("__feature_id")) & (at >= F.col(f"__{low}")) & (at < F.col(f"__{high}"))
    met = rows.join(m, inside, "left")
    if out == "position":
        along = at - F.col("__from")
        place = F.when(turned, F.col("__end") - along).otherwise(F.col("__start") + along)
    else:
        place = F.col("__from") + F.when(turned, F.col("__end") - at).otherwise(at - F.col("__start"))
    return met.select(*rows.columns, F.col("__part_ordinal").alias("part_ordinal"), F.col("__strand").alias("strand"), place.alias(out))


def to_record(places: DataFrame, parts: DataFrame) -> DataFrame:
    """`places` (feature_id, spliced) with part_ordinal, strand and the 1-based position in the record; places outside have none."""
    return _through(places, parts, "from", "to", "spliced", "position")


def to_spliced(positions: DataFrame, parts: DataFrame) -> DataFrame:
    """`positions` (feature_id, position) with part_ordinal, strand and the place in the spliced text: a row for each part that holds the position."""
    return _through(positions, parts, "start", "past", "position", "spliced")


def splice(parts: Column, text: Column, other: Column | None = None) -> Column:
    """The parts (ordinal, start, end, strand) of a text in order, each on its own strand; `other` is the text's other strand."""
    size, turned = F.length(text), F.reverse(F.translate(text, "ACGT", "TGCA")) if other is None else other

    def piece(p: Column) -> Column:
        start, end = F.greatest(p["start"] - 1, F.lit(0)), F.least(p["end"], size)
        return F.when(p["strand"] == "-", B.cut(turned, size - end, size - start)).otherwise(B.cut(text, p["start"] - 1, p["end"]))

    return F.array_join(F.transform(F.array_sort(parts), piece), "")


def primary_cds(features: DataFrame, parts: DataFrame, qualifiers: DataFrame) -> DataFrame:
    """record_id, feature_id, parts, start, end, strand, codon_start (null unless 1, 2 or 3) and said (its text): the widest coding feature of each record, the first of equals.

    The span goes from the least start to the greatest end; a strand on which the parts disagree is empty.  Features without parts are passed over.
    """
    number = lambda c: F.col(c).cast("long")
    part = F.struct(number("part_ordinal").alias("ordinal"), number("start_1based").alias("start"), number("end_1based_inclusive").alias("end"), "strand")
    spans = parts.groupBy("feature_id").agg(
        F.array_sort(F.collect_list(part)).alias("parts"),
        F.min(number("start_1based")).alias("start"),
        F.max(number("end_1based_inclusive")).alias("end"),
        F.when(F.min("strand") == F.max("strand"), F.min("strand")).otherwise("").alias("strand"),
    )
    said = qualifiers.filter("qualifier_name = 'codon_start'").groupBy("feature_id").agg(F.max_by("qualifier_value", F.struct(number("qualifier_ordinal"), number("value_ordinal"))).alias("said"))
    rows = features.filter("feature_key = 'CDS'").select("record_id", "feature_id", number("feature_ordinal").alias("ordinal")).join(spans, "feature_id").join(said, "feature_id", "left")
    best = rows.groupBy("record_id").agg(F.max_by(F.struct("feature_id", "parts", "start", "end", "strand", "said"), F.struct(F.col("end") - F.col("start"), -F.col("ordinal"))).alias("m"))
    start = F.expr("try_cast(said AS int)")
    return best.select("record_id", "m.*").withColumn("codon_start", F.when(start.isin(1, 2, 3), start))


def cds_frame(cds: DataFrame) -> DataFrame:
    """record_id and cds (start, end, strand, codon_start) as `anchored` takes it; records of no use to it are left out."""
    strand = F.when(F.col("strand") == "", "+").otherwise(F.col("strand"))
    return cds.filter("codon_start IS NOT NULL").select("record_id", F.struct("start", "end", strand.alias("strand"), "codon_start").alias("cds"))


def annotated(records: DataFrame, cds: DataFrame) -> DataFrame:
    """record_id, sequence, strand, ncr5, ncr3, orf_nt, aa, n_internal_stops and problem of each record (record_id, sequence); null where it has no coding feature.

    `problem` says why an annotation cannot be read; such a row has no segments.
    """
    c = F.col
    rows = records.select("record_id", "sequence").join(cds, "record_id", "left")
    # the other strand is made once, and only where some part is on it
    rows = rows.withColumn("other", B.other_strand_once(F.when(F.exists("parts", lambda p: p["strand"] == "-"), c("sequence"))))
    rows = rows.withColumn("spliced", F.when(c("parts").isNotNull(), splice(c("parts"), c("sequence"), c("other"))))
    said = F.expr("try_cast(said AS int)")
    problem = (
        F.when(c("feature_id").isNull(), None)
        .when(c("said").isNull(), "no codon_start")
        .when(said.isNull(), "codon_start is not an integer")
        .when(c("codon_start").isNull(), "codon_start is not 1, 2 or 3")
        .when(c("codon_start") > F.length("spliced"), "codon_start exceeds the spliced text")
    )
    sound = c("feature_id").isNotNull() & c("problem").isNull()
    turned = c("strand") == "-"
    size = F.length("sequence")
    rows = rows.withColumn("problem", problem).withColumn("made", F.when(sound, B.coding(B.cut(c("spliced"), c("codon_start") - 1, F.length("spliced")))))
    oriented = F.when(turned, c("other")).otherwise(c("sequence"))
    low, high = F.when(turned, size - c("end")).otherwise(c("start") - 1), F.when(turned, size - c("start") + 1).otherwise(c("end"))
    return rows.select("record_id", "sequence", F.when(sound, F.when(turned, "-").otherwise("+")).alias("strand"), F.when(sound, B.cut(oriented, F.lit(0), low)).alias("ncr5"), F.when(sound, B.cut(oriented, high, size)).alias("ncr3"), c("made.nt").alias("orf_nt"), c("made.aa").alias("aa"), c("made.stops").alias("n_internal_stops"), "problem", c("feature_id").isNotNull().alias("has_cds"))


def longest_open(text: Column) -> Column:
    """(n, nt, aa) of the longest run of residues without a stop in the three frames of a text; the first of equals."""

    def of_frame(frame: int) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("first"), F.lit(0).alias("n"))

        def step(s: Column, p: Column) -> Column:
            size, more = F.length(p), F.length(p) > s["n"]
            return F.struct((s["at"] + size + 1).cast("int").alias("at"), F.when(more, s["at"]).otherwise(s["first"]).cast("int").alias("first"), F.greatest(size, s["n"]).cast("int").alias("n"))

        residues = B.translate(F.substr(text, F.lit(frame + 1), F.length(text)))
        return F.aggregate(F.split(residues, r"\*"), start, step, lambda s: F.struct(s["n"].alias("n"), F.lit(-frame).alias("frame"), (s["first"] * 3 + frame).cast("int").alias("from")))

    best = F.array_max(F.array(*(of_frame(k) for k in range(3))))
    nt = B.cut(text, best["from"], best["from"] + 3 * best["n"])
    return F.when(best["n"] > 0, F.struct(best["n"].alias("n"), nt.alias("nt"), B.translate(nt).alias("aa")))


def inferred(text: Column) -> Column:
    """(nt, aa, strand) of the longest open run of both strands, the given one first; null if it is too short or too little of it can be read."""
    ahead, back = longest_open(text), longest_open(B.reverse_complement(text))
    turned = F.coalesce(back["n"], F.lit(0)) > F.coalesce(ahead["n"], F.lit(0))
    nt, aa = F.when(turned, back["nt"]).otherwise(ahead["nt"]), F.when(turned, back["aa"]).otherwise(ahead["aa"])
    usable = (F.length(aa) >= INFERRED_LEAST) & (F.regexp_count(aa, F.lit("X")) <= INFERRED_MOST_X * F.length(aa))
    return F.when(usable, F.struct(nt.alias("nt"), aa.alias("aa"), F.when(turned, "-").otherwise("+").alias("strand")))


def translation_check(rows: DataFrame, lo: int, width: int, least: int) -> DataFrame:
    """(id, n_nt, internal_stops) of the rows (id, row) whose coding columns hold at least `least` letters; gaps keep their place as N.

    Clean rows are those without internal stops; a width of 0 has no rows.
    """
    block = F.substring("row", lo + 1, width)
    residues = B.translate(F.translate(block, B.GAP, "N"))
    held = F.substr(residues, F.lit(1), F.greatest(F.length(residues) - 1, F.lit(0)))
    checked = rows.select("id", F.length(F.translate(block, B.GAP, "")).alias("n_nt"), F.regexp_count(held, F.lit(r"\*")).alias("internal_stops"))
    return checked.filter((F.col("n_nt") >= least) & F.lit(width > 0))


def segment(records: DataFrame, cds: DataFrame) -> DataFrame:
    """record_id, method, strand, ncr5, orf_nt, ncr3, aa, n_internal_stops, absence_reason and problem of each record.

    The annotated segment if it is long enough and holds few stops, else one inferred, which has no flanks, else none and why.
    A record whose annotation cannot be read is `refused`, with the problem.
    """
    c = F.col
    rows = annotated(records, cds)
    taken = F.coalesce((c("n_internal_stops") <= ANNOTATED_MOST_STOPS) & (F.length("aa") >= ANNOTATED_LEAST), F.lit(False))
    rows = rows.withColumn("taken", taken).withColumn("guess", F.when(~c("taken") & c("problem").isNull(), inferred(c("sequence"))))
    guessed = c("guess").isNotNull()
    pick = lambda a, b: F.when(c("taken"), a).when(guessed, b).otherwise(F.lit(""))
    return rows.select(
        "record_id",
        F.when(c("problem").isNotNull(), "refused").when(c("taken"), "annotated").when(guessed, "inferred").otherwise("none").alias("method"),
        pick(c("strand"), c("guess.strand")).alias("strand"),
        pick(c("ncr5"), F.lit("")).alias("ncr5"),
        pick(c("orf_nt"), c("guess.nt")).alias("orf_nt"),
        pick(c("ncr3"), F.lit("")).alias("ncr3"),
        pick(c("aa"), c("guess.aa")).alias("aa"),
        F.when(c("taken"), c("n_internal_stops")).otherwise(0).alias("n_internal_stops"),
        F.when(c("problem").isNull() & ~c("taken") & ~guessed, F.when(c("has_cds"), REJECTED).otherwise(NO_CDS)).alias("absence_reason"),
        "problem",
    )
