"""Closed-form cases of coding segments, and of places in compound locations."""

from pyspark.sql import functions as F

from cairn.functions import blocks as B
from cairn.operators import segments as S

FEATURE = "feature_id string, record_id string, feature_ordinal string, feature_key string"
PART = "feature_id string, part_ordinal string, start_1based string, end_1based_inclusive string, strand string"
QUALIFIER = "feature_id string, qualifier_ordinal string, value_ordinal string, qualifier_name string, qualifier_value string"


def tables(spark, features, parts, starts):
    """features: (id, record); parts: (feature, ordinal, start, end, strand); starts: (feature, codon_start)."""
    text = lambda rows: [tuple(map(str, r)) for r in rows]
    f = spark.createDataFrame(text((i, r, n, "CDS") for n, (i, r) in enumerate(features)), FEATURE)
    return f, spark.createDataFrame(text(parts), PART), spark.createDataFrame(text((f, 1, 1, "codon_start", v) for f, v in starts), QUALIFIER)


def found(spark, sequences, features, parts, starts, of=S.annotated):
    records = spark.createDataFrame(list(sequences.items()), "record_id string, sequence string")
    return {r.record_id: r for r in of(records, S.primary_cds(*tables(spark, features, parts, starts))).collect()}


def one(spark, sequence, parts, start):
    return found(spark, {"r": sequence}, [("f", "r")], [("f", *p) for p in parts], [("f", start)] if start is not None else [])["r"]


def test_forward_with_flanks(spark):
    r = one(spark, "AAAAA" + "ATGGCCTAA" + "TTTT", [(1, 6, 14, "+")], 1)
    assert (r.ncr5, r.ncr3, r.orf_nt, r.aa, r.n_internal_stops, r.strand) == ("AAAAA", "TTTT", "ATGGCC", "MA", 0, "+")


def test_codon_start_moves_the_frame_and_not_the_flank(spark):
    r = one(spark, "AAAAA" + "CATGGCCTAA" + "TTTT", [(1, 6, 15, "+")], 2)
    assert (r.orf_nt, r.aa, r.ncr5) == ("ATGGCC", "MA", "AAAAA")


def test_reverse_strand_swaps_the_flanks(spark):
    r = one(spark, "AAAA" + "TTAGGCCAT" + "TTT", [(1, 5, 13, "-")], 1)
    assert (r.strand, r.orf_nt, r.aa, r.ncr5, r.ncr3) == ("-", "ATGGCC", "MA", "AAA", "TTTT")


def test_joins_follow_the_order_of_parts_each_on_its_strand(spark):
    sequence = "AAAAACCCCCGGGGGTTTTT"
    spliced = lambda parts: spark.range(1).select(S.splice(F.array(*(F.struct(F.lit(o).alias("ordinal"), F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(s).alias("strand")) for o, a, b, s in parts)), F.lit(sequence)).alias("x")).first().x
    assert spliced([(1, 1, 5, "-")]) == "TTTTT"
    assert spliced([(2, 11, 15, "+"), (1, 1, 5, "+")]) == "AAAAAGGGGG"
    assert spliced([(1, 11, 15, "-"), (2, 1, 5, "-")]) == "CCCCCTTTTT"
    assert spliced([(1, 6, 10, "+"), (2, 1, 5, "-"), (3, 6, 6, "+")]) == "CCCCCTTTTTC"


def test_what_cannot_be_read_is_refused_with_a_reason(spark):
    cases = {None: "no codon_start", "x": "codon_start is not an integer", "4": "codon_start is not 1, 2 or 3"}
    for start, reason in cases.items():
        r = one(spark, "ATGGCCTAA", [(1, 1, 9, "+")], start)
        assert r.problem == reason and r.orf_nt is None and r.aa is None and r.ncr5 is None
    assert one(spark, "AT", [(1, 1, 2, "+")], 3).problem == "codon_start exceeds the spliced text"


def test_the_primary_feature_is_the_widest_and_the_first_of_equals(spark):
    cds = S.primary_cds(*tables(spark, [("short", "r"), ("first", "r"), ("second", "r"), ("bare", "r"), ("mixed", "s")], [("short", 1, 1, 10, "+"), ("first", 1, 1, 20, "+"), ("first", 2, 50, 100, "+"), ("second", 1, 2, 101, "-"), ("mixed", 1, 5, 10, "+"), ("mixed", 2, 20, 30, "-")], [("first", 2), ("mixed", 1)]))
    rows = {r.record_id: r for r in cds.collect()}
    assert (rows["r"].feature_id, rows["r"].start, rows["r"].end, rows["r"].strand, rows["r"].codon_start) == ("first", 1, 100, "+", 2)
    assert (rows["s"].start, rows["s"].end, rows["s"].strand) == (5, 30, "")
    assert {r.record_id: tuple(r.cds) for r in S.cds_frame(cds).collect()} == {"r": (1, 100, "+", 2), "s": (5, 30, "+", 1)}


def test_places_go_both_ways_through_a_join(spark):
    _, parts, _ = tables(spark, [], [("f", 1, 11, 15, "-"), ("f", 2, 1, 5, "+"), ("f", 3, 4, 8, "+"), ("g", 1, 3, 3, "-")], [])
    places = spark.createDataFrame([("f", i) for i in range(-1, 16)] + [("g", 0), ("h", 0)], "feature_id string, spliced long")
    there = {(r.feature_id, r.spliced): r.position for r in S.to_record(places, parts).collect()}
    assert [there["f", i] for i in range(15)] == [15, 14, 13, 12, 11, 1, 2, 3, 4, 5, 4, 5, 6, 7, 8]
    assert there["f", -1] is there["f", 15] is there["h", 0] is None and there["g", 0] == 3
    back = S.to_spliced(S.to_record(places, parts).filter("position is not null").select("feature_id", "position", F.col("spliced").alias("was")).distinct(), parts)
    assert back.filter("was = spliced").count() == 16
    twice = S.to_spliced(spark.createDataFrame([("f", 4), ("f", 9)], "feature_id string, position long"), parts)
    assert sorted((r.position, r.spliced) for r in twice.collect() if r.spliced is not None) == [(4, 8), (4, 10)]


def test_the_longest_open_run(spark):
    open_run = lambda text: spark.range(1).select(S.longest_open(F.lit(text)).alias("x")).first().x
    assert tuple(open_run("TAAATGGCCTAAGCC")) == (4, "AAATGGCCTAAG", "KWPK")
    assert open_run("") is open_run("AT") is None


def test_the_whole_ladder(spark):
    long = "ATG" + "GCC" * 20 + "TAA"
    short = "ATG" + "GCC" * 2 + "TAA" + "ATG" + "GCC" * 30 + "TAA"
    got = found(
        spark,
        {"good": "AAAAA" + long + "TTTT", "short": short, "bad": "N" * 30, "bare": long, "none": "N" * 10, "refused": long, "x": "ATG" + "GCC" * 10 + "NNN" * 15 + "GCC" * 5 + "TAA"},
        [("f1", "good"), ("f2", "short"), ("f3", "bad"), ("f4", "refused")],
        [("f1", 1, 6, 5 + len(long), "+"), ("f2", 1, 1, 12, "+"), ("f3", 1, 1, 9, "+"), ("f4", 1, 1, 9, "+")],
        [("f1", 1), ("f2", 1), ("f3", 1)],
        S.segment,
    )
    assert {k: (r.method, r.absence_reason) for k, r in got.items()} == {"good": ("annotated", None), "short": ("inferred", None), "bad": ("none", S.REJECTED), "bare": ("inferred", None), "none": ("none", S.NO_CDS), "refused": ("refused", None), "x": ("none", S.NO_CDS)}
    assert (got["good"].aa, got["good"].ncr5, got["good"].ncr3) == ("M" + "A" * 20, "AAAAA", "TTTT")
    assert got["short"].ncr5 == got["short"].ncr3 == "" and len(got["short"].aa) >= S.INFERRED_LEAST


def test_inference_equals_a_search_of_all_frames(spark):
    turned = lambda x: x.translate(str.maketrans("ACGTN", "TGCAN"))[::-1]
    code = {a + b + c: B.AMINO_ACIDS[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}

    def best(text):
        out = (0, "", "", "")
        for strand, t in (("+", text), ("-", turned(text))):
            for frame in range(3):
                aa = "".join(code.get(t[i : i + 3], "X") for i in range(frame, len(t) - 2, 3))
                at = 0
                for run in aa.split("*"):
                    if len(run) > out[0]:
                        out = (len(run), t[frame + 3 * at : frame + 3 * (at + len(run))], run, strand)
                    at += len(run) + 1
        return out[1:] if out[0] >= 20 and out[2].count("X") <= 0.4 * out[0] else None

    import random

    rng = random.Random(7)
    texts = ["".join(rng.choice("ACGT" * 9 + "N") for _ in range(rng.randrange(0, 400))) for _ in range(40)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", S.inferred(F.col("t")).alias("x")).collect()
    assert all((tuple(r.x) if r.x else None) == best(r.t) for r in rows)


def test_texts_are_read_twice_for_annotated_segments(spark):
    """Once as bases and once for their number: a filter must not have them read again, nor features and qualifiers."""
    from types import SimpleNamespace

    from cairn.plans import anchoring

    texts = [(i, "Abc déf " * (i * 7) + "xyz") for i in range(12)] + [(20, None), (21, ""), (22, "ü" * 70)]
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    df = anchoring.q_annotated_segments(SimpleNamespace(documents=documents))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_as_bases(") == 1 and plan.count("_count_bases(") == 1
    assert plan.count("array_join(") == 1  # parts are spliced once
    assert {r.doc_id for r in df.collect()} == {i for i, x in texts if x and sum(c.isascii() and c.isalpha() for c in x) >= 60}


def test_the_other_strand_of_any_text(spark):
    texts = ["ACGTN", "", None, "A", "xACGTé", "GATTACA" * 500]
    want = [x if x is None else x[::-1].translate(str.maketrans("ACGTN", "TGCAN")) for x in texts]
    for some in (texts, [x for x in texts if x is None or x.isascii()]):
        rows = spark.createDataFrame([(i, x) for i, x in enumerate(some)], "i int, x string").coalesce(1)
        got = [r.y for r in rows.select("i", B.reverse_complement(F.col("x")).alias("y")).orderBy("i").collect()]
        assert got == [want[texts.index(x)] for x in some]


def test_coding_texts_by_batch(spark):
    """Against codons read one by one: stops at the end and within, left over letters, empty, null and texts beyond ASCII."""
    code = dict(zip((a + b + c for a in "TCAG" for b in "TCAG" for c in "TCAG"), B.AMINO_ACIDS, strict=True))

    def plain(x):
        codons = [x[i : i + 3] for i in range(0, len(x) - 2, 3)]
        codons = codons[:-1] if codons and code.get(codons[-1]) == "*" else codons
        read = [code.get(c, "X") for c in codons]
        return "".join(codons), "".join(read).replace("*", "X"), read.count("*")

    texts = ["", None, "AT", "TAA", "TAATAG", "ATGTAAGCCTAAG", "ATGNNNTGA", "TAAATG", "GATTACA" * 40]
    for some in (texts, [*texts, "ATéTAAGCüTGA", "é"]):
        rows = spark.createDataFrame([(i, x) for i, x in enumerate(some)], "i int, x string").coalesce(1)
        got = rows.select("i", B.coding(F.col("x")).alias("y")).orderBy("i").collect()
        assert [None if r.y is None else tuple(r.y) for r in got] == [None if x is None else plain(x) for x in some]
