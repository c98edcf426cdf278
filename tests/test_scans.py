import pytest
from pyspark.sql import functions as F

from cairn.operators import segments
from cairn.sources import flatfile, scans
from cairn.sources.tabular import Refused

NAMES = ["accession", "tier", "who", "note"]


def spilled(spark, tmp_path, text, strict=False):
    (tmp_path / "x.csv").write_text(text)
    return {r.accession: (r.note, None if strict else r.refused) for r in scans.read_spilled(spark, str(tmp_path / "x.csv"), NAMES, "note", strict).collect()}


def test_a_spilled_reason_goes_back_to_its_cell(spark, tmp_path):
    text = "accession,tier,who,note\nA1,2,Mike,plain\nA2,2,Mike,\"quoted, whole\"\nA3,2,Mike,field AFP \u2014 Sabin2,[' Nigeria 2015']\nA4,2,Mike,a,\"['', ' b', '']\"\nA5,2,Mike,\n"
    got = spilled(spark, tmp_path, text)
    assert got == {"A1": ("plain", None), "A2": ("quoted, whole", None), "A3": ("field AFP \u2014 Sabin2, Nigeria 2015", None), "A4": ("a,, b,", None), "A5": ("", None)}
    assert spilled(spark, tmp_path, text, strict=True).keys() == got.keys()


def test_a_nameless_last_column(spark, tmp_path):
    got = spilled(spark, tmp_path, "accession,tier,who,note,\nA1,2,Mike,plain,\nA2,2,Mike,cut,[' off']\nA3,2,Mike,cut,[' off'],more\n")
    assert got == {"A1": ("plain", None), "A2": ("cut, off", None), "A3": ("cut", "more than one cell beyond the columns")}


@pytest.mark.parametrize(("row", "why"), [("A,2,M,x,Nigeria", "no printed list"), ("A,2,M,x,\"[1, 2]\"", "no printed list"), ("A,2,M,x,__import__('os')", "no printed list"), ("A,2,M,x,[' a'],b", "more than one"), ("A,2", "fewer cells")])
def test_what_cannot_be_mended_is_refused(spark, tmp_path, row, why):
    text = f"accession,tier,who,note\nB,2,M,good\n{row}\n"
    got = spilled(spark, tmp_path, text)
    assert got["B"] == ("good", None) and why in got["A"][1]
    with pytest.raises(Refused, match="1 rows"):
        spilled(spark, tmp_path, text, strict=True)


def test_a_wrong_header_is_refused(spark, tmp_path):
    with pytest.raises(Refused):
        spilled(spark, tmp_path, "accession,tier,note,who\nA,2,M,x\n")


def test_row_ids_by_first_sight_whatever_the_splits(spark, tmp_path):
    names = [f"R{i * 7919 % 400:03d}" for i in range(400)]
    blocks = "\n\n".join("\n".join(f"{n}   ACGT-{k}" for n in names[k * 30 :] + names[: k * 30]) for k in range(4))
    (tmp_path / "a.sto").write_text(f"# STOCKHOLM 1.0\n#=GF ID x\n{blocks}\n#=GC RF  xxxx\n//\n")
    seen = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("64m", "600b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            seen.append([r.id for r in scans.row_ids(spark, str(tmp_path / "a.sto")).orderBy("ordinal").collect()])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen[0] == seen[1] == names


def test_coverage_goes_out_and_comes_back(spark, tmp_path):
    rows = [("A", "A.1", "core", "f", "t", "cds", True, 10, 12, ""), ("A", "A.1", "core", "f", "t", "5ncr", False, 0, 0, "too short")]
    df = spark.createDataFrame(rows, "accession string, version string, tier string, family string, virus_type string, block string, present boolean, source_nt long, block_nt long, absence_reason string")
    scans.write_coverage(df, str(tmp_path / "c"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "c").glob("part-*")))
    assert "\tTRUE\t10\t12\t\n" in text and "\tFALSE\t" in text
    assert sorted(tuple(r) for r in scans.read_coverage(spark, str(tmp_path / "c")).collect()) == sorted(rows)
    (tmp_path / "bad.tsv").write_text("\t".join(scans.COVERAGE) + "\nA\tB\n")
    with pytest.raises(Exception):
        scans.read_coverage(spark, str(tmp_path / "bad.tsv")).collect()


def test_regions_lists_and_allowlists(spark, tmp_path):
    rows = [("PV1", "R", "VP1", "101", "200", "100"), ("PV1", "R", "VP4", "1", "100", "100"), ("PV2", "S", "VP4", "5", "9", "5")]
    scans.write_regions(spark.createDataFrame(rows, [*scans.REGIONS]), str(tmp_path / "r"))
    got = {r.serotype: {k: tuple(v) for k, v in r.regions.items()} for r in scans.read_regions(spark, str(tmp_path / "r")).collect()}
    assert got == {"PV1": {"VP4": (1, 100), "VP1": (101, 200)}, "PV2": {"VP4": (5, 9)}}
    (tmp_path / "m.tsv").write_text("path\tbytes\thash_scope\tsha256\na\t1\traw\tx\nb\t2\tcontent\ty\n")
    assert sorted(tuple(r) for r in scans.read_file_list(spark, str(tmp_path / "m.tsv")).collect()) == [("a", "raw", "x"), ("b", "content", "y")]
    (tmp_path / "l.csv").write_text("accession,why\nA,x\nB,y\n")
    assert scans.read_allowlist(spark, str(tmp_path / "l.csv"), ["accession", "why"], 2).count() == 2
    for text, n in (("accession,why\nA,x\nA,y\n", 2), ("accession,why\nA,x\n", 2), ("accession,reason\nA,x\n", 1)):
        (tmp_path / "l.csv").write_text(text)
        with pytest.raises(Refused):
            scans.read_allowlist(spark, str(tmp_path / "l.csv"), ["accession", "why"], n)
    for text in ("path\thash_scope\tsha256\na\tr\tx\na\tr\tx\n", "path\thash_scope\tsha256\n", "path\tsha256\na\tx\n"):
        (tmp_path / "m.tsv").write_text(text)
        with pytest.raises(Refused):
            scans.read_file_list(spark, str(tmp_path / "m.tsv"))


def test_plain_cells(spark):
    cells = ["no quotes", 'says "circulating" and "wild"', '""', 'odd " one', "tab\t", "\u201calready\u201d", ""]
    rows = spark.createDataFrame([(c,) for c in cells], "c string").select("c", scans.plain(F.col("c")).alias("p"), scans.plain_problem(F.col("c")).alias("why")).collect()
    assert {r.c: r.p for r in rows if r.p is not None} == {"no quotes": "no quotes", 'says "circulating" and "wild"': "says \u201ccirculating\u201d and \u201cwild\u201d", '""': "\u201c\u201d", "": ""}
    assert sum(r.why is not None for r in rows) == 3 and all((r.p is None) == (r.why is not None) for r in rows)


def test_translation_of_coding_columns(spark):
    rows = spark.createDataFrame([("good", "NNATGGCC---TAAxx"), ("stop", "NNATGTAAGCCGCCxx"), ("few", "NNATG---------xx")], "id string, row string")
    got = {r.id: (r.n_nt, r.internal_stops) for r in segments.translation_check(rows, 2, 12, 6).collect()}
    assert got == {"good": (9, 0), "stop": (12, 1)}
    assert segments.translation_check(rows, 2, 0, 0).count() == 0


def test_records_in_memory_are_those_of_a_file(spark, tmp_path):
    record = "LOCUS       X{0}  6 bp  RNA  linear  VRL 01-JAN-2000\nDEFINITION  d.\nACCESSION   X{0}\nVERSION     X{0}.1\nORIGIN\n        1 acgtac\n//\n"
    records = [record.format(i) for i in range(3)]
    (tmp_path / "x.gb").write_text("".join(records))
    of = lambda df: sorted((r.record_id, r.sequence) for r in df.collect())
    assert of(flatfile.records_in_memory(spark, records)) == of(flatfile.parsed_records(spark, str(tmp_path / "x.gb"))) and len(records) == 3
