import pytest

from cairn.sources import flatfile, tabular

RECORDS = """LOCUS       TEST0001                  12 bp    RNA     linear   VRL 01-JAN-2020
DEFINITION  A test record,
            on two lines.
ACCESSION   TEST0001 OLD0001
VERSION     TEST0001.1
DBLINK      BioProject: PRJ1
            nocolon
KEYWORDS    first; second.
SOURCE      Some virus
  ORGANISM  Some virus
            Viruses; Riboviria;
            Enterovirus.
REFERENCE   1  (bases 1 to 12)
  AUTHORS   Ann,A., Bob,B. and Cee,C.
  TITLE     Direct submission
  JOURNAL   Unpublished
   PUBMED   123
COMMENT     Free text here.
            ##Assembly-Data-START##
            Method :: v. 1
            Technology :: Sanger
            ##Assembly-Data-END##
FEATURES             Location/Qualifiers
     source          1..12
                     /organism="Some virus"
                     /db_xref="taxon:12345"
                     /note="two
                     lines"
     CDS             join(1..6,complement(<7..12))
                     /codon_start=1
                     /db_xref="A:1"
                     /db_xref="B:2"
ORIGIN
        1 acgtacgtac gt
//
LOCUS       TEST0002                   4 bp    DNA     circular SYN 02-FEB-2021
DEFINITION  Second.
ACCESSION   TEST0002
VERSION     TEST0002.2
FEATURES             Location/Qualifiers
     source          1..4
ORIGIN
        1 acgt
//
"""


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("flat") / "records.gb"
    path.write_text(RECORDS)
    parsed = flatfile.parsed_records(spark, str(path)).cache()
    return parsed, {k: sorted(tuple(r) for r in v.collect()) for k, v in flatfile.relations(parsed).items()}


def test_all_relations_with_declared_columns(spark, tables):
    parsed, _ = tables
    assert {k: tuple(v.columns) for k, v in flatfile.relations(parsed).items()} == flatfile.RELATIONS
    none = flatfile.relations(parsed.limit(0))
    assert all(df.count() == 0 for df in none.values())


def test_records(tables):
    _, t = tables
    one, two = t["records"]
    assert one == ("TEST0001.1", "1", "TEST0001", "TEST0001.1", "TEST0001", "A test record, on two lines", "Some virus", "12345", "RNA", "linear", "VRL", "01-JAN-2020", "12", flatfile.sha256("ACGTACGTACGT"))
    assert two[:2] == ("TEST0002.2", "2") and two[7:12] == ("", "DNA", "circular", "SYN", "02-FEB-2021")


def test_children(tables):
    _, t = tables
    v = "TEST0001.1"
    assert t["record_keywords"] == [(v, "1", "first"), (v, "2", "second")]
    assert [r[2] for r in t["record_taxonomy"]] == ["Viruses", "Riboviria", "Enterovirus"]
    assert t["record_xrefs"] == [(v, "1", "BioProject", "PRJ1"), (v, "2", "", "nocolon")]
    assert [r[2:] for r in t["record_accessions"]] == [("TEST0001", "primary"), ("OLD0001", "secondary"), ("TEST0002", "primary")]
    assert [r[:4] for r in t["features"]] == [(f"{v}:F1", v, "1", "source"), (f"{v}:F2", v, "2", "CDS"), ("TEST0002.2:F1", "TEST0002.2", "1", "source")]
    assert [r for r in t["feature_location_parts"] if r[0] == f"{v}:F2"] == [(f"{v}:F2", "1", "1", "6", "+", "exact", "exact", ""), (f"{v}:F2", "2", "7", "12", "-", "before", "exact", "")]
    assert [r[1:] for r in t["feature_qualifiers"] if r[0] == f"{v}:F2"] == [("1", "codon_start", "1", "1"), ("2", "db_xref", "1", "A:1"), ("2", "db_xref", "2", "B:2")]
    assert ("3", "note", "1", "two lines") in [r[1:] for r in t["feature_qualifiers"]]
    assert t["references"] == [(f"{v}:R1", v, "1", "Direct submission", "Unpublished", "Ann,A., Bob,B. and Cee,C.", "123", "", "", "bases 1 to 12", "")]
    assert [r[2] for r in t["reference_authors"]] == ["Ann,A.", "Bob,B.", "Cee,C."]
    assert [r[0] for r in t["comments"]] == [f"{v}:C1", f"{v}:SC1"] and t["comments"][0][4] == "Free text here."
    assert [r[2:] for r in t["structured_comment_fields"]] == [("Method", "v. 1"), ("Technology", "Sanger")]


def test_typed_tier(spark, tables):
    parsed, _ = tables
    df = flatfile.typed(flatfile.relations(parsed)["records"])
    assert dict(df.dtypes)["sequence_length_nt"] == "bigint"
    assert sorted((r.record_ordinal, r.ncbi_taxid) for r in df.collect()) == [(1, "12345"), (2, None)]


def test_tsv_round_trip_and_refusals(spark, tmp_path):
    df = spark.createDataFrame([("1", 'say "x"\ty'), ("2", "two\nlines"), ("3", "")], "a string, b string")
    assert tabular.write_tsv(df, str(tmp_path / "t"), ["a", "b"]) == 3
    assert sorted(map(tuple, tabular.read_tsv(spark, str(tmp_path / "t"), ["a", "b"]).collect())) == sorted(map(tuple, df.collect()))
    for bad in (["a"], ["a", "b", "c"]):
        with pytest.raises(tabular.Refused):
            tabular.read_tsv(spark, str(tmp_path / "t"), bad)
    with pytest.raises(tabular.Refused):
        tabular.require_count(df, 4)
    with pytest.raises(tabular.Refused):
        tabular.require_unique(df.limit(0), "a")
    with pytest.raises(tabular.Refused):
        tabular.write_tsv(df.selectExpr("1 as a", "b"), str(tmp_path / "u"), ["a", "b"])


def test_fasta_and_stockholm_round_trips(spark, tmp_path):
    df = spark.createDataFrame([("b.1", "ACGT" * 40), ("a.2", "AC")], "id string, sequence string")
    tabular.write_fasta(df, str(tmp_path / "f"))
    assert sorted(map(tuple, tabular.read_fasta(spark, str(tmp_path / "f")).collect())) == sorted(map(tuple, df.collect()))
    assert {r.id for r in tabular.read_fasta(spark, str(tmp_path / "f"), strip_version=True).collect()} == {"a", "b"}
    rows = spark.createDataFrame([("one", "AC-T"), ("second", "A--T")], "id string, row string")
    tabular.write_stockholm(rows.coalesce(1), str(tmp_path / "s"), {"RF": "xx.x"})
    got, tags = tabular.read_stockholm(spark, str(tmp_path / "s"), strict=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect())) and tags == {"RF": "xx.x"}
    with pytest.raises(tabular.Refused):
        bad = tmp_path / "bad.sto"
        bad.write_text("# STOCKHOLM 1.0\nx AC\ny ACG\n//\n")
        tabular.read_stockholm(spark, str(bad))
