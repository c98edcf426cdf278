"""Codons and seeds are read where the texts are: nothing is shuffled, or made a row of, for each letter."""

from collections import Counter

from pyspark.sql import functions as F

from cairn.functions import blocks as B
from cairn.operators import sequence as seq
from cairn.plans import catalogue


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def residue(codon):
    return "X" if set(codon) - set("TCAG") else B.AMINO_ACIDS["TCAG".index(codon[0]) * 16 + "TCAG".index(codon[1]) * 4 + "TCAG".index(codon[2])]


def test_translation_in_batches(spark):
    texts = [None, "", "AC", "ATGNNNTGA", "ATGéééTAAC", "A\U0001f600CTTT", "acg", "ATG" * 5000]
    df = spark.createDataFrame([(x,) for x in texts], "s string").select("s", B.residues_of("s").alias("r"), B.translate(F.col("s")).alias("want"))
    assert all(r.r == r.want for r in df.collect())


def test_translate_codons_makes_no_row_of_a_codon(spark, tmp_path):
    rows = [(1, "ATGTGATT"), (1, "TGATGA"), (2, "AC"), (3, None), (None, "é-ATG")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = catalogue.queries()["q_translate_codons"](spark, str(tmp_path))
    assert "Generate" not in plan(df)
    got = {r.doc_id: (r.residues, r.n_codons) for r in df.collect()}
    # both rows of 1 place by place, letters of one place in any order
    one, n = got.pop(1)
    bases = lambda s: "".join("ACCCGGGTTTAACCNGTACGTTACGT"[ord(c) - 65] for c in s)
    want = [[residue(bases(s)[i : i + 3]) for i in range(0, len(s) - 2, 3)] for s in ("ATGTGATT", "TGATGA")]
    assert n == 4 and [sorted(one[i : i + 2]) for i in (0, 2)] == [sorted(x) for x in zip(*want, strict=True)]
    assert got == {None: ("M" if bases("ATG") == "ATG" else residue(bases("ATG")), 1)}


def test_codon_classes_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(seq, "PIECE", 2)
    rows = [(1, "a", "ACGACGNNACC"), (2, "a", "ACGACTNNAACT"), (2, "b", "TTTTTCTTATTGA"), (3, "b", "TTCTTT"), (4, "b", ""), (5, None, "ACG"), (None, "a", "ACAGGG"), (6, "b", None)]
    df = spark.createDataFrame(rows, "id long, g string, s string")
    codons = [(i, g, [s[k : k + 3] for k in range(0, len(s) - 2, 3)]) for i, g, s in rows if s and g]
    counts = Counter((g, k, c) for _, g, cs in codons for k, c in enumerate(cs))
    best = {}
    for (g, k, c), n in counts.items():
        best[g, k] = min(best.get((g, k), (0, "~")), (-n, c))
    want = {}
    for i, g, cs in codons:
        sums = want.setdefault(i, [0] * 4)
        for k, c in enumerate(cs):
            other = best[g, k][1]
            aa, ca = residue(c), residue(other)
            ok = "X" not in (aa, ca)
            for j, x in enumerate((ok, ok and c != other and aa == ca, ok and aa != ca, aa == "X")):
                sums[j] += x
    for few in (True, False):
        out = seq.codon_classes(df, "id", "g", "s", few)
        assert {r.id: [r.assessable, r.synonymous, r.nonsynonymous, r.unreadable] for r in out.collect()} == want


def test_counts_of_a_task_are_rows_once(spark, monkeypatch):
    monkeypatch.setattr(seq, "CHUNK_LETTERS", 7)
    df = spark.createDataFrame([("a", i, "ACGT") for i in range(50)], "g string, id long, text string").coalesce(1)
    assert seq.letter_counts(df, "g", "id", "text").count() == 4
    monkeypatch.setattr(seq, "HELD", 6)
    many = spark.createDataFrame([(f"g{i % 9}", i, "ACGT"[i % 4 :] + chr(0x1F600 + i)) for i in range(60)], "g string, id long, text string").coalesce(1)
    assert seq.letter_counts(many, "g", "id", "text").agg(F.sum("n")).first()[0] == sum(len("ACGT"[i % 4 :]) + 1 for i in range(60))


def test_only_listed_seeds_leave_their_task(spark):
    texts = ["abcdéfg\U0001f600hijklmnop", "xyzabcdefghijklmno", "", None, "short", "q" * 40 + "abcdéfg\U0001f600hijk"]
    q = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    r = spark.createDataFrame([(1, "zz abcdéfg\U0001f600hijk"), (2, "efghijklmno!"), (3, None)], "item_id long, text string")
    bits = seq.seed_map(r, "text", 6)
    got = {tuple(x) for x in seq.listed_seeds(q, "doc_id", "text", "pos", 6, bits).collect()}
    of = {t[i : i + 6] for t in ("zz abcdéfg\U0001f600hijk", "efghijklmno!") for i in range(len(t) - 5)}
    want = {(n, i, t[i : i + 6]) for n, t in enumerate(texts) if t for i in range(len(t) - 5) if t[i : i + 6] in of}
    assert want <= got and len(got - want) <= 1
    assert "Generate" not in plan(seq.listed_seeds(q, "doc_id", "text", "pos", 6, bits))
