import pytest
from pyspark.errors import AnalysisException

from cairn.sources import audit
from cairn.sources.tabular import Refused


def test_sinks(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    cells = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "a", None)], "id long, canonical_field string, final_value string")
    audit.write_provenance(cells, path("p"))
    assert sorted(map(tuple, spark.read.parquet(path("p")).select(cells.columns).collect()), key=str) == sorted(map(tuple, cells.collect()), key=str)
    with pytest.raises(AnalysisException):
        audit.write_provenance(cells, path("p"))

    steps = spark.createDataFrame([(i, f"s{i}") for i in range(40)], "at long, step string").repartition(4)
    assert audit.write_ordered(steps, path("o"), ["step"], "at") == 40
    lines = []
    for part in sorted((tmp_path / "o").glob("part-*")):
        lines += [r.value for r in spark.read.text(str(part)).collect() if r.value != "step"]
    assert lines == [f"s{i}" for i in range(40)]
    with pytest.raises(Refused):
        audit.write_ordered(steps.union(steps), path("o2"), ["step"], "at")

    audit.write_divergence(spark.createDataFrame([("A.1.2", 3), ("B", 4), (None, 5)], "version string, n int"), path("d"))
    assert {(r.accession, r.n) for r in spark.read.parquet(path("d")).collect()} == {("A.1", 3), ("", 4), (None, 5)}

    rows = spark.createDataFrame([('say "so"', None), ("y", 2)], "a string, b int")
    audit.write_queue(rows, path("q"), ["b", "a"])
    assert {r.value for r in spark.read.text(path("q")).collect()} == {"b\ta", '\tsay "so"', "2\ty"}
    with pytest.raises(Refused):
        audit.write_queue(spark.createDataFrame([("x\ty",)], "a string"), path("q2"), ["a"])


def test_manifest(spark):
    of = lambda *names: spark.createDataFrame([(n,) for n in names], "path string")
    got = audit.manifest_problems(of("a", "b", "gone"), of("c", "b"), of("a", "b", "c", "new"))
    assert {tuple(r) for r in got.collect()} == {("b", "declared and carried"), ("gone", "missing"), ("new", "undeclared")}
    assert audit.manifest_problems(of("a"), of("c"), of("a", "c")).count() == 0
