import csv
import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from cairn.sources import deterministic as D
from cairn.sources.tabular import Refused

COLUMNS = ["id", "name", "note"]


@pytest.fixture(scope="module")
def rows(spark):
    text = F.when(F.col("id") % 5 == 0, 'say "x"\ty').when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("n"), F.col("id") % 11))
    return spark.range(2500).select((F.col("id") % 900).alias("id"), text.alias("name"), F.lit("é\n").alias("note"))


def whole(path):
    return b"".join(p.read_bytes() for p in sorted(path.glob("part-*")))


def test_bytes_do_not_depend_on_partitions(spark, rows, tmp_path):
    shas = []
    for n in (1, 3, 17):
        files = D.write_deterministic(rows.repartition(n, F.rand(n)), str(tmp_path / str(n)), COLUMNS, ["id"], rows=400)
        assert [f["rows"] for f in files] == [0, 400, 400, 400, 400, 400, 400, 100]
        assert all(hashlib.sha256((tmp_path / str(n) / f["name"]).read_bytes()).hexdigest() == f["sha256"] for f in files)
        assert not (tmp_path / str(n) / D.TEMPORARY).exists() and D.read_list(spark, str(tmp_path / str(n))).count() == len(files)
        shas.append([f["sha256"] for f in files])
    assert shas[0] == shas[1] == shas[2]
    data = whole(tmp_path / "3")
    assert data[:10] == b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff"
    back = list(csv.reader(gzip.decompress(data).decode().splitlines(keepends=True), delimiter="\t"))
    want = sorted([str(r.id), r.name or "", r.note] for r in rows.collect())
    assert back[0] == COLUMNS and sorted(back[1:]) == want and [r[0] for r in back[1:]] == sorted(r[0] for r in want)


def test_empty_refused_and_overwritten(spark, rows, tmp_path):
    at = str(tmp_path / "x")
    assert [f["rows"] for f in D.write_deterministic(rows.limit(0), at, COLUMNS, ["id"])] == [0]
    with pytest.raises(Refused):
        D.write_deterministic(rows, at, COLUMNS, ["id"])
    with pytest.raises(Refused):
        D.write_deterministic(rows, str(tmp_path / "y"), ["id", "name"], ["id"])
    D.write_deterministic(rows, at, COLUMNS, ["id"], rows=1000, overwrite=True)
    few = D.write_deterministic(rows.limit(3), at, COLUMNS, ["id"], rows=1000, overwrite=True)
    assert [f["rows"] for f in few] == [0, 3] and len(list((tmp_path / "x").glob("part-*"))) == 2


def test_a_failed_write_leaves_nothing_under_its_name(spark, rows, tmp_path):
    bad = rows.withColumn("name", F.when(F.col("id") == 600, F.raise_error(F.lit("no"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="no"):
        D.write_deterministic(bad, str(tmp_path / "x"), COLUMNS, ["id"])
    assert not list(tmp_path.glob("x/part-*")) and not (tmp_path / "x" / D.LIST).exists()


def test_transport_counts_in_the_pass_that_writes(spark, rows, tmp_path):
    canonical = ["id", "name", "note", "place", "year"]
    pending = {"place": "no rule yet", "year": "no source"}
    provenance = spark.createDataFrame([("name",), ("name",), ("id",)], "canonical_field string")
    got = D.write_transport(rows, str(tmp_path / "t"), canonical, pending, provenance)
    filled = rows.agg(*(F.count(F.nullif(F.col(c).cast("string"), F.lit(""))).alias(c) for c in COLUMNS)).first().asDict()
    assert got["rows"] == rows.count() and got["filled"] == filled and filled["name"] < got["rows"]
    assert got["provenance_fields"] == ["id", "name"] and got["transported_columns"] == COLUMNS
    assert json.loads((tmp_path / "t" / "coverage.json").read_text()) == got
    assert spark.read.csv(str(tmp_path / "t" / "rows"), sep="\t", header=True, multiLine=True, escape='"').count() == got["rows"]
    for wrong in ({"place": "no rule yet"}, {**pending, "name": "?"}):
        with pytest.raises(Refused):
            D.write_transport(rows, str(tmp_path / "u"), canonical, wrong)
