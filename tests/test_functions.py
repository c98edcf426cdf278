"""Closed-form cases of the scalar functions, the rules, and the small numeric operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.functions import dates, text
from cairn.operators import distance, pairwise, rules


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_geo(spark):
    got = column(spark, ["", "Pakistan", "Pakistan:", "Pakistan: Sindh", "Pakistan: Sindh, Karachi", None], text.geo)
    assert [(g.country, g.admin1, g.locality, g.basis) for g in got] == [
        ("", "", "", "no_geography_deposited"),
        ("Pakistan", "", "", "no_admin1_deposited"),
        ("Pakistan", "", "", "no_admin1_deposited"),
        ("Pakistan", "Sindh", "", "admin1_only"),
        ("Pakistan", "Sindh", "Sindh, Karachi", "deposited_locality"),
        ("", "", "", "no_geography_deposited"),
    ]


def test_dates(spark):
    got = column(spark, ["06-Jul-1909", "1909-07-06", "2014/2015", "Oct-2010", "2010-10", "1999", "", ">2013", None], dates.normalized)
    assert [(g.iso, g.precision) for g in got] == [("1909-07-06", "day"), ("1909-07-06", "day"), ("2014", "range"), ("2010-10", "month"), ("2010-10", "month"), ("1999", "year"), ("", "NA"), ("", "NA"), ("", "NA")]


def test_types(spark):
    got = column(spark, ["Human poliovirus 1", "Human poliovirus 30/ROU/2008", "Coxsackievirus A24", "Echovirus 30", "Enterovirus J115", ""], text.virus_type)
    assert got == ["PV1", "", "CVA24", "E30", "", ""]


def test_collapse(spark):
    assert column(spark, ["  a \t b\n\nc ", None, " x"], text.collapse) == ["a b c", "", " x"]
    assert column(spark, [" x  y"], lambda c: text.collapse(c, unicode=True)) == ["x y"]


def catalog(**changes):
    return [{"rule_id": "R-ONE", "rule_version": "1.0.0", "field_name": "one", "description": "at least 5", "implementation": "one", "parameters": {"least": "5"}, "status": "active"} | changes]


def registry():
    r = rules.Registry()

    @r.rule("one", parameters=["least"], bases=["measured"])
    def one(p):
        return rules.ladder((F.col("n") >= int(p["least"]), rules.decide(F.col("n"), "measured", "n", F.col("n"))), otherwise=rules.decline("too few", "n", F.col("n")))

    return r


def test_rules_decide_or_decline(spark):
    df = spark.createDataFrame([(1, 4), (2, 5)], "k int, n int")
    bound = registry().bind(catalog())
    rows = rules.project(df, bound, "k")
    assert sorted((r.k, r.canonical_field, r.final_value, r.winning_rule_id, r.unresolved_reason) for r in rows.collect()) == [(1, "one", "", "R-ONE", "too few"), (2, "one", "5", "R-ONE", "")]
    assert rules.violations(rows, bound, "k").count() == 0
    assert sorted((r.k, r.one) for r in rules.widen(rows, "k", ["one"]).collect()) == [(1, ""), (2, "5")]


@pytest.mark.parametrize("bad", [{"implementation": "two"}, {"rule_id": "one"}, {"parameters": {}}, {"description": "silent"}, {"rule_version": "1"}])
def test_catalog_must_match_code(bad):
    with pytest.raises(ValueError):
        registry().bind(catalog(**bad))


def test_nothing_bound_is_refused():
    with pytest.raises(ValueError):
        registry().bind([])


def test_neighbor_joining_recovers_an_additive_tree():
    tips = np.array([[0, 5, 9, 9, 8], [5, 0, 10, 10, 9], [9, 10, 0, 8, 7], [9, 10, 8, 0, 3], [8, 9, 7, 3, 0]], float)
    edges = distance.neighbor_joining(tips)
    assert len(edges) == 2 * 5 - 3
    near = {}
    for p, c, x in edges:
        near.setdefault(p, []).append((c, x))
        near.setdefault(c, []).append((p, x))

    def paths(start):
        seen, stack = {start: 0.0}, [start]
        while stack:
            v = stack.pop()
            for w, x in near[v]:
                if w not in seen:
                    seen[w] = seen[v] + x
                    stack.append(w)
        return [seen[i] for i in range(5)]

    assert np.allclose([paths(i) for i in range(5)], tips)
    rooted = distance.midpoint_root(edges)
    assert len(rooted) == 8 and {c for _, c, _ in rooted} >= set(range(5))


def test_scaling_and_comparable_sets():
    x = np.array([[0.0, 0], [3, 0], [0, 4], [3, 4]])
    d = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    coords, explained, negative = distance.scale(d)
    assert np.allclose(np.sqrt(((coords[:, None] - coords) ** 2).sum(2)), d) and explained > 0.999 and negative < 1e-9
    assert np.allclose(distance.place(d, d, coords), coords)
    d[0, 3] = d[3, 0] = np.nan
    assert distance.comparable_set(d, [0], 4) == [0, 1, 2]


def test_pairwise_alignment():
    assert pairwise.align("ACGTACGT", "ACGTACGT")[0] == 16
    score, runs = pairwise.align("ACGT", "TTACGTTT")
    assert (score, *pairwise.gapped("ACGT", "TTACGTTT", runs)) == (8, "--ACGT--", "TTACGTTT")
    assert pairwise.align("", "AC") == (0, []) and pairwise.gapped("", "AC", []) == ("--", "AC")
