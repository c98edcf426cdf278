"""Measures of both strands against a second way written letter by letter."""

import random
from collections import Counter

from cairn.functions.blocks import AMINO_ACIDS
from cairn.operators import evidence as E

CODE = {a + b + c: AMINO_ACIDS[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}


def turned(x):
    return x.translate(str.maketrans("ACGTN", "TGCAN"))[::-1]


def diagonal(ref, q, lo, hi):
    votes = Counter()
    for i in range(len(q) - 11):
        for f in range(max(lo, 0), min(hi, len(ref) - 11)):
            if ref[f : f + 12] == q[i : i + 12]:
                votes[f - i] += 1
    d, n = votes.most_common(1)[0] if votes else (None, 0)
    return d if n >= 5 else None


def even(chunks, whole):
    return len(chunks) >= 2 and all(abs(c - whole) <= 15 for c in chunks)


def letters(ref, q, lo, hi, wide):
    best = None
    for strand, t in (("+", q), ("-", turned(q))):
        d = diagonal(ref, t, lo, hi)
        if d is None:
            continue
        first, last = max(lo, d), min(hi, len(ref), len(t) + d)
        n = bad = 0
        rates = []
        for s in range(first, last, 150):
            pairs = [(ref[p], t[p - d]) for p in range(s, min(s + 150, last)) if not wide or ref[p] in "ACGT" and t[p - d] in "ACGT"]
            wrong = sum(a != b for a, b in pairs)
            n, bad = n + len(pairs), bad + wrong
            rates += [wrong * 100 / len(pairs)] if len(pairs) >= 30 else []
        if n < 50 or best and n <= best[1] or bad * 100 / n > 40 or (wide or n < 300) and not even(rates, bad * 100 / n):
            continue
        best = (bad * 100 / n, n, strand)
    return best


def residues(ref, q, lo, hi):
    best = None
    for strand, t in (("+", q), ("-", turned(q))):
        d = diagonal(ref, t, lo, hi)
        if d is None:
            continue
        first, last = max(lo, d), min(hi, len(ref), len(t) + d)
        pairs = [(CODE.get(ref[p : p + 3]), CODE.get(t[p - d : p - d + 3])) for p in range(first + -(first - lo) % 3, last - 2, 3)]
        pairs = [p for p in pairs if None not in p]
        if pairs:
            far = sum(a != b for a, b in pairs) * 100 / len(pairs)
            if far <= 40 and (best is None or (far, -len(pairs)) < (best[0], -best[1])):
                best = (far, len(pairs), strand)
    return best


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def mutated(rng, x, rate):
    return "".join(rng.choice("ACGTN") if rng.random() < rate else c for c in x)


def references(rng, n=3):
    base = dna(rng, 1100)
    return [(i, mutated(rng, base, 0.12 * i).replace("N", "A"), 620 + i, 1003 + i, 80 + i) for i in range(n)]


def records(rng, refs):
    out = []
    for i in range(70):
        ref = refs[i % len(refs)]
        lo = rng.choice((0, 100, 600, 700, 900))
        x = mutated(rng, ref[1][lo : lo + rng.choice((60, 180, 260, 500, 1000))], rng.choice((0, 0.02, 0.1, 0.3)))
        if i % 6 == 5:  # one letter too many spoils what is behind it
            x = x[: len(x) // 2] + "A" + x[len(x) // 2 :]
        x = turned(x) if i % 4 == 3 else x
        out.append((f"v{i}", ref[0], x.lower() if i % 5 == 0 else x, i % 7 == 0))
    return [*out, ("none", 0, None, False), ("empty", 0, "", False), ("far", 0, dna(rng, 900), False), ("lost", 99, refs[0][1], False)]


SCHEMA = "version string, ref_id int, sequence string, by_band boolean"
REF = "ref_id int, reference string, region_lo int, region_hi int, wide_lo int"


def test_the_region_first_and_the_wide_one_else(spark):
    rng = random.Random(3)
    refs = references(rng)
    rows = records(rng, refs)
    got = {r.version: (round(r.percent, 9), r.compared, r.strand, r.basis) for r in E.measure_evidence(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(refs, REF)).collect()}
    want = {}
    for version, i, x, band in rows:
        if x is None or i == 99:
            continue
        _, ref, lo, hi, wide = refs[i]
        near = letters(ref, x.upper(), lo, hi, False)
        m, kind = (near, E.REGION) if near else (letters(ref, x.upper(), wide, hi, True), E.WIDE)
        if m:
            want[version] = (round(m[0], 9), m[1], m[2], E.BY_BAND[kind] if band else kind)
    assert got == want
    assert {w[2] for w in want.values()} == {"+", "-"} and {w[3] for w in want.values()} == {E.REGION, E.WIDE, *E.BY_BAND.values()}
    assert len(want) < len(rows) - 4


def test_the_nearest_reference_in_residues(spark):
    rng = random.Random(4)
    refs = references(rng)
    rows = records(rng, refs)
    got = {r.version: (r.ref_id, round(r.percent, 9), r.codons, r.strand) for r in E.nearest_reference(spark.createDataFrame([(v, x) for v, _, x, _ in rows], "version string, sequence string"), spark.createDataFrame(refs, REF)).collect()}
    want = {}
    for version, _, x, _ in rows:
        found = [(m[0], -m[1], i, m[2]) for i, ref, _, hi, wide in refs if x and (m := residues(ref, x.upper(), wide, hi))]
        if found:
            far, n, i, strand = min(found)
            want[version] = (i, round(far, 9), -n, strand)
    assert got == want and len(want) > 30


def test_a_short_region_is_guarded_and_a_long_one_is_not(spark):
    rng = random.Random(5)
    ref = dna(rng, 1200)
    spoilt = lambda n: ref[100 : 100 + n // 2] + dna(rng, n - n // 2)
    rows = [("short", 1, spoilt(280)[:280], False), ("one chunk", 1, ref[100:160], False), ("long", 1, ref[100 : 100 + 300] + mutated(rng, ref[400:520], 0.9), False)]
    got = {r.version: r.basis for r in E.measure_evidence(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(1, ref, 100, 1100, 100)], REF)).collect()}
    assert got == {"long": E.REGION}
