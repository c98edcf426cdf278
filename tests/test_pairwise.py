"""Alignments against a plain three-matrix recurrence, and the runs against their own score."""

import random

import pytest

from cairn.operators import pairwise as P

CHEAP = P.Scheme(match=2, mismatch=-1, open=-3, extend=-1, seed=12)


def best_score(a, b, s):
    low = -(10**12)
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    down, right = ([[low] * (len(b) + 1) for _ in range(len(a) + 1)] for _ in range(2))
    x, y = s.codes(a), s.codes(b)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            down[i][j] = max(best[i - 1][j] + s.open, down[i - 1][j] + s.extend)
            right[i][j] = max(best[i][j - 1] + s.open, right[i][j - 1] + s.extend)
            best[i][j] = max(best[i - 1][j - 1] + int(s.row(x[i - 1], y[j - 1 : j])[0]), down[i][j], right[i][j])
    return max(best[-1] + [row[-1] for row in best])


def price(a, b, runs, s):
    x, y, total, at = s.codes(a), s.codes(b), 0, None
    for r, q, n in runs:
        if at:
            total += sum(s.open + (g - 1) * s.extend for g in (r - at[0], q - at[1]) if g)
        total += sum(int(s.row(x[r + i], y[q + i : q + i + 1])[0]) for i in range(n))
        at = r + n, q + n
    return total


@pytest.mark.parametrize(("scheme", "letters"), [(P.NUCLEOTIDES, "ACGT"), (P.PROTEINS, "ARNDCQEGX*"), (CHEAP, "ACG")])
def test_scores_and_runs(scheme, letters):
    rng = random.Random(1)
    for k in range(120):
        a, b = ("".join(rng.choice(letters) for _ in range(rng.randrange(0, 25))) for _ in range(2))
        b = a[3:9] + b[:4] + a[9:] if k % 3 == 0 else b
        score, runs = P.align(a, b, scheme)
        assert score == (best_score(a, b, scheme) if a and b else 0) == price(a, b, runs, scheme)
        x, y = P.gapped(a, b, runs)
        assert x.replace("-", "") == a and y.replace("-", "") == b and len(x) == len(y)


def test_a_band_finds_what_the_whole_matrix_finds():
    rng = random.Random(2)
    for _ in range(6):
        a = "".join(rng.choice("ACGT") for _ in range(900))
        b = "".join(x if rng.random() > 0.1 else rng.choice("ACGT") for x in a)
        b = b[rng.randrange(60) : 400] + b[400 + rng.choice((0, 3, 30)) : 700] + "ACG" * rng.randrange(3) + b[700:]
        lo, hi = P.band(a, b, P.NUCLEOTIDES)
        assert hi - lo < 500 and P.align(a, b) == P.align(a, b, within=(-len(a), len(b)))


def test_free_ends_and_dear_gaps():
    assert P.align("AAAACGTACGTTTT", "ACGTACG") == (14, [(3, 0, 7)])
    assert P.align("ACGT" * 20, "ACGT" * 10 + "ACGT" * 10)[1] == [(0, 0, 80)]
    left = "ACGTTGCAAGGCTTAACCGGATCGATTACA" * 2
    assert P.align(left + "GGGTTT" + left, left + left)[1] == [(0, 0, 60), (66, 60, 60)]


def test_the_residue_table():
    table, of = P.PROTEINS.table, ord
    assert (table == table.T).all()
    assert [table[of(a), of(b)] for a, b in ("WW", "CC", "AA", "WP", "DE", "IV", "X*", "**", "XA", "UX", "LK")] == [11, 9, 4, -4, 2, 3, -4, 1, 0, -1, -2]
