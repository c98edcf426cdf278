"""Global alignment of two texts with affine gaps and free ends, as runs of letters without a gap.

A run (r, q, n) says that n letters from r on in the first text stand under n letters from q on in the
second, counted from 0.  Scores are whole numbers and only two rows of them are kept; each cell leaves one byte, by
which the way back is read run by run.  Cells outside a band of diagonals are not filled: the band holds all
diagonals on which two seeds or more agree, and a margin.  Texts without common seeds are compared in full.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: letters beyond either end of a seeded overlap that an alignment may use
MARGIN = 20
#: diagonals beyond those of common seeds that a band holds
BAND_MARGIN = 64
#: texts of more letter pairs than this, and no seed in common, are compared near their main diagonals
MOST_CELLS = 100_000_000
DIAG, DOWN, RIGHT, STOP, DOWN_ON, RIGHT_ON = 0, 1, 2, 3, 4, 8
LOW = -(1 << 40)

# BLOSUM62, lower triangle in the order of RESIDUES, then X with each residue and itself.
RESIDUES = "ARNDCQEGHILKMFPSTWYV"
BLOSUM62 = """
 4
-1  5
-2  0  6
-2 -2  1  6
 0 -3 -3 -3  9
-1  1  0  0 -3  5
-1  0  0  2 -4  2  5
 0 -2  0 -1 -3 -2 -2  6
-2  0  1 -1 -3  0  0 -2  8
-1 -3 -3 -3 -1 -3 -3 -4 -3  4
-1 -2 -3 -4 -1 -2 -3 -4 -3  2  4
-1  2  0 -1 -3  1  1 -2 -1 -3 -2  5
-1 -1 -2 -3 -1  0 -2 -3 -2  1  2 -1  5
-2 -3 -3 -3 -2 -3 -3 -3 -1  0  0 -3  0  6
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4  7
 1 -1  1  0 -1  0  0  0 -1 -2 -2  0 -1 -2 -1  4
 0 -1  0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1  1  5
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1  1 -4 -3 -2 11
-2 -2 -2 -3 -2 -1 -2 -3  2 -1 -1 -2 -1  3 -3 -2 -2  2  7
 0 -3 -3 -3 -1 -2 -2 -3 -3  3  1 -2  1 -1 -2 -2  0 -3 -1  4
 0 -1 -1 -1 -2 -1 -1 -1 -1 -1 -1 -1 -1 -1 -2  0  0 -2 -1 -1 -1
"""
#: what a stop scores with any residue, and with a stop
STOP_SCORES = (-4, 1)


@dataclass(frozen=True)
class Scheme:
    """Scores of an alignment: of two letters (by table if there is one), of a gap's first and each further letter; and the seed length of bands."""

    match: int
    mismatch: int
    open: int
    extend: int
    seed: int
    table: np.ndarray | None = None

    def codes(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return codes if self.table is None else np.minimum(codes, 127)

    def row(self, letter: int, others: np.ndarray) -> np.ndarray:
        return np.where(others == letter, self.match, self.mismatch) if self.table is None else self.table[letter][others]


def _residue_table() -> np.ndarray:
    x = len(RESIDUES)
    rows = [[int(v) for v in line.split()] for line in BLOSUM62.strip().splitlines()]
    square = np.zeros((x + 1, x + 1), np.int64)
    for i, row in enumerate(rows):
        square[i, : i + 1] = square[: i + 1, i] = row
    of_letter = np.array([RESIDUES.index(chr(c)) if chr(c) in RESIDUES else x for c in range(128)])
    table = square[of_letter][:, of_letter]
    table[ord("*")] = table[:, ord("*")] = STOP_SCORES[0]
    table[ord("*"), ord("*")] = STOP_SCORES[1]
    return table


NUCLEOTIDES = Scheme(match=2, mismatch=-1, open=-50, extend=-10, seed=12)
PROTEINS = Scheme(match=0, mismatch=0, open=-11, extend=-1, seed=5, table=_residue_table())


def common_seeds(a: str, b: str, k: int) -> np.ndarray:
    """The diagonal (place in b less place in a) of each k letters that stand once in either text and agree."""
    once: dict[str, int] = {}
    for i in range(len(a) - k + 1):
        s = a[i : i + k]
        once[s] = -1 if s in once else i
    met: dict[str, int] = {}
    for j in range(len(b) - k + 1):
        s = b[j : j + k]
        if once.get(s, -1) >= 0:
            met[s] = -1 if s in met else j
    return np.array([j - once[s] for s, j in met.items() if j >= 0], np.int64)


def band(a: str, b: str, scheme: Scheme) -> tuple[int, int]:
    """Lowest and highest diagonal that an alignment of the two texts may use."""
    n, m = len(a), len(b)
    diagonals, votes = np.unique(common_seeds(a, b, scheme.seed), return_counts=True)
    held = diagonals[votes > 1]
    if len(held):
        return max(-n, int(held.min()) - BAND_MARGIN), min(m, int(held.max()) + BAND_MARGIN)
    if n * m <= MOST_CELLS:
        return -n, m
    width = max(BAND_MARGIN, MOST_CELLS // max(n, m) // 2)
    return max(-n, min(0, m - n) - width), min(m, max(0, m - n) + width)


def align(a: str, b: str, scheme: Scheme = NUCLEOTIDES, within: tuple[int, int] | None = None) -> tuple[int, list[tuple[int, int, int]]]:
    """Best score and its runs.  Of equal ways the one with letters under each other goes first, then a gap in b."""
    n, m = len(a), len(b)
    if not n or not m:
        return 0, []
    lo, hi = within or band(a, b, scheme)
    width = hi - lo + 1
    x, y = scheme.codes(a), scheme.codes(b)
    # columns of the band at row i are those of diagonals lo to hi: b's letters, padded where the band leaves the text
    padded = np.zeros(n + width + m + 2, np.int64)
    at = max(0, -(lo + 1)) + 1
    padded[at : at + m] = y  # padded[at + j] is letter j of b
    steps = scheme.extend * np.arange(width, dtype=np.int64)
    places = np.arange(width) + lo
    moves = np.full((n + 1, width), STOP, np.uint8)
    best = np.where((places >= 0) & (places <= m), 0, LOW)
    down = np.full(width, LOW)
    ends = [(int(best[m - lo]), 0, m - lo)] if lo <= m <= hi else []
    for i in range(1, n + 1):
        first, last = max(0, 1 - i - lo), min(width, m + 1 - i - lo)  # columns with 1 <= j <= m
        up = np.append(best[1:], LOW)
        opened = up + scheme.open
        down = np.maximum(opened, np.append(down[1:], LOW) + scheme.extend)
        flags = np.where(down != opened, DOWN_ON, 0).astype(np.uint8)
        begin = at + i + lo - 1 + first
        score = np.full(width, LOW)
        if first < last:
            score[first:last] = best[first:last] + scheme.row(x[i - 1], padded[begin : begin + last - first])
        cell = np.maximum(score, down)
        cell[:first] = LOW
        cell[last:] = LOW
        if -lo >= i and -i - lo < width:
            cell[-i - lo] = 0  # the border: no letter of b yet
        run = np.maximum.accumulate(cell - steps)
        right = np.append(LOW, run[:-1] + steps[:-1] + scheme.open)
        new = np.maximum(cell, right)
        new[last:] = LOW
        flags[1:] |= np.where(right[1:] != new[:-1] + scheme.open, RIGHT_ON, 0).astype(np.uint8)
        source = np.where(new == score, DIAG, np.where(new == down, DOWN, RIGHT)).astype(np.uint8)
        moves[i, first:last] = source[first:last] | flags[first:last]
        best = new
        if first < last and last - 1 + i + lo == m:
            ends.append((int(best[last - 1]), i, last - 1))
    row = [(int(best[k]), n, int(k)) for k in np.flatnonzero((places + n >= 0) & (places + n <= m))]
    score, i, k = max(ends + row, key=lambda e: (e[0], 2 * e[1] + e[2]))
    return score, _runs(moves, i, k, lo)


def _runs(moves: np.ndarray, i: int, k: int, lo: int) -> list[tuple[int, int, int]]:
    """The runs on the way back from a cell, read a run or a gap at a time."""
    width, flat, out = moves.shape[1], moves.ravel(), []

    def count(path: np.ndarray, on: np.ndarray) -> int:
        return int(np.argmin(on)) if not on.all() else len(path)

    while i > 0 and i + k + lo > 0:
        kind = moves[i, k] & 3
        if kind == DIAG:
            path = moves[i::-1, k]
            n = count(path, (path & 3) == DIAG)
            i -= n
            out.append((i, i + k + lo, n))
        elif kind == DOWN:
            path = flat[i * width + k :: -(width - 1)] if width > 1 else flat[i::-1]
            path = path[: min(i, width - 1 - k) + 1]
            n = count(path, (path & DOWN_ON) > 0) + 1
            i, k = i - n, k + n
        elif kind == RIGHT:
            path = moves[i, k::-1]
            k -= count(path, (path & RIGHT_ON) > 0) + 1
        else:
            break
    return out[::-1]


def gapped(a: str, b: str, runs: list[tuple[int, int, int]]) -> tuple[str, str]:
    """The two texts with gaps: letters of a before those of b where neither has a partner."""
    top, low, r0, q0 = [], [], 0, 0
    for r, q, n in [*runs, (len(a), len(b), 0)]:
        top += [a[r0:r], "-" * (q - q0), a[r : r + n]]
        low += ["-" * (r - r0), b[q0:q], b[q : q + n]]
        r0, q0 = r + n, q + n
    return "".join(top), "".join(low)
