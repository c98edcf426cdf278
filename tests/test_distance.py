"""Trees and scaling on small data, against sums over paths and plain geometry."""

import itertools
import random

import numpy as np
import pytest

from cairn.operators import distance


def paths(edges, tips):
    """Length of the way between every two tips of a tree."""
    near = {}
    for p, c, x in edges:
        near.setdefault(p, []).append((c, x))
        near.setdefault(c, []).append((p, x))
    out = np.zeros((tips, tips))
    for a in range(tips):
        seen, stack = {a: 0.0}, [a]
        while stack:
            v = stack.pop()
            for w, x in near[v]:
                if w not in seen:
                    seen[w] = seen[v] + x
                    stack.append(w)
        out[a] = [seen[b] for b in range(tips)]
    return out


def additive(n, seed):
    """A random tree of n tips, and the lengths of its paths."""
    rng = random.Random(seed)
    edges, open_, new = [], list(range(n)), n
    while len(open_) > 2:
        a, b = (open_.pop(rng.randrange(len(open_))) for _ in range(2))
        edges += [(new, a, rng.uniform(0.1, 2)), (new, b, rng.uniform(0.1, 2))]
        open_.append(new)
        new += 1
    edges.append((open_[0], open_[1], rng.uniform(0.1, 2)))
    return paths(edges, n)


@pytest.mark.parametrize("n", [2, 3, 4, 5, 12, 40])
def test_neighbor_joining_recovers_an_additive_matrix(n):
    d = additive(n, n)
    edges = distance.neighbor_joining(d)
    assert len(edges) == 2 * n - 3 and np.allclose(paths(edges, n), d)


def test_all_ties_give_the_same_tree_each_time():
    d = 1.0 - np.eye(9)
    assert distance.neighbor_joining(d) == distance.neighbor_joining(d.copy())
    assert len(distance.neighbor_joining(d)) == 15


@pytest.mark.parametrize("n", [3, 6, 20])
def test_the_root_is_halfway_between_the_farthest_tips(n):
    d = additive(n, n + 1)
    rooted = distance.midpoint_root(distance.neighbor_joining(d))
    assert np.allclose(paths(rooted, n), d)
    at = distance.ladder_layout(rooted)
    root = ({p for p, _, _ in rooted} - {c for _, c, _ in rooted}).pop()
    depth = [at[i][0] for i in range(n)]
    assert np.isclose(max(depth), d.max() / 2) and at[root][2] == n
    assert sorted(at[i][1] for i in range(n)) == list(range(n))


def test_negative_lengths_are_clamped_and_counted():
    assert distance.clamp([(4, 0, -0.5), (4, 1, 1.0), (4, 2, -0.25)]) == ([(4, 0, 0.0), (4, 1, 1.0), (4, 2, 0.0)], 2, 0.75)


def test_scaling_of_points_in_a_plane_gives_their_distances_and_places():
    x = np.random.default_rng(1).normal(size=(25, 2))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    coords, explained, negative = distance.scale(d)
    again = np.sqrt(((coords[:, None] - coords[None]) ** 2).sum(-1))
    assert np.allclose(again, d) and np.isclose(explained, 1) and negative < 1e-9 and (coords[0] <= 0).all()
    more = np.random.default_rng(2).normal(size=(10, 2))
    far = np.sqrt(((more[:, None] - x[None]) ** 2).sum(-1))
    placed = distance.place(far, d, coords)
    assert np.allclose(np.sqrt(((placed[:, None] - coords[None]) ** 2).sum(-1)), far)


def test_centering_takes_away_all_means():
    d = additive(8, 3)
    b = distance.double_center(d)
    assert np.allclose(b.sum(0), 0) and np.allclose(b.sum(1), 0)
    assert all(np.isclose(b[i, i] + b[j, j] - 2 * b[i, j], d[i, j] ** 2) for i, j in itertools.combinations(range(8), 2))
