"""Comparable sets, classical scaling and neighbor joining.

A full matrix is built of landmarks only: means of groups, summed by Spark over all rows, of which there
are at most MAX_LANDMARKS.  All other rows are placed among them where they lie.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: fixed value: landmarks of a full matrix
MAX_LANDMARKS = 1500


def masked_distances(x: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Share of differing columns among those both rows can read (code > 0), NaN below `floor` of them; and their number."""
    readable = (x > 0).astype(np.float64)
    shared = readable @ readable.T
    equal = sum((m := (x == code).astype(np.float64)) @ m.T for code in np.unique(x[x > 0]))
    return np.where(shared >= floor, 1 - equal / np.maximum(shared, 1), np.nan), shared


def comparable_set(d: np.ndarray, required: list[int], cap: int) -> list[int]:
    """Greedily, rows that can all be compared with each other: required first, then by degree."""
    ok = ~np.isnan(d)
    order = required + [i for i in np.lexsort((np.arange(len(d)), -ok.sum(1))) if i not in required]
    chosen: list[int] = []
    for i in order:
        if len(chosen) < cap and all(ok[i, j] for j in chosen):
            chosen.append(int(i))
    return sorted(chosen)


def double_center(d: np.ndarray) -> np.ndarray:
    s = d * d
    return -0.5 * (s - s.mean(0) - s.mean(1)[:, None] + s.mean())


def scale(d: np.ndarray, axes: int = 2) -> tuple[np.ndarray, float, float]:
    """Coordinates by classical scaling, the share they explain, and the share of negative eigenvalues.

    Axes point so that the first row has no positive coordinate.
    """
    values, vectors = np.linalg.eigh(double_center(d))
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    coords = vectors[:, :axes] * np.sqrt(np.maximum(values[:axes], 0))
    coords *= np.where(coords[0] > 0, -1, 1)
    total = np.abs(values).sum() or 1.0
    return coords, float(np.maximum(values[:axes], 0).sum() / total), float(-np.minimum(values, 0).sum() / total)


def place(d_new: np.ndarray, d: np.ndarray, coords: np.ndarray) -> np.ndarray:
    """Further rows in the space of landmarks, from their distances to these; what is unknown is taken as typical."""
    typical = np.nanmean(d_new, axis=0)
    s = np.where(np.isnan(d_new), typical, d_new) ** 2
    centered = -0.5 * (s - (d * d).mean(0))
    centered -= centered.mean(1)[:, None]
    norms = (coords * coords).sum(0)
    return centered @ coords / np.where(norms > 0, norms, 1)


def neighbor_joining(d: np.ndarray) -> list[tuple[int, int, float]]:
    """Edges (parent, child, length) of the unrooted tree; ties go to the first pair row by row."""
    n = len(d)
    if n < 3:
        return [(0, 1, float(d[0, 1]))] if n == 2 else []
    d = d.astype(float).copy()
    nodes, edges, new = list(range(n)), [], n
    while len(nodes) > 3:
        m = len(nodes)
        r = d.sum(1)
        q = (m - 2) * d - r[:, None] - r
        q[np.tril_indices(m)] = np.inf
        i, j = np.unravel_index(int(q.argmin()), q.shape)
        li = 0.5 * d[i, j] + (r[i] - r[j]) / (2 * (m - 2))
        edges += [(new, nodes[i], float(li)), (new, nodes[j], float(d[i, j] - li))]
        row = 0.5 * (d[i] + d[j] - d[i, j])
        keep = [k for k in range(m) if k not in (i, j)]
        d = np.vstack([np.column_stack([d[np.ix_(keep, keep)], row[keep]]), np.append(row[keep], 0)])
        nodes = [nodes[k] for k in keep] + [new]
        new += 1
    a, b, c = d[0, 1], d[0, 2], d[1, 2]
    for node, length in zip(nodes, ((a + b - c) / 2, (a + c - b) / 2, (b + c - a) / 2), strict=True):
        edges.append((new, node, float(length)))
    return edges


def clamp(edges: list[tuple[int, int, float]]) -> tuple[list[tuple[int, int, float]], int, float]:
    """Edges without negative lengths; how many there were, and their total."""
    low = [x for _, _, x in edges if x < 0]
    return [(p, c, max(0.0, x)) for p, c, x in edges], len(low), -sum(low)


def midpoint_root(edges: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """The tree rooted halfway between the two farthest tips; the root is a new node, edges lead away from it."""
    near: dict[int, list[tuple[int, float]]] = {}
    for p, c, x in edges:
        near.setdefault(p, []).append((c, x))
        near.setdefault(c, []).append((p, x))

    def farthest(start: int) -> tuple[int, dict[int, tuple[int, float]]]:
        seen, stack, best = {start: (-1, 0.0)}, [start], start
        while stack:
            v = stack.pop()
            for w, x in sorted(near[v], reverse=True):
                if w not in seen:
                    seen[w] = (v, seen[v][1] + x)
                    stack.append(w)
        for v in sorted(seen):
            if seen[v][1] > seen[best][1]:
                best = v
        return best, seen

    a, _ = farthest(min(near))
    b, seen = farthest(a)
    half, v = seen[b][1] / 2, b
    while seen[v][0] >= 0 and seen[seen[v][0]][1] > half:
        v = seen[v][0]
    top, root = seen[v][0], max(near) + 1
    if top < 0:
        return edges
    lower = seen[v][1] - half
    out, stack, done = [(root, v, lower), (root, top, half - seen[top][1])], [v, top], {v, top}
    cut = {v, top}
    while stack:
        x = stack.pop()
        for w, length in near[x]:
            if w not in done and not {x, w} == cut:
                done.add(w)
                out.append((x, w, length))
                stack.append(w)
    return out


def ladder_layout(edges: list[tuple[int, int, float]]) -> dict[int, tuple[float, float, int]]:
    """x (distance from the root), y (tips in ladder order) and size of each node; smaller subtrees first."""
    children: dict[int, list[tuple[int, float]]] = {}
    for p, c, x in edges:
        children.setdefault(p, []).append((c, x))
    root = ({p for p, _, _ in edges} - {c for _, c, _ in edges}).pop()
    order, stack = [], [root]
    x = {root: 0.0}
    while stack:
        v = stack.pop()
        order.append(v)
        for c, length in children.get(v, []):
            x[c] = x[v] + length
            stack.append(c)
    size: dict[int, int] = {}
    for v in reversed(order):
        size[v] = sum(size[c] for c, _ in children.get(v, [])) or 1
    y: dict[int, float] = {}
    stack, at = [root], 0
    walk = []
    while stack:
        v = stack.pop()
        walk.append(v)
        if v not in children:
            y[v], at = float(at), at + 1
        for c, _ in sorted(children.get(v, []), key=lambda e: (size[e[0]], e[0]), reverse=True):
            stack.append(c)
    for v in reversed(walk):
        if v in children:
            ys = [y[c] for c, _ in children[v]]
            y[v] = (min(ys) + max(ys)) / 2
    return {v: (x[v], y[v], size[v]) for v in walk}


def means(rows: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, i, x): the mean of each dimension of each group's vectors."""
    return rows.select(group, F.posexplode(vector).alias("i", "v")).groupBy(group, "i").agg(F.avg(F.col("v").cast("double")).alias("x"))


def landmarks(rows: DataFrame, group: str, vector: str) -> tuple[list, np.ndarray]:
    """Groups in order and their mean vectors: Spark sums all rows, at most MAX_LANDMARKS means come to the driver.

    Beyond that many groups, those with the most rows are landmarks.
    """
    covered = rows.filter(F.col(group).isNotNull()).groupBy(group).count().orderBy(F.desc("count"), group).limit(MAX_LANDMARKS)
    packed = means(rows, group, vector).join(F.broadcast(covered), group).groupBy(group).agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
    got = packed.orderBy(group).collect()
    return [r[0] for r in got], np.array([[p["x"] for p in r["v"]] for r in got])


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine distances of the rows of x and those of y, round-off below 1e-12 taken as none."""
    unit = lambda z: z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    d = np.maximum(0, 1 - unit(x) @ unit(y).T)
    return np.where(d < 1e-12, 0, d)
