import random

from fixtures import DOCS, rows, table, words

from cairn.llm import neardup


def shingles(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    w = ["".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in v) for v in text.split(" ") if v]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(data):
    """All pairs, and the smallest doc_id that each reaches."""
    sets = {}
    for i, t, *_ in data:
        s = shingles(t or "")
        if i is not None and len(s) >= len(sets.get(i, ())):
            sets[i] = s
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sorted((i, len(sets[i]), label[i]) for i in sets)


def held(spark, data):
    got = neardup.near_duplicates(table(spark, data, n="clash", c="clash", rep="clash")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(data)


def test_brute_force(spark):
    rng = random.Random(8)
    data = rows(7, 20)
    for g in range(12):
        w = words(rng, 60 + 10 * g, 10_000).split(" ")
        for k in range(6):
            v = list(w)
            for j in range(k):
                v[(7 * j + 3 * g) % len(v)] = f"edit{g}x{j}"
            data.append((1000 + 10 * g + k, " ".join(v) + " end" * (k % 3), "en", "s", 0))
    held(spark, data)


def test_chain_and_threshold(spark):
    """Links at 0.75 exactly count; a chain of links is one component though its ends are far apart."""
    w = [f"v{i}" for i in range(400)]
    data = [(i, " ".join(w[4 * i : 4 * i + 44]), "en", "s", 0) for i in range(20)]
    data += [(100, " ".join(w[200:211]), "en", "s", 0), (101, " ".join(w[200:210] + ["other"]), "en", "s", 0), (102, "a b", "en", "s", 0), (103, "A  b", "en", "s", 0)]
    held(spark, data)


def test_keep_one_and_edges(spark):
    data = [*rows(9, 10), (None, "no id at all here and more", "en", "s", 0)]
    docs = table(spark, data, extra="x")
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    want = {i for i, _, c in brute(data) if i == c} | {None}
    assert {r.doc_id for r in kept.collect()} == want
    assert neardup.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
