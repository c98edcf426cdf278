from fixtures import DOCS, rows, table

from cairn.llm import mixing


def size(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return sum(bool(w) for w in text.split(" "))


def targets(sizes):
    """Water filling, one full source at a time."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * sizes[s]}
        for s in full or free:
            out[s] = 3.0 * sizes[s] if full else share[s]
            left -= out[s]
        free -= full or free
    return out


def check(spark, data):
    docs = table(spark, data, size="clash", target="clash", s="clash")
    got = mixing.mix(docs, ["doc_id", "source"]).collect()
    assert len(got) == len(data)
    sizes, taken, largest = {}, {}, {}
    for i, t, _, s, _ in data:
        sizes[s] = sizes.get(s, 0) + size(t or "")
        largest[s] = max(largest.get(s, 0), size(t or ""))
    want = targets(sizes)
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken in [k * r.size for k in range(4)]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    again = mixing.mix(docs.repartition(5), ["doc_id", "source"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_targets_and_budgets(spark):
    check(spark, rows(6, 60))


def test_small_sources_are_capped(spark):
    check(spark, [(i, "w " * (1 + i % 5), "en", "a" if i < 2 else "b" if i < 40 else None, 0) for i in range(60)])


def test_one_source_and_no_words(spark):
    check(spark, [(i, None if i % 2 else "", "en", "a", 0) for i in range(4)])
    check(spark, [(7, "a b c", "en", None, 0)] * 3)
    assert mixing.mix(spark.createDataFrame([], DOCS), ["doc_id"]).count() == 0
