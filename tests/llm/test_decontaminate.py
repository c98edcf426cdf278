import random

from fixtures import DOCS, rows, table, words
from oracle import of_duckdb  # noqa: F401

from cairn.llm import decontaminate as dec


def split(text):
    text = (text or "").lower()
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(data, bench):
    """Every alignment of every document and item, whether a seed finds it or not."""
    best = {}
    for i, t, *_ in data:
        d = split(t)
        for item, x in bench:
            b = split(x)
            if len(b) < 5:
                if b and b == d:
                    best[i, item] = (len(b), len(b), 0)
                continue
            for start in range(-len(b) + 1, len(d)):
                lo, hi = max(0, -start), min(len(b), len(d) - start)
                same = [d[start + j] == b[j] for j in range(lo, hi)]
                n = sum(same)
                local = max((sum(same[p : p + 16]) for p in range(max(1, len(same) - 15))), default=0)
                if n == len(b) if len(b) < 10 else n >= 10 and (4 * n >= 3 * len(same) or local >= 12):
                    best[i, item] = max(best.get((i, item), (0, 0, 0)), (n, len(same), -start))
    return sorted((i, item, -s, w, n) for (i, item), (n, w, s) in best.items())


def test_brute_force(spark):
    rng = random.Random(3)
    bench = [(k, words(rng, 15 + 5 * k)) for k in range(8)] + [(50, "too short"), (51, None), (52, words(rng, 5)), (53, words(rng, 9)), (54, words(rng, 11))]
    bench.append((55, bench[0][1]))
    data = [r for r in rows(11, 12) if len(r[1] or "") < 4000]
    for n, (k, t) in enumerate(bench[:8]):
        w = t.split(" ")
        changed = [x if (j + n) % 6 else x + "!" for j, x in enumerate(w)]
        data.append((500 + n, words(rng, 9) + " " + t.upper() + " " + words(rng, 9), "en", "s", 0))
        data.append((600 + n, words(rng, 3) + " " + " ".join(changed), "en", "s", 0))
        data.append((800 + n, words(rng, 30) + " " + " ".join(w[2:20]) + " " + words(rng, 40), "en", "s", 0))
        data.append((700 + n, " ".join(w[len(w) // 3 :]) + " x", "en", "s", 0))
    data += [(900 + n, words(rng, 7) + " " + bench[n][1] + " " + words(rng, 4), "en", "s", 0) for n in (10, 11, 12)]
    data += [(950, "  Too\nSHORT ", "en", "s", 0), (951, "too short indeed", "en", "s", 0), (952, "one " * 4 + "w" * 10_000, "en", "s", 0), (950, "too short", "en", "s", 0)]
    docs = table(spark, data, h="clash", i="clash", seed="clash", item_id="clash")
    items = spark.createDataFrame([*bench, bench[0]], "item_id long, text string")
    got = dec.overlaps(docs, items).collect()
    assert sorted(tuple(r) for r in got) == brute(data, bench)
    leaky = {r.doc_id for r in got}
    assert {500 + n for n in range(8)} <= leaky
    kept = dec.without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r[0]) for r in data if r[0] not in leaky)


def test_empty(spark):
    docs, none = table(spark, rows(1, 8)), spark.createDataFrame([], "item_id long, text string")
    assert dec.overlaps(docs, none).count() == 0
    assert dec.overlaps(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, words(random.Random(1), 30))], "item_id long, text string")).count() == 0


def test_by_shuffle_too(spark, monkeypatch):
    """The way beyond the broadcast bound gives the same rows."""
    text = words(random.Random(5), 30)
    docs, items = table(spark, [(1, "a b " + text, "en", "s", 0)]), spark.createDataFrame([(9, text)], "item_id long, text string")
    want = dec.overlaps(docs, items).collect()
    monkeypatch.setattr(dec, "BROADCAST_SEEDS", 0)
    assert dec.overlaps(docs, items).collect() == want and len(want) == 1


def test_recall_without_seeds(spark):
    """A quarter of the words substituted anywhere, in items of 14 to 40 words: all that verification accepts is found."""
    rng = random.Random(9)
    bench = [(k, " ".join(f"v{rng.randrange(10**6)}" for _ in range(14 + k % 27))) for k in range(120)]
    data = []
    for k, text in bench:
        w = text.split(" ")
        hit = set(range(k % 4, len(w), 4)) if k % 5 == 0 else set(rng.sample(range(len(w)), len(w) // 4))
        data.append((k, words(rng, 5) + " " + " ".join("x" if j in hit else x for j, x in enumerate(w)) + " " + words(rng, 5), "en", "s", 0))
    want = {(i, item) for i, item, *_ in brute(data, bench)}
    got = {(r.doc_id, r.item_id) for r in dec.overlaps(table(spark, data), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) >= 110
