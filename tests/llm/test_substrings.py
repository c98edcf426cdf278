import hashlib

from fixtures import DOCS, rows, table

from cairn.llm import substrings


def brute(data):
    """By the definition: a byte goes if a 100-byte string over it also starts earlier."""
    docs = sorted({(-1 if i is None else i, t or "") for i, t, *_ in data})
    seen, out = set(), {}
    for key, text in docs:
        b = text.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[key, text] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted((i, *out[-1 if i is None else i, t or ""]) for i, t, *_ in data)


def held(spark, data, **extra):
    got = substrings.remove_repeats(table(spark, data, **extra)).drop("kept").collect()
    assert sorted(tuple(r) for r in got) == brute(data)


def test_brute_force(spark):
    data = rows(2, 24)
    base = data[3][1]
    # overlaps of all lengths around 100 bytes, at the ends of matches and within one text
    data += [(100 + k, f"x{k} " + (base * 3)[k : k + 90 + 3 * k] + f" y{k} " + (base * 3)[5 : 5 + 99 + k % 3], "en", "s", 0) for k in range(24)]
    held(spark, data, k="clash", t="clash", runs="clash")


def test_periodic_texts(spark):
    held(spark, [(1, "ab" * 400, "en", "s", 0), (2, "ba" * 90, "en", "s", 0), (3, "abc" * 200 + "ab" * 60, "en", "s", 0), (4, "z" * 99, "en", "s", 0), (5, "z" * 99, "en", "s", 0)])


def test_empty(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
