import random
import re
import zlib
from collections import Counter
from itertools import product

import pyarrow as pa
from fixtures import DOCS, rows, table
from pyspark.sql import functions as F

from cairn.llm import spelling
from cairn.llm.scratch import Scratch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(docs):
    out = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    n = counts(docs)
    form, out = {}, []
    for w in n:
        near = sorted((-n[v], v) for v in n if one_apart(w, v))
        form[w] = (near[0][1] if near and -near[0][0] >= 10 * n[w] else None, len(near))
    for w in n:
        root = w
        while form[root][0] is not None:
            root = form[root][0]
        out.append((w, form[w][0], root, n[w], form[w][1], n.get(form[w][0])))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def letters(rng, n, alphabet="abcdeéÀ×ß"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def noisy(seed):
    rng = random.Random(seed)
    stems = [letters(rng, rng.randrange(6, 14)) for _ in range(40)]
    docs = []
    for i in range(150):
        words = []
        for _ in range(rng.randrange(0, 200)):
            w = stems[min(int(rng.expovariate(0.15)), len(stems) - 1)]
            if rng.random() < 0.3:
                p = rng.randrange(len(w) + 1)
                w = rng.choice([w[:p] + w[p + 1 :], w[:p] + rng.choice("xyzé") + w[p:], w[:p] + rng.choice("xyz") + w[p + 1 :]])
            words.append(w.upper() if rng.random() < 0.2 else w)
        docs.append((i, rng.choice([" ", "1", "\n", "–"]).join(words), "en", "a", 0))
    return docs


def test_equals_brute_force_with_nulls_and_clashing_columns(spark):
    data = noisy(1) + rows(2, 20)
    data += [(None, "Schreibung Schreibungen " * 20, "de", None, 0)] * 2 + [data[3]] * 3
    docs = table(spark, data, word="clash", n="clash", sig="clash", form="clash")
    assert got(spelling.variants(docs)) == brute([r[:2] for r in data])


def test_ties_chains_and_long_words(spark):
    text = "abcdefgh " * 3 + "abcdefgx " * 40 + "abcdefxx " * 500 + "bbcdefgx " * 400 + "bbcdefxx " * 5000 + ("q" * 20_000 + " ") * 30 + ("q" * 20_001 + " ") * 2
    data = [(1, text, "en", "a", 0), (2, None, "en", "a", 0), (3, "", "en", "a", 0)]
    assert got(spelling.variants(spark.createDataFrame(data, DOCS))) == brute([r[:2] for r in data])
    assert spelling.variants(spark.createDataFrame([], DOCS)).count() == 0


def test_crowded_signatures_lose_no_pair(spark):
    """All words of eight letters a or b with four of each: one signature for many words, and their neighbours."""
    words = ["".join(w) for w in product("ab", repeat=9) if w.count("a") in (4, 5)] + ["ab" * 50_000, "ab" * 50_000 + "a"]
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    pairs = {(r.a, r.b) for r in spelling.near_words(df, Scratch(spark, "test")).collect()}
    short = words[:-2]
    want = {(a, b) for a in short for b in short if a < b and one_apart(a, b)} | {(words[-2], words[-1])}
    assert len(words) > 2 * spelling.CROWD and pairs == want


def test_near_words_share_a_signature():
    rng = random.Random(4)
    for _ in range(300):
        w = letters(rng, rng.randrange(1, 20))
        p = rng.randrange(len(w))
        for v in (w[:p] + w[p + 1 :], w[:p] + "é" + w[p:], w[:p] + "z" + w[p + 1 :]):
            a, b = spelling.signatures(pa.array([w, v]))
            assert (a == b).any()


def test_rests_are_those_of_shorter_words():
    words = ["abcaé", "z", "aab", "", "qrstuvwx"]
    own_of = lambda w: int(spelling.rests(pa.array([w]))[4][0])
    owner, place, differs, rest, own = spelling.rests(pa.array(words))
    assert [(int(o), int(p), int(r)) for o, p, r in zip(owner, place, rest)] == [(o, p, own_of(w[:p] + w[p + 1 :])) for o, w in enumerate(words) for p in range(len(w))]
    assert own.tolist() == [own_of(w) for w in words]
    assert [bool(d) for d in differs] == [p + 1 == len(w) or w[p] != w[p + 1] for w in words for p in range(len(w))]


def test_counts_do_not_depend_on_partitions(spark):
    docs = spark.createDataFrame(noisy(5), DOCS)
    assert got(spelling.word_counts(docs.repartition(7))) == got(spelling.word_counts(docs.coalesce(1))) == sorted(counts([(r.doc_id, r.text) for r in docs.select("doc_id", F.col("text")).collect()]).items())
