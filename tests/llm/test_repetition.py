from fixtures import DOCS, rows, table

from cairn.llm import repetition

SPACE = " \t\n\x0b\x0c\r"


def split(text):
    for c in SPACE[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def counts(text):
    w = split(text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    inside = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if split(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


def test_brute_force(spark):
    data = [r for r in rows(3) if len(r[1] or "") < 3000] + [(90, "# a | b\n# a | b\n\n\n# a | b", "en", "s", 0), (91, "x y z " * 40, "en", "s", 0)]
    got = repetition.measure(table(spark, data, kept="clash", n_words="clash"), keep=["doc_id"]).collect()
    want = sorted((i, *counts(t)) for i, t, *_ in data)
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_empty(spark):
    assert repetition.measure(spark.createDataFrame([], DOCS), keep=["doc_id"]).count() == 0
