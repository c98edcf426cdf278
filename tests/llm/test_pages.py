import pytest

from cairn.llm import pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var x = "<p>no</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About</a></li></ul></nav>
<div class="cookie-banner">We use cookies to run this site. Accept</div>
<article><h1>A  head&amp;line</h1><p>First   paragraph of the
story, with a <b>bold</b> word and caf&eacute;.</p><div class="ad">Buy now, special offer</div>
<p>Second paragraph, a little longer than the first one was.<p>Third, not closed</article>
<section class="comments"><p>reader said something</p></section>
<aside class="sidebar"><a href="#">Related things</a></aside><footer>&copy; 2020 Example</footer></body></html>"""


@pytest.fixture(scope="module")
def model():
    return pages.train()


def test_article_only(spark, model):
    data = [(1, "u", PAGE), (2, "u", None), (3, "u", ""), (1, "u", PAGE), (4, "u", "<p"), (5, "u", "plain")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "'x' as text", "'y' as n_chars")
    got = {r.page_id: r for r in pages.extract(df, model, ["page_id", "url"]).collect()}
    assert got[1].text.split("\n") == ["A head&line", "First paragraph of the story, with a bold word and café.", "Second paragraph, a little longer than the first one was.", "Third, not closed"]
    assert got[2].text == got[3].text == "" and all(r.n_chars == len(r.text) for r in got.values())
    assert pages.extract(df.limit(0), model, ["page_id", "url"]).count() == 0


def test_held_out_layouts(model):
    examples = pages.examples(pages.labelled_pages(80, seed=99))
    got = model.label([x for x, _ in examples])
    right = sum(int((g == y).sum()) for g, (_, y) in zip(got, examples, strict=True))
    assert right / sum(len(y) for _, y in examples) >= 0.97


def test_corpus_articles(spark):
    """On the corpus pages, what stands in <article> is the text, but for what is marked as an advert."""
    got = pages.op6_recurrent_labeller(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 50
    assert sum(bool(r.text) for r in got) >= 48


def test_end_tags_left_out():
    """What follows an open head, or an open form field, is text of the page; closed ones hold none."""
    texts = lambda html: [b.text for b in pages.leaf_blocks(html)]
    assert texts("<html><head><title>T</title><meta x><body><p>one<p>two") == ["one", "two"]
    assert texts("<head><link x><style>p {}</style><p>one<p>two</p>") == ["one", "two"]
    for tag in ("button", "select", "option"):
        assert texts(f"<div><{tag}>no<p>one<p>two</div><p>three") == ["one", "two", "three"]
        assert texts(f"<div><{tag}>no<p>no</p></{tag}><p>two</div><p>three") == ["two", "three"]
    # what the contract does not name stays: formulas, and what stands in place of an object or a script
    assert texts("<object><p>a</p></object><p>x <math><mi>y</mi></math> z<noscript>b</noscript>") == ["a", "x y z" + "b"]
    assert texts("<select><option>a<option>b</select><svg><title>no</title><text>label</text></svg><p>one") == ["label", "one"]


def test_hostile_pages_take_linear_time():
    import time

    for page in ('<a "' * 250_000, '<a "' * 200_000 + '">"', "<div>x" * 100_000, "<" * 1_000_000, "<div>" * 1000 + "</b>" * 200_000, "<object><p>x" * 50_000, "<select><p>x" * 50_000):
        began = time.process_time()
        pages.leaf_blocks(page)
        assert time.process_time() - began < 2, page[:12]


def test_whole_blocks_are_read():
    """The words of a block beyond any prefix change its vector."""
    block = pages.Block("a " * 10_000 + "b", 0, 1, 0)
    x = pages.vectors([block, block._replace(text="a " * 9_999 + "b b")])
    assert (x[0] != x[1]).any()


def test_lstm_is_the_recurrence():
    """Batched, padded states of both directions against one block at a time."""
    import numpy as np

    model, rng = pages.BiLSTM(seed=3), np.random.default_rng(4)
    some = [rng.normal(size=(n, pages.INPUTS)).astype(np.float32) for n in (1, 4, 9)]
    got = model.scores(*pages.pad(some))
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    size = pages.HIDDEN
    for page, row in zip(some, got, strict=True):
        states = []
        for way, order in (("f", range(len(page))), ("b", range(len(page) - 1, -1, -1))):
            h, c, out = np.zeros(size), np.zeros(size), [None] * len(page)
            for t in order:
                a = page[t] @ model.p[f"w{way}"] + h @ model.p[f"u{way}"] + model.p[f"c{way}"]
                c = sigmoid(a[size : 2 * size]) * c + sigmoid(a[:size]) * np.tanh(a[3 * size :])
                h = sigmoid(a[2 * size : 3 * size]) * np.tanh(c)
                out[t] = h
            states.append(np.array(out))
        want = sigmoid(np.concatenate(states, 1) @ model.p["v"][:, 0] + model.p["d"])
        assert np.allclose(row[: len(page)], want, atol=1e-4)


def test_corpus_pages_match_their_articles(spark):
    """Text for text against the page's article element without what is marked as an advert."""
    import re

    from oracle import SF_DIR

    table = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = {r.page_id: r.text for r in pages.extract(table, pages.train(), ["page_id"]).collect()}
    same = n = 0
    for r in table.collect():
        article = re.search(r"<article[^>]*>(.*)</article>", r.html or "", re.S)
        if article:
            inner = re.sub(r'<div class="ad">.*?</div>|<aside.*?</aside>', "", article[1], flags=re.S)
            n += 1
            same += got[r.page_id] == "\n".join(b.text for b in pages.leaf_blocks(inner))
    assert n > 0 and same >= 0.98 * n


@pytest.mark.parametrize("page", [lambda n: "<head>" * n + "<button>" + "<p>x" * n + "</button>", lambda n: "<select><option>" * n + "<p>x" * n, lambda n: "<button>" * n + "<div>x</div>" * n, lambda n: "<p " + "a" * n + ">" + "w" * n])
def test_nested_dropped_elements_are_linear(page):
    import time

    began = time.process_time()
    pages.leaf_blocks(page(100_000))
    assert time.process_time() - began < 6
