r"""Main text of web pages by a recurrent block labeller (operator 6).

A page is cut into leaf blocks: the text between two block-level tags.  Each block becomes a vector
of its hashed tag path (tags, classes and ids of the elements above it), its hashed words and a few
measures such as its share of link text.  A bidirectional LSTM in numpy reads the page's blocks both
ways, so each is judged in the light of the whole page, and labels it main text or not.

The labeller is trained on the driver from a bounded table of labelled pages, made from a fixed seed
by `labelled_pages`; no row of the corpus is part of it.  Pages are independent: nothing is shuffled.

A page is read once, tag by tag, in time linear in its length whatever it holds: unclosed quotes, tags that never
end, elements nested without end.

Defined results: null and empty html give the empty text; a page without main text too.  Scripts,
styles, templates, frames, the head and form fields never are blocks; a head ends at the first block-level tag,
a button, select or option whose end tag is missing does too.  `<br>` is white space.  White space in
a block is one space; blocks are trimmed and joined by \n in page order; nothing else is dropped.
Repeated rows give repeated rows; extra columns pass through `extract` untouched; an empty table
gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import or_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PATH_BINS, WORD_BINS, MEASURES = 128, 32, 7
INPUTS = PATH_BINS + WORD_BINS + MEASURES
HIDDEN, TRAIN_PAGES, EPOCHS, BATCH, RATE = 16, 500, 10, 20, 0.01

BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose content is never text of the page: what is not shown, and the fields of forms
DROPPED = frozenset("button head iframe option script select style template textarea title".split())
RAW = frozenset("script style textarea title iframe template".split())
#: dropped elements that pages leave open: the first block ends the head, and the others where their end tag is missing
BOUNDED = {t: re.compile(rf"<(/?){t}\b", re.I) for t in "button option select".split()}
#: an open element of these ends where a sibling of the same set begins
CLOSES = {"p": frozenset("p"), "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p")), "tr": frozenset(("tr", "td", "th", "p")), "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p"))}
#: words and attributes of more letters are read anew each time
KEPT = 256
TAG, STOP = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)"), re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)


def _masks(tag: str, attributes: str) -> tuple[int, int]:
    """Bins by which a path knows an element, its tag and the words of its class, id and role: as one of the path, as its last."""
    words = [w for m in ATTRIBUTE.finditer(attributes) for w in re.split(r"[^a-z]+", (m[2] or m[3] or m[4] or "").lower()) if w]
    names = [tag, *(f".{w}" for w in words)]
    bit = lambda x: 1 << zlib.crc32(x.encode("utf-8", "surrogatepass")) % PATH_BINS
    return reduce(or_, (bit(x) for x in names if x not in ("html", "body")), 0), reduce(or_, (bit(f"/{x}") for x in names), 0)


_kept_masks = lru_cache(maxsize=1 << 14)(_masks)


class Tags:
    """The tags of a page in order; the page is read once, whatever it holds."""

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in ">\"'"}
        self.quotes = True
        self._ends: dict[str, list[tuple[int, bool]]] = {}

    def end(self, at: int) -> int:
        """Where the tag that begins before `at` ends; quotes that nothing closes are letters like any other."""
        if self.quotes:
            i = at
            while m := STOP.search(self.page, i):
                if m[0] == ">":
                    return m.start()
                i = m.end()
                if m.start() < self.last[m[0]]:
                    i = self.page.find(m[0], i) + 1
            # no end outside of quotes here means none for any later tag
            self.quotes = False
        return self.page.find(">", at)

    def left_open(self, tag: str, at: int) -> bool:
        """Whether a block at `at` ends an open dropped element `tag`: what comes next of its kind is not its end."""
        if tag == "head" or tag not in BOUNDED:
            return tag == "head"
        if tag not in self._ends:
            self._ends[tag] = [(m.start(), bool(m[1])) for m in BOUNDED[tag].finditer(self.page)]
        i = bisect_left(self._ends[tag], (at, False))
        return i == len(self._ends[tag]) or not self._ends[tag][i][1]


class Block(NamedTuple):
    text: str
    #: bins of the path
    mask: int
    depth: int
    #: characters of link text
    links: int


def leaf_blocks(page: str) -> list[Block]:
    """The leaf blocks that have text."""
    out: list[Block] = []
    #: open elements, and where in it each tag, each block and each dropped element stands
    stack: list[str] = []
    places: dict[str, list[int]] = {}
    blocks: list[tuple[int, int, int]] = []
    dropped: list[int] = []
    #: how many of each tag are among them
    kinds: Counter[str] = Counter()
    parts: list[str] = []
    links = 0
    at, size = 0, len(page)
    tags = Tags(page)

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                _, mask, last = blocks[-1] if blocks else (0, 0, 0)
                out.append(Block(text, mask | last, len(blocks), links))
            parts.clear()
        links = 0

    def close(to: int) -> None:
        while dropped and dropped[-1] >= to:
            tag = stack[dropped.pop()]
            kinds[tag] -= 1
            if not kinds[tag]:
                del kinds[tag]
        while len(stack) > to:
            places[stack.pop()].pop()
        while blocks and blocks[-1][0] >= to:
            blocks.pop()

    def say(text: str) -> None:
        nonlocal links
        if not dropped:
            parts.append(text)
            if places.get("a"):
                links += len(text)

    while at < size:
        here = page.find("<", at)
        if here < 0 or here > tags.last[">"] and page[here : here + 4] != "<!--":
            say(page[at:])
            break
        if here > at:
            say(page[at:here])
        at = here
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = end + 3 if end >= 0 else size
            continue
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            at = end + 1 if end >= 0 else size
            continue
        m = TAG.match(page, at)
        if not m:
            say("<")
            at += 1
            continue
        end = tags.end(m.end())
        tag, attributes = m[2].lower(), page[m.end() : end]
        at = end + 1
        block = tag in BLOCK
        if not m[1]:
            if tag == "br":
                say(" ")
                continue
            if block and dropped and all(tags.left_open(kind, at) for kind in kinds):
                close(dropped[0])
            if block and not dropped:
                flush()
            if tag in VOID or attributes.endswith("/"):
                continue
            if tag in RAW:  # its content holds no tags: skip to its end
                ends = re.compile(rf"</{tag}\b", re.I).search(page, at)
                at = ends.start() if ends else size
            # an open paragraph ends at any block; list items and cells at the next
            if block and not dropped and blocks and stack[blocks[-1][0]] in CLOSES.get(tag, CLOSES["p"]):
                close(blocks[-1][0])
            places.setdefault(tag, []).append(len(stack))
            if block:
                own, last = (_kept_masks if len(attributes) <= KEPT else _masks)(tag, attributes)
                blocks.append((len(stack), own | (blocks[-1][1] if blocks else 0), last))
            if tag in DROPPED:
                dropped.append(len(stack))
                kinds[tag] += 1
            stack.append(tag)
        else:
            i = places[tag][-1] if places.get(tag) else -1
            across = i >= 0 and bool(blocks) and blocks[-1][0] >= i
            if i < 0 or not block and tag not in DROPPED and across:
                if block and not dropped:
                    flush()
                continue
            if (block or across) and not dropped:
                flush()
            close(i)
    if not dropped:
        flush()
    return out


@lru_cache(maxsize=1 << 14)
def _path_bins(mask: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(mask.to_bytes(PATH_BINS // 8, "little"), np.uint8), bitorder="little"))


def _word_bin(word: str) -> tuple[int, float]:
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return PATH_BINS + (h >> 1) % WORD_BINS, 1.0 if h & 1 else -1.0


_kept_word_bin = lru_cache(maxsize=1 << 16)(_word_bin)


def vectors(blocks: list[Block]) -> np.ndarray:
    x = np.zeros((len(blocks), INPUTS), np.float32)
    for i, (text, mask, depth, links) in enumerate(blocks):
        x[i, _path_bins(mask)] = 1
        words = text.lower().split(" ")
        bins = np.array([(_kept_word_bin if len(w) <= KEPT else _word_bin)(w.strip(".,:;!?()")) for w in words])
        count = np.bincount(bins[:, 0].astype(np.int64), bins[:, 1], minlength=INPUTS)
        # all words count, and a word said a thousand times no more than a thousand words
        x[i] += count / max(1.0, np.sqrt((count * count).sum()))
        stops = text.count(".") + text.count("!") + text.count("?")
        x[i, -MEASURES:] = (np.log1p(len(text)) / 6, min(links / len(text), 1), min(stops / len(words), 1), text[-1] in ".!?", depth / 8, i / len(blocks), "©" in text)
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLSTM:
    """Two LSTMs, one for each direction, and a logistic unit over both states of a block."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        init = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.p: dict[str, np.ndarray] = {}
        for way in "fb":
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
            self.p |= {f"w{way}": init(INPUTS, 4 * HIDDEN), f"u{way}": init(HIDDEN, 4 * HIDDEN), f"c{way}": bias}
        self.p |= {"v": init(2 * HIDDEN, 1), "d": np.zeros(1, np.float32)}

    def _run(self, way: str, x: np.ndarray, inside: np.ndarray, keep: list | None = None) -> np.ndarray:
        n, t_max, _ = x.shape
        z = x @ self.p[f"w{way}"] + self.p[f"c{way}"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((n, t_max, HIDDEN), np.float32)
        for t in range(t_max) if way == "f" else range(t_max - 1, -1, -1):
            a = z[:, t] + h @ self.p[f"u{way}"]
            i, f, o = (_sigmoid(a[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(a[:, 3 * HIDDEN :])
            m = inside[:, t, None]
            c1 = f * c + i * g
            tc = np.tanh(c1)
            if keep is not None:
                keep.append((t, i, f, o, g, c, h, tc, m))
            c, h = np.where(m, c1, c), np.where(m, o * tc, h)
            out[:, t] = h
        return out

    def scores(self, x: np.ndarray, inside: np.ndarray) -> np.ndarray:
        s = np.concatenate((self._run("f", x, inside), self._run("b", x, inside)), 2)
        return _sigmoid((s @ self.p["v"])[:, :, 0] + self.p["d"])

    def gradients(self, x: np.ndarray, inside: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        kept: dict[str, list] = {"f": [], "b": []}
        s = np.concatenate([self._run(way, x, inside, kept[way]) for way in "fb"], 2)
        e = (_sigmoid((s @ self.p["v"])[:, :, 0] + self.p["d"]) - y) * inside / inside.sum()
        grad = {"v": np.einsum("nth,nt->h", s, e)[:, None], "d": e.sum(keepdims=True)[0, :1]}
        ds = e[:, :, None] * self.p["v"][:, 0]
        for way, part in (("f", ds[:, :, :HIDDEN]), ("b", ds[:, :, HIDDEN:])):
            u = self.p[f"u{way}"]
            dz = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            du = np.zeros_like(u)
            dh, dc = np.zeros(part[:, 0].shape, np.float32), np.zeros(part[:, 0].shape, np.float32)
            for t, i, f, o, g, c, h, tc, m in reversed(kept[way]):
                dh = dh + part[:, t]
                dc1 = dc + dh * o * (1 - tc * tc)
                da = np.concatenate((dc1 * g * i * (1 - i), dc1 * c * f * (1 - f), dh * tc * o * (1 - o), dc1 * i * (1 - g * g)), 1) * m
                dz[:, t] = da
                du += h.T @ da
                dh, dc = np.where(m, da @ u.T, dh), np.where(m, dc1 * f, dc)
            grad |= {f"w{way}": np.einsum("ntd,ntk->dk", x, dz, optimize=True), f"u{way}": du, f"c{way}": dz.sum((0, 1))}
        return grad

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]]) -> BiLSTM:
        rng = np.random.default_rng(2)
        m1, m2 = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), BATCH):
                x, inside = pad([pages[i][0] for i in order[at : at + BATCH]])
                y = np.zeros(inside.shape, np.float32)
                for j, i in enumerate(order[at : at + BATCH]):
                    y[j, : len(pages[i][1])] = pages[i][1]
                step += 1
                for k, g in self.gradients(x, inside, y).items():
                    g = g + 1e-5 * self.p[k]
                    m1[k] += 0.1 * (g - m1[k])
                    m2[k] += 0.001 * (g * g - m2[k])
                    self.p[k] -= RATE * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block is main text; pages of like length share a batch."""
        out = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            # padded batches of bounded size, whatever the longest page
            n = max(1, min(128, 16384 // len(pages[order[min(at + 127, len(order) - 1)]])))
            some = order[at : at + n]
            at += n
            p = self.scores(*pad([pages[i] for i in some]))
            for j, i in enumerate(some):
                out[i] = p[j, : len(pages[i])] >= 0.5
        return out


def pad(xs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in xs])
    out = np.zeros((len(xs), size.max(), INPUTS), np.float32)
    for i, x in enumerate(xs):
        out[i, : len(x)] = x
    return out, np.arange(size.max()) < size[:, None]


# the labelled pages ----------------------------------------------------------------------------

MAIN = ""
_SYLLABLES = "the er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve que ción sch für eau".split()
_CHROME = {
    "nav": ("menu nav navbar navigation topbar links breadcrumb", "home about contact login products blog archive"),
    "header": ("header masthead branding top site", "welcome official tagline"),
    "notice": ("notice cookie banner consent alert gdpr popup message", "cookies accept privacy consent settings"),
    "ad": ("ad ads advert advertisement sponsor promo promoted banner", "sponsored buy offer sale advertisement"),
    "side": ("sidebar side widget related recommended popular rail aside", "related popular tags latest more"),
    "form": ("form search newsletter subscribe signup login", "email subscribe search name password send"),
    "comments": ("comments comment respond replies discussion disqus reader", "reply said comment posted"),
    "share": ("share social buttons follow", "share tweet facebook print"),
    "footer": ("footer bottom copyright legal foot", "© copyright rights reserved terms imprint"),
}
_TAGS = {"nav": "nav div ul menu", "header": "header div", "notice": "div section aside p", "ad": "div aside section p", "side": "aside div section", "form": "form div form", "comments": "section div aside ol", "share": "div ul", "footer": "footer div footer"}
_BODIES = ('<article{}>', '<article{}>', '<article class="post">', '<main><article>', '<main id="main">', '<div class="content">', '<div id="content">', '<div class="entry-content">', '<div class="article-body">', '<section class="story">', '<div class="post-text">', '<div class="main"><div class="body">', '<td class="text">', '<div{}>')


def labelled_pages(n: int = TRAIN_PAGES, seed: int = 4) -> list[str]:
    """Pages of many layouts; MAIN stands before the text of each main block."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    chance = lambda p: rng.random() < p

    def word() -> str:
        return "".join(pick(_SYLLABLES) for _ in range(int(rng.integers(1, 5)))) + pick(["", "", "", "", ",", "###", "&amp;"] if chance(0.05) else ["", "", "", ","])

    def sentence(lo: int, hi: int) -> str:
        return " ".join(word() for _ in range(int(rng.integers(lo, hi)))).capitalize() + pick([".", ".", ".", "", "!"])

    def prose() -> str:
        return " ".join(sentence(2, 16) for _ in range(int(rng.integers(1, 9))))

    def chrome(kind: str) -> str:
        classes, words = (x.split() for x in _CHROME[kind])
        tag = pick(_TAGS[kind].split())
        # sometimes only the class tells, sometimes only the tag
        attribute = "" if tag not in ("div", "section", "ul", "ol", "p") and chance(0.5) else f' {pick(["class", "class", "id"])}="{pick(classes)}{pick(["", "", "-" + pick(["box", "inner", "a", "wrap"])])}"'
        say = lambda lo, hi: " ".join([*(pick(words) for _ in range(int(chance(0.6)))), sentence(lo, hi)])
        if kind == "nav":
            link = lambda: f'<a href="/{word()}">{pick([word(), pick(words)])}</a>'
            k = int(rng.integers(2, 9))
            inner = "".join(f"<li>{link()}</li>" for _ in range(k)) if chance(0.7) else " ".join(link() for _ in range(k))
            inner = inner if tag in ("ul", "menu") or not inner.startswith("<li") else f"<ul>{inner}</ul>"
        elif kind == "comments":
            one = lambda: f'<div class="{pick(["comment", "reply", "item"])}">{pick(["", f"<b>{word()}</b> ", f"<span>{word()}</span>"])}<p>{prose()}</p></div>'
            inner = pick(["", "<h3>Comments</h3>", f"<h2>{say(1, 3)}</h2>"]) + "".join(pick([one(), f"<p>{prose()}</p>", f"<li>{prose()}</li>"]) for _ in range(int(rng.integers(1, 6))))
        elif kind == "form":
            inner = f'<label>{say(1, 4)}</label><input name="q"><button>{word()}</button>' + pick(["", f"<p>{say(3, 12)}</p>"])
        elif kind in ("side", "share"):
            inner = pick(["", f"<h3>{say(1, 4)}</h3>"]) + pick([lambda: "<ul>" + "".join(f'<li><a href="#">{sentence(1, 7)}</a></li>' for _ in range(int(rng.integers(1, 7)))) + "</ul>", lambda: f"<p>{prose()}</p>", lambda: f'<a href="#">{say(1, 5)}</a>'])()
        elif kind == "footer":
            inner = pick([f"&copy; {word()}.example &middot; {sentence(2, 9)}", f"<p>{say(2, 12)}</p>", f"<p>&copy; {int(rng.integers(1999, 2030))} {sentence(1, 6)}</p><p>{sentence(2, 9)}</p>"])
        else:
            inner = pick([say(2, 14), f"<p>{say(2, 14)}</p>", prose(), f"<p>{prose()}</p>"])
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def body() -> str:
        opening = pick(_BODIES).replace("{}", "")
        tags = re.findall(r"<(\w+)", opening)
        out = [opening, f"<h1>{MAIN}{sentence(2, 12)}</h1>" if chance(0.85) else ""]
        for i in range(int(rng.integers(1, 16))):
            end = pick(["</p>", "</p>", "</p>", ""])
            kind = rng.random()
            text = MAIN + (prose() if chance(0.8) else sentence(1, 4))
            if kind < 0.78:
                out.append(f"<p>{pick(['', '', '<b>'])}{text}{pick(['', '', '<br>'])}{end}")
            elif kind < 0.84:
                level = pick([2, 3])
                out.append(f"<h{level}>{MAIN}{sentence(1, 7)}</h{level}>")
            elif kind < 0.89:
                out.append("<ul>" + "".join(f"<li>{MAIN}{sentence(2, 12)}</li>" for _ in range(int(rng.integers(2, 5)))) + "</ul>")
            elif kind < 0.92:
                out.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.94:
                out.append(f"<pre>{MAIN}{sentence(3, 20)}</pre>")
            elif i:
                out.append(chrome(pick(["ad", "ad", "side", "share", "notice", "form"])))
        return "".join(out) + "".join(f"</{t}>" for t in reversed(tags))

    pages = []
    for _ in range(n):
        top = [chrome(k) for k, p in (("header", 0.5), ("nav", 0.8), ("notice", 0.4), ("ad", 0.5), ("side", 0.2), ("form", 0.2)) if chance(p)]
        rng.shuffle(top)
        low = [chrome(k) for k, p in (("share", 0.2), ("comments", 0.45), ("side", 0.35), ("ad", 0.3), ("form", 0.2), ("footer", 0.8)) if chance(p)]
        middle = body() if chance(0.97) else ""
        wrap = pick([("", ""), ("", ""), ('<div class="wrapper">', "</div>"), ('<div id="page">', "</div>"), ("<div>", "</div>")])
        pages.append(f"<html><head><title>{sentence(2, 6)}</title></head><body>{wrap[0]}{''.join(top)}<!-- {word()} -->{middle}{''.join(low)}{wrap[1]}</body></html>")
    return pages


def examples(pages: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for page in pages:
        blocks = leaf_blocks(page)
        y = np.array([MAIN in b.text for b in blocks], np.float32)
        x = vectors([b._replace(text=b.text.replace(MAIN, "") or "-") for b in blocks])
        if len(y):
            out.append((x, y))
    return out


def train() -> BiLSTM:
    return BiLSTM().fit(examples(labelled_pages()))


def extract(pages: DataFrame, model: BiLSTM, keep: list[str], html: str = "html") -> DataFrame:
    """Columns `keep`, text and n_chars of each row."""
    keep = [c for c in keep if c not in ("text", "n_chars")]
    src = pages.select(*[F.col(c) for c in keep], F.col(html).cast("string").alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                cut = [leaf_blocks(h or "") for h in batch.column(len(keep)).to_pylist()]
                labels = model.label([vectors(b) for b in cut])
                texts = ["\n".join(b[0] for b, main in zip(blocks, label, strict=True) if main) for blocks, label in zip(cut, labels, strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
    return src.mapInArrow(run, ", ".join([*fields, "text string", "n_chars long"]))


def op6_recurrent_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), train(), ["page_id", "url"])
