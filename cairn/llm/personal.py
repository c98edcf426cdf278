r"""Personal data by fixed patterns and a linear-chain conditional random field (operator 5).

Patterns find the base spans; a conditional random field over word shapes adds spans that they
miss, such as a phone number that runs into a card number, and never takes one away.

The field labels each word of a line O, or the begin or inside of a kind.  Its features are hashed
word shapes of the word and its neighbours, so it learns from a small labelled table, made by
`labelled_table` from a fixed seed: a bounded training set that no document is part of.  Training is
by exact gradients (forward and backward sums in log space); decoding is Viterbi over batches of
lines of like length.  Of a decoded span only the letters that its kind can hold, the count of digits and the
checksum are tested: forms that no pattern has, such as national numbers or addresses in words, are the field's.

Defined results: null and empty texts have no spans.  Offsets are code points, end exclusive.
Rows are independent, so repeated rows give repeated rows; extra columns pass through `find`
untouched; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    # a match can only begin where a run of digits does: the others need not be tried
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: training bounds and schedule
TRAIN_LINES, STEPS, RATE, DECAY, BUCKETS = 1200, 50, 0.3, 1e-4, 1 << 12
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind: str, span: str) -> bool:
    """The exact test of a span that matches the pattern of its kind."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in span.split("."))
    digits = re.sub(r"[^0-9]", "", span)
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15


_LOCAL, _DOMAIN = re.compile(r"[A-Za-z0-9._%+-]+(@?)"), re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of the email pattern, each run of its characters read once however long it is."""
    at = 0
    while m := _LOCAL.search(text, at):
        at = m.end()
        if m[1] and (domain := _DOMAIN.match(text, at)):
            at = domain.end()
            yield m.start(), at


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' spans, in order."""
    out = []
    for k, kind in enumerate(KINDS):
        if kind == "email" and "@" not in text or kind == "phone" and "+" not in text:
            continue
        found = _emails(text) if kind == "email" else (m.span() for m in PATTERNS[kind].finditer(text))
        out += [(a, k, b) for a, b in found if valid(kind, text[a:b])]
    return sorted(out)


# word shapes -----------------------------------------------------------------------------------

_SHAPES = [(re.compile(p), r) for p, r in ((r"[A-Z]", "A"), (r"[^\W\d_A-Z]", "a"), (r"[0-9]", "9"))]


def _of_short(f):
    """Keeps the results for short texts: long ones would fill the memory."""
    kept = lru_cache(maxsize=1 << 16)(f)
    return lambda s: kept(s) if len(s) <= 128 else f(s)


@_of_short
def shape(word: str) -> str:
    """The word with letters as A or a, digits as 9, and long runs shortened to four and their count's band."""
    for pattern, r in _SHAPES:
        word = pattern.sub(r, word)
    word = re.sub(r"a{3,}", "aaa", re.sub(r"A{3,}", "AAA", word))
    return re.sub(r"9{5,}", lambda m: f"9999<{len(m.group())}>", word)


def _bucket(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "big") % BUCKETS


@_of_short
def _digits(s: str) -> int:
    """Digits of a shape."""
    return s.count("9") + sum(int(n) - 4 - n.count("9") for n in re.findall(r"<(\d+)>", s))


@_of_short
def _shape_features(s: str) -> tuple[tuple[int, ...], tuple[int, ...], tuple[int, ...]]:
    """Bins of a shape as the word itself, as the one before and as the one after."""
    own = [s, f"d{min(_digits(s), 20)}", f"@{'@' in s}", f"+{s[:1] == '+'}", f"dots{s.count('.')}", f"alpha{set(s) <= set('aA,.')}", f"at{s.strip('[]()')}"]
    return tuple(_bucket(f"0{x}") for x in own), tuple(_bucket(f"-{x}") for x in own[:2] + own[3:4]), tuple(_bucket(f"+{x}") for x in own[:2])


@lru_cache(maxsize=1 << 16)
def _run_features(before: int, digits: int, after: int, plus: bool) -> tuple[int, int]:
    """Bins of a word with digits by the digits before and after it in a run of such words, and how the run begins."""
    return _bucket(f"b{before}|{digits}|{plus}"), _bucket(f"a{after}|{digits}")


def _runs(shapes: list[str]) -> list[tuple[int, int]]:
    """Of each word the two bins of its place in a run of words with digits; of other words none, as (-1, -1)."""
    count = [_digits(s) for s in shapes]
    out = [(-1, -1)] * len(shapes)
    i = 0
    while i < len(count):
        j = i
        while j < len(count) and count[j]:
            j += 1
        total, before = sum(count[i:j]), 0
        for k in range(i, j):
            out[k] = _run_features(min(before, 30), min(count[k], 30), min(total - before - count[k], 30), shapes[i][:1] == "+")
            before += count[k]
        i = max(j, i + 1)
    return out


class Field:
    """weights (BUCKETS, labels) of features, and (labels, labels) of transitions."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves
        self._cache: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def _parts(self, s: str):
        if s in self._cache:
            return self._cache[s]
        parts = tuple(self.weights[list(f)].sum(0) for f in _shape_features(s))
        if len(s) <= 128:
            if len(self._cache) > 1 << 16:
                self._cache.clear()
            self._cache[s] = parts
        return parts

    def emissions(self, shapes: list[str]) -> np.ndarray:
        parts = [self._parts(s) for s in shapes]
        out = np.array([p[0] for p in parts])
        out[1:] += np.array([p[1] for p in parts[:-1]]).reshape(-1, len(LABELS))
        out[:-1] += np.array([p[2] for p in parts[1:]]).reshape(-1, len(LABELS))
        run = np.array(_runs(shapes))
        some = run[:, 0] >= 0
        out[some] += self.weights[run[some]].sum(1)
        return out

    def decode(self, lines: list[list[str]]) -> list[np.ndarray]:
        """Viterbi labels of each line's shapes; lines of like length share a batch."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(lines)
        order = sorted((i for i in range(len(lines)) if lines[i]), key=lambda i: len(lines[i]))
        at = 0
        while at < len(order):
            # batches of bounded padded size, whatever the longest line
            n = max(1, min(256, 65536 // len(lines[order[min(at + 255, len(order) - 1)]])))
            some = order[at : at + n]
            at += n
            size = np.array([len(lines[i]) for i in some])
            e = np.zeros((len(some), size.max(), len(LABELS)))
            for j, i in enumerate(some):
                e[j, : size[j]] = self.emissions(lines[i])
            best, back = e[:, 0], np.zeros(e.shape, np.int8)
            final = np.where((size == 1)[:, None], best, 0)
            for t in range(1, e.shape[1]):
                step = best[:, :, None] + self.moves
                back[:, t] = step.argmax(1)
                best = step.max(1) + e[:, t]
                final[size == t + 1] = best[size == t + 1]
            label = final.argmax(1)
            path = np.zeros(e.shape[:2], np.int64)
            rows = np.arange(len(some))
            for t in range(e.shape[1] - 1, -1, -1):
                label = np.where(size - 1 == t, final.argmax(1), label)
                path[:, t] = label
                label = np.where(t < size, back[rows, t, label], label)
            for j, i in enumerate(some):
                out[i] = path[j, : size[j]]
        return out

    @classmethod
    def fit(cls, lines: list[list[str]], labels: list[list[int]]) -> Field:
        """Maximum likelihood by full gradients, all lines padded to one batch."""
        n, t_max, k = len(lines), max(map(len, lines)), len(LABELS)
        size = np.array([len(x) for x in lines])
        y = np.zeros((n, t_max), np.int64)
        where, bins = [], []
        for i, (line, label) in enumerate(zip(lines, labels, strict=True)):
            y[i, : len(label)] = label
            f, run = [_shape_features(s) for s in line], _runs(line)
            for t in range(len(line)):
                own = f[t][0] + (f[t - 1][1] if t else ()) + (f[t + 1][2] if t + 1 < len(line) else ()) + (run[t] if run[t][0] >= 0 else ())
                bins += own
                where += [i * t_max + t] * len(own)
        where, bins = np.array(where), np.array(bins)
        change = lambda x: np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
        heads, by_bin = change(where), np.argsort(bins, kind="stable")
        firsts = change(bins[by_bin])
        inside = np.arange(t_max) < size[:, None]
        weights, moves = np.zeros((BUCKETS, k)), np.zeros((k, k))
        gold = np.eye(k)[y] * inside[:, :, None]
        gold_moves = np.einsum("ntj,ntk->jk", gold[:, :-1], gold[:, 1:])
        sw, sm = np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)
        lse = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
        for _ in range(STEPS):
            e = np.zeros((n * t_max, k))
            e[where[heads]] = np.add.reduceat(weights[bins], heads)
            e = e.reshape(n, t_max, k)
            ahead, behind = np.zeros_like(e), np.zeros_like(e)
            ahead[:, 0] = e[:, 0]
            for t in range(1, t_max):
                ahead[:, t] = np.where(inside[:, t, None], lse(ahead[:, t - 1, :, None] + moves, 1) + e[:, t], ahead[:, t - 1])
            for t in range(t_max - 2, -1, -1):
                behind[:, t] = np.where(inside[:, t + 1, None], lse(moves + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2), 0)
            z = lse(ahead[:, -1], 1)
            p = np.exp(ahead + behind - z[:, None, None]) * inside[:, :, None]
            gm = -gold_moves + DECAY * moves
            for t in range(1, t_max):
                joint = ahead[:, t - 1, :, None] + moves + (e[:, t] + behind[:, t])[:, None, :] - z[:, None, None]
                gm += (np.exp(np.minimum(joint, 0)) * inside[:, t, None, None]).sum(0)
            gw = DECAY * weights
            gw[bins[by_bin[firsts]]] += np.add.reduceat((p - gold).reshape(-1, k)[where[by_bin]], firsts)
            sw += gw * gw
            sm += gm * gm
            weights -= RATE * gw / np.sqrt(sw)
            moves -= RATE * gm / np.sqrt(sm)
        return cls(weights, moves)


# the labelled table ----------------------------------------------------------------------------


def labelled_table(n: int = TRAIN_LINES, seed: int = 3) -> tuple[list[list[str]], list[list[int]]]:
    """Lines of word shapes and their labels."""
    lines, labels = labelled_lines(n, seed)
    return [[shape(w) for w in line] for line in lines], labels


def labelled_lines(n: int, seed: int) -> tuple[list[list[str]], list[list[int]]]:
    """Lines of words and their labels: personal data among plain words and other numbers."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[rng.integers(len(xs))]
    digits = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    letters = lambda lo, hi: "".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(lo, hi)))
    between = lambda lo, hi: int(rng.integers(lo, hi))

    def card() -> list[str]:
        k = pick([14, 15, 16, 16, 16, 16, 19])
        head = str(between(3, 7)) + digits(k - 2)
        d = next(head + c for c in "0123456789" if luhn(head + c))
        sep = pick(["", "", " ", "-"])
        return sep.join(d[i : i + 4] for i in range(0, k, 4)).split(" ")

    def phone() -> list[str]:
        a, b, c, k = digits(3), digits(3), digits(4), between(1, 99)
        world = [f"+{k} ({a}) {b}-{c}", f"+{k} {a} {b} {c}", f"+{k}-{a}-{b}-{c}", f"+{k}{a}{b}{c}", f"+{k} {a}.{b}.{c}", f"+{k} {digits(4)} {digits(6)}"]
        home = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a} {b} {c}", f"{a}.{b}.{c}", f"({a}) {b} {c}", f"0{a} {digits(4)} {digits(4)}"]
        return pick(pick([world, home])).split(" ")

    def email() -> list[str]:
        name, host, end = f"{letters(2, 9)}{pick(['', '.', '_'])}{pick(['', digits(2)])}", f"{letters(2, 8)}{pick(['', digits(1)])}", pick(["com", "org", "de", "example.com"])
        plain = f"{name}@{host}.{end}"
        return pick([plain, plain, plain, f"{name} [at] {host}.{end}", f"{name} (at) {host}.{end}", f"{name} [at] {host} [dot] {end}", f"{name} (at) {host} (dot) {end}", f"{name}[at]{host}.{end}", f"{name}@{host} .{end}"]).split(" ")

    def plain() -> list[str]:
        w = letters(1, 10)
        return [pick([w, w, w, w, w.capitalize(), w + ",", w + ".", w.upper(), f"({w})", f"[{w}]", "at", "dot"])]

    def other() -> list[str]:
        """Numbers and signs that are nobody's."""
        return pick([digits(between(1, 9)), f"{between(1900, 2030)}", f"{digits(2)}.{digits(1)}", f"{between(1, 99)}.", f"{digits(1)}.{digits(1)}.{digits(2)}", f"v{digits(1)}.{digits(2)}", f"{digits(4)}-{digits(2)}-{digits(2)}", f"{letters(2, 6)}={letters(1, 4)}{digits(4)}", f"@{letters(3, 8)}", f"+{digits(1)}", digits(between(20, 26)), digits(between(10, 14)), f"({digits(1)})", f"{letters(2, 5).upper()}{digits(4)}", f"{digits(1)},{digits(3)}", f"{between(1, 99)},{digits(3)},{digits(3)}", f"{digits(4)}-{digits(2)}-{digits(2)} {digits(2)}:{digits(2)}:{digits(2)}", f"978-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}", f"{digits(2)} {digits(2)} {digits(2)}", f"{digits(3)} {digits(3)}", f"{digits(2)}.{digits(2)}.{digits(4)}", "".join(pick([letters(1, 3), digits(2)]) for _ in range(8))]).split(" ")

    makers = {"email": email, "ip": lambda: [".".join(str(between(0, 256)) for _ in range(4))], "card": card, "phone": phone}
    lines, labels = [], []
    for _ in range(n):
        line, label = [], []
        for _ in range(between(3, 12)):
            kind = pick(["", "", "", "", "other", "other", *KINDS])
            words = makers[kind]() if kind in makers else other() if kind else plain()
            line += words
            k = 1 + 2 * KINDS.index(kind) if kind in makers else 0
            label += [k, *([k + 1] * (len(words) - 1))] if k else [0] * len(words)
        lines.append(line)
        labels.append(label)
    return lines, labels


def train() -> Field:
    return Field.fit(*labelled_table())


_FIRST, _LAST = re.compile(r"[0-9A-Za-z+(]"), re.compile(r"[0-9A-Za-z]")
#: what a decoded span may hold; beyond this only digits are counted and checksums taken, the field decides the rest
_MADE_OF = {
    # labels hold no dot and no bracket, so that a span can be read in one way only
    "email": re.compile(r"[^\s@\[(]+\s*(?:@|[\[(]at[\])])\s*[^\s@.\[\]()]+(?:\s*(?:\.|[\[(]dot[\])])\s*[^\s@.\[\]()]+)+", re.I),
    "ip": re.compile(r"[0-9]+(\.[0-9]+){3}"),
    "card": re.compile(r"[0-9][\x20.0-9-]+"),
    "phone": re.compile(r"[+(0-9][\x20()./0-9-]+"),
}


def field_spans(text: str, field: Field) -> list[tuple[int, int, int]]:
    """Spans that the field decodes, with digits and checksum of their kind.

    Lines without a digit, @ or (at) hold no word that any test could pass, and are not decoded.
    """
    words, lines = [], []
    for line in re.finditer(r"[^\n]+", text):
        if not _HINT.search(text, line.start(), line.end()):
            continue
        found = [(m.start(), m.end()) for m in WORD.finditer(text, line.start(), line.end())]
        if found:
            words.append(found)
            lines.append([shape(text[a:b]) for a, b in found])
    out = []
    for found, labels in zip(words, field.decode(lines), strict=True):
        i = 0
        while i < len(labels):
            if labels[i] % 2 == 0:  # outside, or an inside without a begin
                i += 1
                continue
            j = i + 1
            while j < len(labels) and labels[j] == labels[i] + 1:
                j += 1
            k = (labels[i] - 1) // 2
            a, b = found[i][0], found[j - 1][1]
            head, tail = _FIRST.search(text, a, b), _LAST.search(text[a:b][::-1])
            a, b = head.start() if head else b, b - tail.start() if tail else a
            span = text[a:b]
            if span and _MADE_OF[KINDS[k]].fullmatch(span) and valid(KINDS[k], span):
                out.append((a, int(k), a + len(span)))
            i = j
    return out


_HINT = re.compile(r"[0-9@]|[\[(]at[\])]", re.I)


def spans(text: str, field: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans: those of the field that overlap a base span are dropped."""
    if not _HINT.search(text):
        return [], []
    base = base_spans(text)
    starts, furthest = [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max))

    def free(a: int, b: int) -> bool:
        i = bisect_left(starts, b)
        return not i or furthest[i - 1] <= a

    more = [s for s in field_spans(text, field) if free(s[0], s[2])]
    return base, sorted(base + more)


def _render(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def find(docs: DataFrame, field: Field, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, n_<kind> of the base spans, their base_sha256, all spans, and n_added, of each row."""
    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    src = docs.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                out: list[list] = [[] for _ in names]
                for value in batch.column(len(keep)).to_pylist():
                    base, every = spans(value or "", field)
                    counts = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
                    for x, y in zip(out, (*counts, hashlib.sha256(_render(base).encode()).hexdigest(), _render(every), len(every) - len(base)), strict=True):
                        x.append(y)
                types = [pa.int64()] * len(KINDS) + [pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *(pa.array(x, t) for x, t in zip(out, types, strict=True))], [*keep, *names])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
    return src.mapInArrow(run, ", ".join([*fields, *(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string", "n_added long"]))


def op5_conditional_random_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"), train(), ["doc_id"])
