r"""Quality rules: how much of a text lies inside repeated n-grams and lines (operator 4).

Every text is read once, as bytes.  Rolling hashes of several n-gram lengths come from one
prefix pass in numpy; a document's verdict needs no other document, so nothing is shuffled.

Defined results: null and empty texts have no words, all counts 0, ``base_failed`` true and
``kept`` false.  Rows are independent: repeated rows give repeated rows, extra columns pass
through `measure` untouched, an empty table gives an empty result.  Lengths are code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytekit import LEAD, SPACE, Prefix, _table, blocks, ngrams, repeats

SYMBOLS = _table(b"#*$%&|<>")
#: longest allowed share of a text's word characters inside n-grams seen before, by n
NGRAM_LIMITS = {5: 0.30, 8: 0.25, 13: 0.20}
#: longest allowed share of word characters inside lines seen before
LINE_LIMIT = 0.30
#: longest allowed share of symbols among the characters of words
SYMBOL_LIMIT = 0.05
MIN_WORDS, REPEAT_PERCENT = 50, 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = tuple(f"dup_share_{n}" for n in NGRAM_LIMITS) + ("dup_line_share", "symbol_share")
SCHEMA = ", ".join([f"{c} long" for c in COUNTS] + ["base_failed boolean", "kept boolean"] + [f"{c} double" for c in SHARES])


def _covered(marked: np.ndarray, at: np.ndarray, n: int, count: int) -> np.ndarray:
    """Which of `count` words lie in one of the marked n-word windows."""
    step = np.zeros(count + 1, np.int32)
    np.add.at(step, at[marked], 1)
    np.add.at(step, at[marked] + n, -1)
    return np.cumsum(step[:-1]) > 0


def measure_block(block) -> dict[str, np.ndarray]:
    buf, n = block.buf, block.n
    is_word = ~SPACE[buf]
    starts, ends, docs = block.spans(is_word)
    lead = np.concatenate(([0], np.cumsum(LEAD[buf] & is_word, dtype=np.int64)))
    chars = lead[ends] - lead[starts]
    prefix = Prefix(buf)
    words = prefix(starts, ends)
    per_doc = lambda weights=None: np.bincount(docs, weights=weights, minlength=n)
    out = {"n_words": per_doc().astype(np.int64), "word_chars": per_doc(chars).astype(np.int64), "n_symbols": block.per_doc(SYMBOLS[buf])}

    h, at = ngrams(words, docs, 3)
    _, many = repeats(h, docs[at])
    out["n_repeat_words"] = per_doc(_covered(many, at, 3, len(words))).astype(np.int64)

    ls, le, ld = block.lines()
    filled = np.concatenate(([0], np.cumsum(is_word, dtype=np.int64)))
    has = filled[le] > filled[ls]
    ls, le, ld = ls[has], le[has], ld[has]
    later, _ = repeats(prefix(ls, le), ld)
    out["n_dup_lines"] = np.bincount(ld, weights=later, minlength=n).astype(np.int64)

    total = np.maximum(out["word_chars"], 1)
    for k in NGRAM_LIMITS:
        h, at = ngrams(words, docs, k)
        later_gram, _ = repeats(h, docs[at])
        out[f"dup_share_{k}"] = per_doc(chars * _covered(later_gram, at, k, len(words))) / total
    out["dup_line_share"] = np.bincount(ld, weights=(lead[le] - lead[ls]) * later, minlength=n) / total
    out["symbol_share"] = out["n_symbols"] / total

    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * out["n_words"])
    bad = (out["dup_line_share"] > LINE_LIMIT) | (out["symbol_share"] > SYMBOL_LIMIT)
    for k, limit in NGRAM_LIMITS.items():
        bad |= out[f"dup_share_{k}"] > limit
    out["kept"] = ~out["base_failed"] & ~bad
    return out


def measure(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default, but for those that the result names) and the measures of each row's text."""
    names = [c for c in (docs.columns if keep is None else keep) if c not in COUNTS + SHARES + ("base_failed", "kept")]
    src = docs.select(*[F.col(c) for c in names], F.col(text).alias("__text"))
    order = [x.split(" ")[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [measure_block(b) for b in blocks(batch.column(len(names)))]
            columns = [batch.column(i) for i in range(len(names))]
            columns += [pa.array(np.concatenate([p[c] for p in parts])) for c in order]
            yield pa.RecordBatch.from_arrays(columns, names + order)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(run, f"{fields}, {SCHEMA}" if names else SCHEMA)


def op4_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"])


def _oracle() -> str:
    each = lambda part, sep=", ", ks=tuple(NGRAM_LIMITS): sep.join(part(k) for k in ks)
    run = lambda name, k: f"max({name}) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    gram = lambda k: " || ' ' || ".join(["w", *(f"lead(w, {j}) OVER o" for j in range(1, k))]) + f" AS g{k}"
    return rf"""
WITH w AS (
  SELECT r, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM (SELECT doc_id AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)),
c AS (SELECT *, length(w) AS n, {each(gram, ks=(3, *NGRAM_LIMITS))} FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
m AS (
  SELECT r, i, n, coalesce(g3 IS NOT NULL AND count(*) OVER (PARTITION BY r, g3) > 1, false) AS many3,
    {each(lambda k: f"coalesce(g{k} IS NOT NULL AND row_number() OVER (PARTITION BY r, g{k} ORDER BY i) > 1, false) AS later{k}")} FROM c),
v AS (SELECT r, n, {run("many3", 3)} AS in3, {each(lambda k: f"{run(f'later{k}', k)} AS in{k}")} FROM m),
s AS (SELECT r, count(*) AS n_words, sum(n) AS word_chars, count(*) FILTER (in3) AS n_repeat_words, {each(lambda k: f"coalesce(sum(n) FILTER (in{k}), 0) AS c{k}")} FROM v GROUP BY r),
l AS (
  SELECT r, line, row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again FROM (
    SELECT doc_id AS r, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
k AS (SELECT r, count(*) FILTER (again) AS n_dup_lines, sum(CASE WHEN again THEN length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) ELSE 0 END) AS dup_chars FROM l GROUP BY r),
f AS (
  SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, greatest(coalesce(word_chars, 0), 1) AS total, coalesce(dup_chars, 0) AS dup_chars, {each(lambda k: f"coalesce(c{k}, 0) AS c{k}")}
  FROM documents d LEFT JOIN s ON s.r = d.doc_id LEFT JOIN k ON k.r = d.doc_id),
x AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
    {each(lambda k: f"c{k} / total AS dup_share_{k}")}, dup_chars / total AS dup_line_share, n_symbols / total AS symbol_share FROM f)
SELECT doc_id, {", ".join(COUNTS)}, base_failed, {", ".join(SHARES)},
  NOT base_failed AND {each(lambda k: f"dup_share_{k} <= {NGRAM_LIMITS[k]}", " AND ")} AND dup_line_share <= {LINE_LIMIT} AND symbol_share <= {SYMBOL_LIMIT} AS kept FROM x
"""


ORACLE_SQL = _oracle()
