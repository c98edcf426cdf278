import numpy as np
import pyarrow as pa
from fixtures import DOCS, rows, table
from pyspark.sql import functions as F

from cairn.llm import toxicity
from cairn.llm.bytekit import blocks

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.op3_factorization_machine(spark, SF).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.toxic for r in got) / len(got)
    base = max(sum(r.toxic == 0 for r in got), sum(r.toxic == 1 for r in got)) / len(got)
    assert right > base and right >= 0.9
    assert docs.count() == toxicity.op3_factorization_machine(spark, SF).count()


def test_pairs_weigh_more_than_terms(spark):
    """Toxic exactly where an insult meets a group: either word alone says nothing by a linear weight."""
    data, labels = [], []
    for i in range(400):
        insult, group = i % 2, i // 2 % 2
        data.append((i, f"filler{i % 13} {'blorg' if insult else 'plain'} other{i % 7} {'zanzi' if group else 'quiet'}", "en", "s", 0))
        labels.append((i, insult & group))
    docs = table(spark, data)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert all((got[i] >= 0.5) == bool(y) for i, y in labels)


def test_edges(spark):
    data = [*rows(4, 12), (None, "null id", "en", "s", 0)]
    docs = table(spark, data, score="clash", toxic="clash")
    for labels in ([], [(1, None), (2, 1), (2, 0)]):
        model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        got = toxicity.score(docs, model, ["doc_id"]).collect()
        assert len(got) == len(data) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(spark.createDataFrame([], DOCS), model, ["doc_id"]).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(data)
    assert docs.filter(F.col("doc_id").isNull()).select(F.coalesce(toxicity.fold() == 0, F.lit(False)).alias("h")).first().h is False


def test_words_that_tell_only_together():
    """Insult and group are as common in clean rows as in toxic ones; only together they make a row toxic."""
    rng = np.random.default_rng(6)
    words = lambda: [f"w{x}" for x in rng.integers(0, 300, 20)]

    def made(n):
        texts, y = [], []
        for i in range(n):
            row = words()
            # a tenth is toxic, a fifth of that by the pair; a fifth of the clean rows hold either word, none both
            if i % 10 == 0:
                row += ["insult", "people"] if i % 50 == 0 else ["blorg"]
            elif i % 10 in (1, 2, 3, 4) and i % 20 < 10 or i % 20 in (11, 12, 13):
                row.append("insult" if i % 2 else "people")
            texts.append(" ".join(rng.permutation(row)))
            y.append(float(i % 10 == 0))
        return texts, np.array(y)

    def bins(texts):
        found = [toxicity.terms(b) for b in blocks(pa.array(texts))]
        first, docs = 0, []
        for block, (_, d) in zip(blocks(pa.array(texts)), found, strict=True):
            docs.append(d + block.first)
        return np.concatenate([b for b, _ in found]), np.concatenate(docs)

    texts, y = made(3000)
    b, d = bins(texts)
    f1, f = np.bincount(b, weights=y[d], minlength=1 << toxicity.BITS), np.bincount(b, minlength=1 << toxicity.BITS).astype(float)
    one = [int(bins([w])[0][0]) for w in ("insult", "people")]
    assert all(abs(toxicity._separation(f1, f, y.sum(), len(y))[one]) < toxicity.MIN_Z)
    assert set(one) <= set(toxicity.paired_terms(b, d, y, f1, f).tolist())
    model = toxicity.FactorizationMachine.fit(b, d, y)
    held, want = made(600)
    got = model.score(*bins(held), len(held)) >= 0.5
    assert (got == (want > 0)).mean() >= 0.97


def test_the_greatest_text_of_a_repeated_id_is_learnt_from(spark):
    data = [(i, "vile " * 3 + f"a{i}" if i % 2 else f"kind b{i}", "en", "s", 0) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    twice = data + [(i, "", "en", "s", 0) for i in range(200)]
    models = [toxicity.train(spark.createDataFrame(d, "doc_id long, text string, lang string, source string, n_chars long").repartition(n), labels) for d, n in ((data, 2), (twice, 5))]
    assert models[0].b == models[1].b and (models[0].w == models[1].w).all()


def test_margins_are_sums_over_all_pairs():
    rng = np.random.default_rng(9)
    slot = np.full(1 << toxicity.BITS, -1, np.int32)
    slot[:50] = np.arange(50)
    model = toxicity.FactorizationMachine(slot, 0.3, rng.normal(size=50), rng.normal(size=(50, toxicity.RANK)))
    rows = [np.sort(rng.choice(80, k, replace=False)) for k in (0, 1, 2, 17, 60)]
    got = model.score(np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows]), len(rows))
    for row, score in zip(rows, got):
        known = [t for t in row if t < 50]
        margin = model.b + sum(model.w[t] for t in known) + sum(model.v[a] @ model.v[b] for i, a in enumerate(known) for b in known[i + 1 :])
        assert abs(score - 1 / (1 + np.exp(-margin))) < 1e-9


def test_paired_terms_are_those_of_a_count_of_all_pairs():
    """On few terms, where no bound of the search bites: every pair counted in every row."""
    rng = np.random.default_rng(10)
    n = 600
    y = (np.arange(n) % 5 == 0).astype(float)
    held = rng.random((n, 30)) < 0.12
    held[y > 0, 3] |= held[y > 0, 4]
    either = rng.random(n)
    held[:, 5], held[:, 6] = (y == 0) & (either < 0.12), (y == 0) & (either > 0.88)
    held[(y > 0) & (rng.random(n) < 0.4), 5:7] = True
    d, b = np.nonzero(held)
    f1, f = np.bincount(b, weights=y[d], minlength=1 << toxicity.BITS), np.bincount(b, minlength=1 << toxicity.BITS).astype(float)
    n1 = y.sum()
    want = set()
    for i in range(30):
        for j in range(i + 1, 30):
            if min(f1[i], f1[j]) < toxicity.PAIR_ROWS or max(f[i], f[j]) > n / 4:
                continue
            both = held[:, i] & held[:, j]
            c, c1 = both.sum(), (both & (y > 0)).sum()
            if c1 < max(toxicity.PAIR_ROWS, toxicity.LIFT * f[i] * f[j] * n1 / n / n):
                continue
            z = toxicity._separation(np.array([c1]), np.array([float(c)]), n1, n)[0]
            alone = max(abs(toxicity._separation(f1[[k]], f[[k]], n1, n)[0]) for k in (i, j))
            if z > toxicity.MIN_Z and z > alone + 1:
                want |= {i, j}
    assert set(toxicity.paired_terms(b, d, y, f1, f).tolist()) == want and {5, 6} <= want
