"""The positive-unlabelled classifier: prior, risk and score against plain numpy, and odd tables."""

import numpy as np
import pytest

from txnscope.llm import quality

DOCS = "doc_id long, text string, score double, words string, row string"
GOOD = " ".join(f"word{i} of a longer sentence with plain words" for i in range(12))
POOR = "# $ % & | < > * " * 12


def rows(n):
    return [(i, f"{GOOD} {i}" if i % 2 else f"{POOR} {i}", 0.5, "w", "r") for i in range(n)]


def made(rng, n, share):
    good = rng.random(n) < share
    return np.where(good[:, None], rng.normal(1.5, 0.5, (n, 6)), rng.normal(-1.5, 0.5, (n, 6))), good


def encoded(x, both):
    cuts = [np.unique(np.quantile(both[:, j], np.linspace(0.02, 0.98, quality.BINS))) for j in range(both.shape[1])]
    return quality._one_hot(x, cuts)


@pytest.mark.parametrize("share", [0.2, 0.5, 0.8])
def test_prior_is_estimated_somewhat_low(share):
    # the smallest of many measured ratios is below the true one: by some 11 % of it with 1,500 positives, 3 % with 10,000
    rng = np.random.default_rng(3)
    pos, (unl, _) = rng.normal(1.5, 0.5, (1500, 6)), made(rng, 4000, share)
    both = np.concatenate([pos, unl])
    assert 0.85 * share < quality.estimate_prior(encoded(pos, both), encoded(unl, both)) < 1.02 * share


def test_risk_falls_and_negatives_are_told_apart():
    rng = np.random.default_rng(4)
    pos, (unl, good) = rng.normal(1.5, 0.5, (800, 6)), made(rng, 3000, 0.4)
    both = np.concatenate([pos, unl])
    p, u = encoded(pos, both), encoded(unl, both)

    def risk(w):
        sp, su = (1 / (1 + np.exp(-(x @ w))) for x in (p, u))
        return 0.4 * (1 - sp).mean() + max(0.0, su.mean() - 0.4 * sp.mean())

    w = quality.minimise(p, u, 0.4)
    assert risk(w) < 0.05 < risk(np.zeros(p.shape[1]))
    assert ((u @ w >= 0) == good).mean() > 0.97


def test_discriminate_reaches_a_flat_point():
    rng = np.random.default_rng(5)
    pos, unl = rng.normal(0.5, 1, (300, 3)), rng.normal(-0.5, 1, (400, 3))
    w = quality.discriminate(pos, unl)

    def loss(v):
        return np.log1p(np.exp(unl @ v)).mean() + np.log1p(np.exp(-(pos @ v))).mean() + 5e-4 * v @ v

    for step in np.concatenate([np.eye(3), -np.eye(3)]) * 0.05:
        assert loss(w) <= loss(w + step) + 1e-6


def test_sql_score_equals_numpy(spark):
    rng = np.random.default_rng(6)
    x, good = made(rng, 400, 0.5)
    model = quality.fit(x[good], x)
    z = model.bias + sum(
        np.array(w)[(x[:, [j]] >= np.array(c)).sum(axis=1)] for j, (c, w) in enumerate(zip(model.cuts, model.weights, strict=True))
    )
    # the score reads measurements through FEATURES; give it the features under the names that it computes from
    held = quality.FEATURES.copy()
    try:
        quality.FEATURES.update({n: n for n in held})
        frame = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{n} double" for n in held))
        got = [r[0] for r in frame.select(model.score()).collect()]
    finally:
        quality.FEATURES.update(held)
    assert np.allclose(got, 1 / (1 + np.exp(-z)))


def test_sample_is_bounded_and_has_the_smallest_hashes(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 400)
    frame = spark.range(20_000).selectExpr("id AS doc_id", *[f"CAST(id AS DOUBLE) AS {n}" for n in quality.FEATURES])
    smallest = frame.selectExpr("doc_id", "xxhash64(doc_id) AS h").orderBy("h").limit(400).collect()
    assert quality._sample(frame)[:, 0].tolist() == [r["doc_id"] for r in smallest]
    passing = frame.where(f"xxhash64(doc_id) <= {quality._bound(20_000)}").count()
    assert 400 <= passing <= 640  # rows that tasks send, not 400 from each
    hot = frame.unionByName(frame.where(f"doc_id = {smallest[0]['doc_id']}").crossJoin(spark.range(5000).select()))
    assert len(quality._sample(hot)) == 400
    assert quality._bound(0) == quality._bound(300) == 2**63 - 1


def test_odd_rows_and_clashing_columns(spark):
    docs = [*rows(300), (None, GOOD, None, None, None), (900, None, 0.1, None, None), (901, "", 0.1, "", ""), (7, GOOD, 1.0, "x", "y"), (7, GOOD, 1.0, "x", "y")]
    docs.append((902, "long " * 200_000, 0.0, "", ""))
    # a label given twice, one that contradicts itself, one without a document, null labels
    labels = [(i, i % 2) for i in range(300)] + [(1, 1), (3, 0), (5000, 1), (None, 1), (4, None)]
    docs, labels = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.scores(spark, docs, labels).collect()
    assert len(got) == 306 and got[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    assert len({r["score"] for r in got if r["doc_id"] in (900, 901)}) == 1
    assert [r["doc_id"] for r in got].count(7) == 3
    held = [r for r in got if r["held_out"] and r["doc_id"] < 300]
    high, low = ([r["score"] for r in held if r["doc_id"] % 2 == k] for k in (1, 0))
    assert len(held) > 60 and np.mean([h > x for h in high for x in low]) > 0.99


def test_held_out_labels_are_never_read(spark):
    docs = spark.createDataFrame(rows(200), DOCS)
    ids = [r[0] for r in docs.where(quality.held_out()).select("doc_id").collect()]
    true = [(i, i % 2) for i in range(200)]
    turned = [(i, 1 - q if i in ids else q) for i, q in true]
    one, two = (quality.scores(spark, docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (true, turned))
    assert sorted(one.collect()) == sorted(two.collect())


def test_empty_tables(spark):
    docs, none = spark.createDataFrame(rows(20), DOCS), spark.createDataFrame([], "doc_id long, quality int")
    assert quality.scores(spark, docs.limit(0), none).count() == 0
    assert {(r["score"], r["predicted"]) for r in quality.scores(spark, docs, none).collect()} == {(0.5, 1)}
