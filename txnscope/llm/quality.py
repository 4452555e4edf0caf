"""Quality classifier from trusted positives and unlabelled text.

The risk is the non-negative unbiased one: prior * R+(positives) + max(0, R-(unlabelled) - prior *
R-(positives)) with the sigmoid loss. The class prior is estimated from the data: the smallest ratio, over
score thresholds, of the share of unlabelled to the share of positive texts above the threshold. Features are ratios of the rule measurements, cut into bins, so the
model is additive and becomes one SQL expression; scoring is a map over the table.

Training rows are those of the training part; the sample on which the driver fits is bounded by ``SAMPLE``
rows of each kind (those with the smallest hash of their id, found by a bound on it), a few numbers a row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.llm import rules
from txnscope.session import scratch_path

SAMPLE = 20_000
BINS = 12
STEPS = 400
#: Features as SQL over the rule measurements.
FEATURES = {
    "words": "log2(1 + n_words)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
}


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that never give a label: crc32 of the id as text leaves 1 when divided by 3 (never for null)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


@dataclass(frozen=True)
class Model:
    prior: float
    bias: float
    cuts: tuple[tuple[float, ...], ...]  # per feature, ascending; a value's bin counts the cuts at or below it
    weights: tuple[tuple[float, ...], ...]

    def score(self) -> Column:
        terms = [f"{self.bias!r}D"]
        for name, cuts, weights in zip(FEATURES, self.cuts, self.weights, strict=True):
            bin_ = " + ".join([f"IF({name} >= {c!r}D, 1, 0)" for c in cuts]) or "0"
            terms.append(f"get(array({', '.join(f'{w!r}D' for w in weights)}), {bin_})")
        return F.expr(f"1 / (1 + exp(-({' + '.join(terms)})))")


def _one_hot(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    parts = [np.eye(len(c) + 1)[(x[:, [j]] >= c).sum(axis=1)] for j, c in enumerate(cuts)]
    return np.concatenate([np.ones((len(x), 1)), *parts], axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def _adam(w: np.ndarray, gradient, steps: int, rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = gradient(w) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def discriminate(pos: np.ndarray, unl: np.ndarray) -> np.ndarray:
    """Logistic fit of positives against unlabelled texts, both with the same weight."""

    def gradient(w: np.ndarray) -> np.ndarray:
        return unl.T @ _sigmoid(unl @ w) / len(unl) - pos.T @ _sigmoid(-(pos @ w)) / len(pos)

    return _adam(np.zeros(pos.shape[1]), gradient, STEPS)


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """The positives' share: smallest ratio of the shares of unlabelled and positive texts above a score, among
    the scores that at least half of the positives reach. Each half of the positives is scored by a fit on
    the other half."""
    half, ratios = len(pos) // 2, []
    for a, b in ((pos[:half], pos[half:]), (pos[half:], pos[:half])):
        w = discriminate(a, unl)
        sb, su = np.sort(b @ w), np.sort(unl @ w)
        at = np.unique(sb)
        p = 1 - np.searchsorted(sb, at) / len(sb)
        u = 1 - np.searchsorted(su, at) / len(su)
        ratios.append(float((u / p)[p >= 0.5].min()))
    return float(np.clip(np.mean(ratios), 0.01, 0.99))


def minimise(pos: np.ndarray, unl: np.ndarray, prior: float) -> np.ndarray:
    """Weights of a small non-negative risk with the sigmoid loss, from the logistic fit on. While the negative
    part of the risk is below zero the step goes up that part alone, so the fit cannot profit from it."""

    def gradient(w: np.ndarray) -> np.ndarray:
        sp, su = _sigmoid(pos @ w), _sigmoid(unl @ w)
        slope_p = pos.T @ (sp * (1 - sp)) / len(pos)
        slope_u = unl.T @ (su * (1 - su)) / len(unl)
        if su.mean() - prior * sp.mean() < 0:
            return prior * slope_p - slope_u
        return slope_u - 2 * prior * slope_p

    start = discriminate(pos, unl)
    start[0] += np.log(prior / max(1 - prior / 2, 1e-9))
    return _adam(start, gradient, STEPS)


def fit(pos: np.ndarray, unl: np.ndarray) -> Model:
    """From feature rows of positives and unlabelled texts. Without either, every score is one half."""
    if len(pos) < 2 or not len(unl):
        return Model(0.5, 0.0, ((),) * len(FEATURES), ((0.0,),) * len(FEATURES))
    both = np.concatenate([pos, unl])
    cuts = [np.unique(np.quantile(both[:, j], np.linspace(0.02, 0.98, BINS))) for j in range(both.shape[1])]
    cuts = [np.unique(np.concatenate([c, [np.nextafter(c[0], np.inf)]])) for c in cuts]  # a pile-up at the smallest value is a bin
    p, u = _one_hot(pos, cuts), _one_hot(unl, cuts)
    prior = estimate_prior(p, u)
    w = minimise(p, u, prior)
    weights, at = [], 1
    for c in cuts:
        weights.append(tuple(w[at : at + len(c) + 1].tolist()))
        at += len(c) + 1
    return Model(prior, float(w[0]), tuple(tuple(c.tolist()) for c in cuts), tuple(weights))


def _features(docs: DataFrame) -> DataFrame:
    measured = rules.measure(docs, ["doc_id"])
    return measured.select(
        F.col("row.doc_id").cast("bigint").alias("doc_id"), *[F.expr(f"CAST({e} AS DOUBLE)").alias(n) for n, e in FEATURES.items()]
    )


def _bound(count: int) -> int:
    """A hash of the id at or below which about SAMPLE of ``count`` rows lie, and fewer than SAMPLE hardly ever."""
    share = min(1.0, (SAMPLE + 6 * SAMPLE**0.5) / max(count, 1))
    return min(-(1 << 63) + int(share * (1 << 64)), (1 << 63) - 1)


def _sample(rows: DataFrame) -> np.ndarray:
    """Features of the at most SAMPLE rows with the smallest hashes. The bound comes first, so that all tasks
    together send about SAMPLE rows; the limit holds where an id that passes repeats."""
    hashed = F.xxhash64("doc_id")
    near = rows.where(hashed <= F.lit(_bound(rows.count())))
    picked = near.orderBy(hashed, *FEATURES).limit(SAMPLE).select(*FEATURES).collect()
    return np.array([list(r) for r in picked], dtype=float).reshape(-1, len(FEATURES))


def scores(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of the table: doc_id, held_out, score, predicted.

    Positives are training rows whose label says 1; unlabelled are all training rows, whatever their label.
    Null and empty texts are scored like any other, by their measurements (all zero). Rows that repeat each
    get a row; a label given twice counts once.
    """
    path = scratch_path(spark, "features")
    _features(docs).write.parquet(path)
    features = spark.read.parquet(path)
    train = features.where(~held_out())
    trusted = labels.where("quality = 1").select(F.col("doc_id").cast("bigint").alias("doc_id")).where(~held_out()).distinct()
    model = fit(_sample(train.join(trusted, "doc_id", "left_semi")), _sample(train))
    return features.select("doc_id", held_out().alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )
