"""Integer k-means operators against plain numpy: ties, repeats, unusable rows, filtered comparisons."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from txnscope.llm import ballcodes, centroids
from txnscope.llm.text import ship_code

COLUMNS = "vec_id long, embedding array<float>, label int, x string, v int, apex string, code int, h string, same int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, "a", 2, "h", 3) for i, v, label in rows], COLUMNS)


def _floats(values) -> list[float]:
    return np.asarray(values, np.float32).astype(float).tolist()


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(12, 64))
    out = [(i, _floats(middles[i % 12] * (0 if i % 29 == 0 else 1) + 0.1 * rng.normal(size=64)), i % 5) for i in range(400)]
    out += [(i, _floats(np.full(64, 0.5)), None) for i in range(400, 460)]  # equal vectors
    out += [(7, out[7][1], 2), (7, out[8][1], 2), (None, out[3][1], 1)]  # repeated ids, no id
    bad = [None, [], [0.5] * 63, [0.5] * 48 + [None] + [0.5] * 15, [float("nan")] * 64, [float("inf")] + [0.0] * 63]
    return out + [(1000 + i, v, 9) for i, v in enumerate(bad)]


def _integers(rows, scale):
    usable = [(i, v, label) for i, v, label in rows if v and len(v) == 64 and all(e is not None and np.isfinite(e) for e in v)]
    return usable, np.floor(np.array([v for _, v, _ in usable], np.float64) * scale).astype(np.int64)


def _argmin(x, c):
    d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


def _brute_clusters(rows, count=16, rounds=3):
    usable, x = _integers(rows, 64)
    named = [(hashlib.sha256(f"1:{i}".encode()).hexdigest(), x[k].tolist()) for k, (i, _, _) in enumerate(usable) if i is not None]
    c = np.array([v for _, v in sorted(named)[:count]], np.int64)
    for _ in range(rounds):
        at, _ = _argmin(x, c)
        c = np.array([[int(s) // int((at == k).sum()) for s in x[at == k].sum(axis=0)] if (at == k).any() else c[k] for k in range(len(c))])
    at, d = _argmin(x, c)
    sha = [hashlib.sha256(",".join(map(str, k.tolist())).encode()).hexdigest() for k in c]
    return sorted(
        ((i is None, i or 0), int(k), int(e), int(d[at == k].sum()), int(d.sum()), sha[k])
        for (i, _, _), k, e in zip(usable, at, d, strict=True)
    )


def _found_clusters(df):
    return sorted(
        ((r["vec_id"] is None, r["vec_id"] or 0), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])
        for r in df.collect()
    )


def test_centroids_equal_brute_force(spark, rows):
    ship_code(spark)
    assert _found_clusters(centroids.clusters(spark, _frame(spark, rows))) == _brute_clusters(rows)


@pytest.mark.parametrize("few", [0, 1, 5])
def test_centroids_of_few_vectors(spark, rows, few):
    ship_code(spark)
    part = rows[400 : 400 + few] + rows[-6:]
    assert _found_clusters(centroids.clusters(spark, _frame(spark, part))) == (_brute_clusters(part) if few else [])


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(5)
    middles = rng.integers(-400, 400, (16, 64))
    x = middles[rng.integers(0, 16, 3000)] + rng.integers(-20, 20, (3000, 64))
    simplex = centroids.Simplex(middles.copy())
    moved = middles + rng.integers(-5, 6, middles.shape)
    apexes = simplex.apexes(x)
    at, d, compared = centroids.nearest(x, apexes, moved, simplex)
    expected = _argmin(x, moved)
    assert np.array_equal(at, expected[0]) and np.array_equal(d, expected[1])
    assert compared < 0.25 * x.shape[0] * 16  # most centroids are never compared
    # flat and huge cases: repeated pivots, a vector far outside
    flat = centroids.Simplex(np.zeros((16, 64), np.int64))
    far = np.vstack([x, np.full((1, 64), 1 << 26)])
    for s in (simplex, flat):
        found = centroids.nearest(far, s.apexes(far), moved, s)
        assert np.array_equal(found[0], _argmin(far, moved)[0])


def _brute_codes(rows, count=64, rounds=2):
    usable, x = _integers(rows, 256)
    start = sorted((i, x[k].tolist()) for k, (i, _, _) in enumerate(usable) if i is not None)[:count]
    books = np.split(np.array([v for _, v in start], np.int64), 16, axis=1)
    parts = np.split(x, 16, axis=1)
    for _ in range(rounds):
        for p in range(16):
            at, _ = _argmin(parts[p], books[p])
            books[p] = np.array(
                [[int(s) // int((at == k).sum()) for s in parts[p][at == k].sum(axis=0)] if (at == k).any() else books[p][k] for k in range(len(books[p]))]
            )
    found = [_argmin(parts[p], books[p]) for p in range(16)]
    error = sum(d for _, d in found)
    code = ["".join(f"{found[p][0][k]:02x}" for p in range(16)) for k in range(len(x))]
    labels = [label for _, _, label in usable]
    total = {label: int(sum(e for e, other in zip(error, labels, strict=True) if other == label)) for label in set(labels)}
    sha = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel()).encode()).hexdigest()
    return sorted(((i is None, i or 0), c, int(e), total[label], sha) for (i, _, label), c, e in zip(usable, code, error, strict=True))


def _found_codes(df):
    return sorted(
        ((r["vec_id"] is None, r["vec_id"] or 0), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect()
    )


@pytest.mark.parametrize("few_labels", [10_000, 2])  # broadcast sums, and sums joined by dealt-out labels
def test_codes_equal_brute_force(spark, rows, few_labels):
    ship_code(spark)
    usable = [r for r in rows if r[1] is None or len(r[1]) not in (48,)]
    assert _found_codes(ballcodes.codes(spark, _frame(spark, usable), few=few_labels)) == _brute_codes(usable)


@pytest.mark.parametrize("few", [0, 1, 9])
def test_codes_of_few_vectors(spark, rows, few):
    ship_code(spark)
    part = rows[395 : 395 + few] + [r for r in rows[-6:] if not r[1] or len(r[1]) == 64]
    assert _found_codes(ballcodes.codes(spark, _frame(spark, part))) == (_brute_codes(part) if few else [])


def test_codes_without_labels(spark, rows):
    ship_code(spark)
    df = _frame(spark, rows).drop("label")
    found = _found_codes(ballcodes.codes(spark, df))
    assert found == _brute_codes([(i, v, None) for i, v, _ in rows])


@pytest.mark.parametrize("high", [3, 1 << 23])  # many ties; sums that double precision cannot hold
def test_balls_equal_full_comparison(high):
    rng = np.random.default_rng(8)
    x = rng.integers(-high, high, (2000, 4))
    entries = rng.integers(-high, high, (64, 4))
    entries[10] = entries[5]
    at, _ = _argmin(x, rng.integers(-high, high, (64, 4)))
    radius = np.zeros(64)
    np.maximum.at(radius, at, np.sqrt(((x - entries[at]) ** 2).sum(axis=1)))
    balls = ballcodes.Balls.around(entries, radius)
    now, d, _ = balls.moved(x, at)
    expected = _argmin(x, entries)
    assert np.array_equal(now, expected[0]) and np.array_equal(d, expected[1])
    assert np.array_equal(ballcodes.distances(x, entries), ((x[:, None] - entries[None]) ** 2).sum(axis=2))


def test_stable_cores_skip_work():
    rng = np.random.default_rng(9)
    entries = rng.integers(-1000, 1000, (64, 4))
    at = rng.integers(0, 64, 5000)
    x = entries[at] + rng.integers(-15, 16, (5000, 4))
    radius = np.zeros(64)
    np.maximum.at(radius, at, np.sqrt(((x - entries[at]) ** 2).sum(axis=1)))
    now, _, compared = ballcodes.Balls.around(entries, radius).moved(x, at)
    assert np.array_equal(now, _argmin(x, entries)[0]) and compared < len(x)
