"""The parts of the nearest-neighbour search against brute force, and what the search keeps on disk."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa

from txnscope.llm import neighbours
from txnscope.llm.text import ship_code
from txnscope.session import shared_root


def _vectors(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")


def _apart(x, y):
    return ((x[:, None, :].astype(float) - y[None, :, :].astype(float)) ** 2).sum(axis=2)


def _recall(got, x, every):
    hits = 0
    for q in range(0, len(x), every):
        d = ((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(d)[:10].tolist()))
    return hits / (10 * len(range(0, len(x), every)))


def test_disk_follows_the_table_over_several_blocks(spark, monkeypatch):
    ship_code(spark)
    monkeypatch.setattr(neighbours, "BLOCK", 750)
    x = np.random.default_rng(5).standard_normal((6000, 64)).astype(np.float32)
    root = Path(shared_root(spark).removeprefix("file:")) / "txnscope"
    before = set(root.glob("*"))
    got = neighbours.nearest(spark, _vectors(spark, x)).collect()
    left = [f for d in set(root.glob("*")) - before for f in d.rglob("*.parquet")]
    # nodes, shelves and what the queries found; no round's edges and no vectors in double precision
    assert sum(f.stat().st_size for f in left) < 5 * x.nbytes
    assert len(got) == 600 and _recall(got, x, 100) >= 0.9


def test_descent_finds_the_neighbours_in_a_block():
    x = np.random.default_rng(6).standard_normal((3000, 16)).astype(np.float32)
    none = np.full((3000, 20), np.inf, np.float32)
    rows = neighbours._descended(x, np.random.default_rng(1), np.zeros(0, np.uint64), none, 20, 12)
    v, d = neighbours._unpacked(rows)
    true = _apart(x[::50], x)
    true[np.arange(60), np.arange(0, 3000, 50)] = np.inf
    want = np.argsort(true, axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(v[::50].tolist(), want.tolist(), strict=True)]) >= 19
    assert (v != np.arange(3000)[:, None]).all() and (np.diff(d, axis=1) >= 0).all()
    assert all(len(set(r)) == 20 for r in v.tolist())
    np.testing.assert_allclose(d, np.take_along_axis(_apart(x, x), v, axis=1), rtol=1e-3)


def test_second_deal_keeps_the_nearest_of_both():
    x = np.random.default_rng(7).standard_normal((60, 8)).astype(np.float32)
    schema = pa.schema([("block", pa.int64()), ("x", pa.binary()), ("ids", pa.list_(pa.int64())), ("asked", pa.bool_())])
    parts = []
    for block in range(2):
        rows = [{"block": block, "x": x[i].tobytes(), "ids": [i], "asked": False} for i in range(30 * block, 30 * block + 30)]
        parts.append(neighbours._linked(pa.Table.from_pylist(rows, schema), np.float32, 1, 6, 12))
    first = pa.concat_tables(parts)
    ids = first.column("node").to_numpy()
    x = neighbours._matrix(first.column("x"), stored=np.float32)
    dealt = np.arange(60) % 2  # other blocks, of half of each
    near = {}
    for block in range(2):
        part = first.filter(pa.array(dealt == block)).select(["node", "x", "near", "d"]).append_column("block", pa.array([block] * 30))
        again = neighbours._linked(part, np.float32, 2, 6, 12)
        near |= dict(zip(again.column("node").to_pylist(), neighbours._numbers(again.column("near")).tolist(), strict=True))
    d = _apart(x, x)
    for i in range(60):
        met = [j for j in range(60) if j != i and (ids[j] >> neighbours.SHIFT == ids[i] >> neighbours.SHIFT or dealt[j] == dealt[i])]
        assert set(near[ids[i]]) == {ids[j] for j in sorted(met, key=lambda j: d[i, j])[:6]}


def _shelf(x, kind):
    rows = [{"block": 3, "x": v.tobytes(), "ids": [i], "asked": False} for i, v in enumerate(x)]
    table = neighbours._linked(pa.Table.from_pylist(rows), kind, 1, 8, 12)
    row = neighbours._shelved(table.select(["node", "x", "near"]).append_column("block", pa.array([3] * len(x))), kind, 8).to_pylist()[0]
    return neighbours.Shelf(*(row[n] for n in ("x", "ends", "to", "far_ends", "far")), kind)


def test_walk_finds_what_is_nearer_than_the_bound():
    for kind in (np.float32, np.float64):
        rng = np.random.default_rng(8)
        shelf = _shelf((rng.standard_normal((500, 6)) + 100).astype(kind), kind)
        queries = (rng.standard_normal((5, 6)) + 100).astype(kind)
        true = _apart(queries, shelf.x)
        bound = np.sort(true, axis=1)[:, 59:61].mean(axis=1)
        empty, asked = np.zeros(0, np.int64), np.arange(5) * 500 + np.argmin(true, axis=1)
        q, v, d, state, _, _ = shelf.walk(queries, bound, np.full(5, 500), (empty, empty, empty, asked), 500)
        for i in range(5):
            want = np.flatnonzero(true[i] < bound[i])
            assert len(set(want) & set(v[q == i])) >= 57 and set(v[q == i]) <= set(want)
        np.testing.assert_allclose(d, true[q, v], rtol=1e-4 if kind is np.float32 else 1e-12)
        assert (state == neighbours.KNOWN).all()
        # all nodes at once, by the product
        q, v, _, _, _, _ = shelf.walk(queries, bound, np.full(5, 0), (empty, empty, empty, np.arange(2500)), 500)
        assert [set(v[q == i]) for i in range(5)] == [set(np.flatnonzero(true[i] < bound[i])) for i in range(5)]


def test_vectors_far_from_the_origin_and_a_common_one(spark, monkeypatch):
    ship_code(spark)
    monkeypatch.setattr(neighbours, "BLOCK", 512)
    rng = np.random.default_rng(9)
    x = (rng.standard_normal((2000, 12)) + 1000).astype(np.float32)
    x[100:900] = x[100]
    got = neighbours.nearest(spark, _vectors(spark, x), every=50).collect()
    assert len(got) == 400
    for q in (100, 150, 850):  # copies, the smallest ids first
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [i for i in range(100, 112) if i != q][:10]
    others = [q for q in range(0, 2000, 50) if not 100 <= q < 900]
    hits = 0
    for q in others:
        d = ((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1)
        want = [i for i in np.lexsort((np.arange(2000), d)).tolist() if i != q][:10]
        rows = {r.vec_id: r.score for r in got if r.query_id == q}
        hits += len(set(rows) & set(want))
        assert all(abs(s - np.sqrt(d[i])) < 1e-9 for i, s in rows.items())
    assert hits / (10 * len(others)) >= 0.9
