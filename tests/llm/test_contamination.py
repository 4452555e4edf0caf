"""Benchmark decontamination against a plain scan: short items, blocks, slices, long texts, bad rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from txnscope.llm import contamination
from txnscope.llm.text import ship_code

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text):
    return WORD.findall((text or "").translate(UPPER))


def _brute(docs, items):
    windows: dict[tuple, set] = {}
    for item, text in items:
        ws = _words(text)
        n = min(10, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        ws, hit, found = _words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(ws) - n + 1):
                if (w := tuple(ws[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[w]
        ids = sorted(str(i) for i in found if i is not None)
        out.append(((doc is None, doc or 0), len(ws), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def _found(df):
    return sorted(
        ((r["doc_id"] is None, r["doc_id"] or 0), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
        for r in df.collect()
    )


def _tables(spark, docs, items):
    ship_code(spark)
    d = spark.createDataFrame([(i, t, "w", 1, "r", "i") for i, t in docs], "doc_id long, text string, words string, row int, id string, item string")
    b = spark.createDataFrame([(i, t, 3, "i") for i, t in items], "item_id long, text string, words int, item string")
    return d, b


@pytest.fixture(scope="module")
def data():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)] + ["straße", "日本", "É", "naïve"]

    def some(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [(i, " ".join(some(rng.randint(8, 40)))) for i in range(60)]
    items += [(60, "Question: what is 12 plus 30? the answer follows here now"), (61, "same  same"), (61, "same same"), (62, "x"), (9, items[9][1])]
    items += [(63, None), (64, " -- "), (None, "an item without any id but with more than ten words in it"), (65, " ".join(some(9000)))]
    docs = [(i, " ".join(some(rng.randint(0, 200)))) for i in range(80)]
    for i in range(40):
        text = items[rng.randrange(61)][1].split(" ")
        at = rng.randrange(len(text))
        docs.append((100 + i, " ".join(some(30) + text[at : at + 25] + some(5)).upper() if i % 2 else "-".join(text)))
    long = items[65 + 3][1].split(" ")
    docs += [(200, "the same, SAME thing x"), (201, None), (202, ""), (203, "...\x00\x7f"), (None, "an item without any id but with more than ten words in it")]
    docs += [(204, " ".join(long[4080:4130])), (205, "x" * 300_000 + " " + " ".join(some(60_000)) + " x"), (205, "same same"), (206, "same " * 5000)]
    return docs, items


@pytest.mark.parametrize("block_bytes", [contamination.BLOCK_BYTES, 2000])
def test_equals_brute_force(spark, data, block_bytes):
    docs, items = data
    assert _found(contamination.contamination(spark, *_tables(spark, docs, items), block_bytes)) == _brute(docs, items)


def test_empty_tables(spark, data):
    docs, items = data
    d, b = _tables(spark, docs[:30], items[:3])
    assert _found(contamination.contamination(spark, d, b.limit(0))) == _brute(docs[:30], [])
    assert contamination.contamination(spark, d.limit(0), b).collect() == []


def test_segments_and_pieces(monkeypatch, data):
    docs, items = data
    spaced = [(str(i) if i is not None else None, " ".join(_words(t)).encode()) for i, t in items if _words(t)]
    block = contamination.Block.of(spaced)
    whole = [block.search((t or "").encode()) for _, t in docs]
    monkeypatch.setattr(contamination, "SEGMENT", 7)
    assert [block.search((t or "").encode()) for _, t in docs[:120]] == whole[:120]


def test_shifts_skip_places():
    rng = np.random.default_rng(1)
    searcher = contamination.Searcher(rng.integers(1, 5000, (2000, 10), dtype=np.int32))
    shift = searcher.shift[searcher._slots(contamination.hashes(rng.integers(1, 5000, 50_000, dtype=np.int32), 3))]
    assert shift.mean() > 6  # of at most 8
