"""Benchmark decontamination: Wu-Manber search for the benchmark's windows in all texts.

Texts are searched as sequences of words. All windows of one length form one searcher: for every block of words it
has a shift, how far the search may move on because no window can end sooner, kept in a table by the block's hash.
Only where the shift is zero the block ends some window; its hash selects a bucket of windows, and the window found
there by its whole hash is compared word by word. Benchmarks larger than a block of text are searched in several
blocks, one at a time, and what each finds in a document is put together.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.session import scratch_path

WINDOW = 10
BLOCK = 3  # words of a shift table's blocks
BLOCK_BYTES = 16 << 20  # benchmark text searched at a time: its tables are sent to the executors
SLICE = 4096  # windows of a long item are made from slices of so many words
SEGMENT = 1 << 20  # words of a text searched at a time
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd, of the golden ratio
#: a-z, 0-9 and all bytes of characters beyond ASCII stay, A-Z become lower case, the rest ends a word
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8."""
    return text.translate(WORD_BYTES).split()


def _mixed(h: np.ndarray) -> np.ndarray:
    return h * MULTIPLIER + (h >> np.uint64(29))


def hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` word numbers from each place on."""
    n = len(ids) - size + 1
    h = np.zeros(max(n, 0), np.uint64)
    for j in range(size if n > 0 else 0):
        h = _mixed(h ^ ids[j : j + n].astype(np.uint64))
    return h


@dataclass
class Searcher:
    """Shift table and buckets of windows that are all ``size`` words long.

    ``windows`` are rows of word numbers (from 1 on; 0 is any word that no window has), each once.
    """

    windows: np.ndarray
    size: int = field(init=False)
    block: int = field(init=False)

    def __post_init__(self):
        count, self.size = self.windows.shape
        self.block = min(BLOCK, self.size)
        # about 8 slots for each block that the windows have
        self.bits = max(8, math.ceil(math.log2(8 * max(1, count * (self.size - self.block + 1)))))
        self.bits = min(self.bits, 26)
        default = self.size - self.block + 1
        self.shift = np.full(1 << self.bits, default, np.uint8)
        for end in range(self.block, self.size + 1):  # ends nearer to the window's overwrite by their smaller shift
            slots = self._slots(self._hash(self.windows[:, end - self.block : end]))
            np.minimum.at(self.shift, slots, np.uint8(self.size - end))
        suffix = self._hash(self.windows[:, self.size - self.block :])
        whole = self._hash(self.windows)
        order = np.lexsort((whole, suffix))
        self.suffix, self.whole, self.order = suffix[order], whole[order], order

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        h = np.zeros(len(rows), np.uint64)
        for j in range(rows.shape[1]):
            h = _mixed(h ^ rows[:, j].astype(np.uint64))
        return h

    def _slots(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(first word, window) of all occurrences."""
        found: list[tuple[int, int]] = []
        for a in range(0, max(0, len(ids) - self.size + 1), SEGMENT):
            found.extend((a + at, w) for at, w in self._find(ids[a : a + SEGMENT + self.size - 1]))
        return found

    def _find(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        blocks = hashes(ids, self.block)
        shift = self.shift[self._slots(blocks)].tobytes()
        at, end = self.size - self.block, len(shift)  # of the block that a window would end with
        while at < end:
            step = shift[at]
            if step:
                at += step
                continue
            yield from self._compared(ids, at, blocks[at])
            at += 1

    def _compared(self, ids: np.ndarray, at: int, suffix: np.uint64) -> Iterator[tuple[int, int]]:
        low, high = np.searchsorted(self.suffix, suffix), np.searchsorted(self.suffix, suffix, side="right")
        if low == high:
            return
        start = at - (self.size - self.block)
        here = ids[start : start + self.size]
        whole = self._hash(here[None, :])[0]
        bucket = self.whole[low:high]
        for place in range(low + np.searchsorted(bucket, whole), low + np.searchsorted(bucket, whole, side="right")):
            window = int(self.order[place])
            if np.array_equal(self.windows[window], here):
                yield start, window


@dataclass
class Block:
    """The windows of some items, ready to be searched for."""

    vocabulary: dict[bytes, int]
    searchers: list[Searcher]
    owners: list[list[tuple[str, ...]]]  # of each searcher's windows: the items that have it

    @classmethod
    def of(cls, items: Iterable[tuple[str | None, bytes]]) -> Block:
        """``items``: (item_id, words between single spaces)."""
        vocabulary: dict[bytes, int] = {}
        held: dict[int, dict[bytes, set[str]]] = {}
        for item, text in items:
            ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in text.split()], np.int32)
            size = min(WINDOW, len(ids))
            windows = held.setdefault(size, {})
            for i in range(len(ids) - size + 1):
                owner = windows.setdefault(ids[i : i + size].tobytes(), set())
                if item is not None:
                    owner.add(item)
        searchers, owners, same = [], [], {}
        for size, windows in sorted(held.items()):
            searchers.append(Searcher(np.frombuffer(b"".join(windows), np.int32).reshape(len(windows), size)))
            owners.append([same.setdefault(t, t) for t in (tuple(sorted(o)) for o in windows.values())])
        return cls(vocabulary, searchers, owners)

    def numbers(self, text: bytes) -> np.ndarray:
        """The text's words as numbers, 0 for those that no window has."""
        get = self.vocabulary.get
        found, spaced = [], text.translate(WORD_BYTES)
        step = 1 << 22  # bytes: a very long text is cut where a word ends
        a = 0
        while a < len(spaced):
            b = spaced.find(b" ", a + step) if a + step < len(spaced) else -1
            piece = spaced[a : b if b >= 0 else len(spaced)]
            found.append(np.array([get(w, 0) for w in piece.split()], np.int32))
            a += len(piece) + 1
        return np.concatenate(found) if found else np.zeros(0, np.int32)

    def search(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """(words, hit runs of words as (start, end), items)."""
        ids = self.numbers(text)
        hit, owners = [], set()
        for searcher, owner in zip(self.searchers, self.owners, strict=True):
            for start, window in searcher.find(ids):
                hit.append((start, start + searcher.size))
                owners.add(owner[window])
        return len(ids), union(hit), {i for o in owners for i in o}


def union(runs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching runs put together."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def sliced(items: DataFrame) -> DataFrame:
    """(item, words): item ids as text and slices of the items' words that hold all their windows, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ws = words(text or b"")
                for a in range(0, max(1, len(ws) - WINDOW + 1), SLICE) if ws else ():
                    ids.append(item)
                    out.append(b" ".join(ws[a : a + SLICE + WINDOW - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.binary())], names=["item", "words"])

    picked = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").cast("binary").alias("text"))
    return picked.mapInArrow(run, "item string, words binary").distinct()


def item_blocks(spark: SparkSession, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_bytes`` of text; the driver holds one at a time."""
    path = scratch_path(spark, "benchmark")
    sliced(items).write.parquet(path)
    stored = spark.read.parquet(path)
    total = stored.agg(F.coalesce(F.sum(F.length("words")), F.lit(0)).alias("n")).first()["n"]
    count = max(1, math.ceil(total / block_bytes))
    for k in range(count):
        part = stored.where(F.pmod(F.xxhash64("item", "words"), F.lit(count)) == k)
        yield Block.of((r["item"], bytes(r["words"])) for r in part.collect())


def _searched(spark: SparkSession, docs: DataFrame, block: Block) -> DataFrame:
    """``docs`` (id, text in UTF-8) as (id, n_words, starts, ends, items)."""
    sent = spark.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = sent.value
        for batch in batches:
            rows = [here.search(text.as_py() or b"") for text in batch.column(1)]
            runs = [r for _, r, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.array([[a for a, _ in r] for r in runs], pa.list_(pa.int64())),
                    pa.array([[b for _, b in r] for r in runs], pa.list_(pa.int64())),
                    pa.array([sorted(i) for _, _, i in rows], pa.list_(pa.string())),
                ],
                names=["id", "n_words", "starts", "ends", "items"],
            )

    return docs.mapInArrow(run, "id long, n_words long, starts array<long>, ends array<long>, items array<string>")


def _merged(pieces: DataFrame) -> DataFrame:
    """What several blocks found in a document (starts, ends, items as lists of lists), put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends, items = (batch.column(i).to_pylist() for i in (2, 3, 4))
            runs = [
                union((a, b) for s, e in zip(many, ends[i], strict=True) for a, b in zip(s, e, strict=True))
                for i, many in enumerate(starts)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array([[a for a, _ in r] for r in runs], pa.list_(pa.int64())),
                    pa.array([[b for _, b in r] for r in runs], pa.list_(pa.int64())),
                    pa.array([sorted({x for i in many for x in i}) for many in items], pa.list_(pa.string())),
                ],
                names=["id", "n_words", "starts", "ends", "items"],
            )

    return pieces.mapInArrow(run, "id long, n_words long, starts array<long>, ends array<long>, items array<string>")


def occurrences(spark: SparkSession, docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, starts, ends, items) of each document: the hit runs of words, and the items found.

    ``id`` is the doc_id. Documents that several blocks of the benchmark are searched for are numbered and stored,
    and only what each block finds is joined, by the number.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").cast("binary").alias("text"))
    blocks = item_blocks(spark, items, block_bytes)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _searched(spark, texts, first)
    path = scratch_path(spark, "numbered")
    texts.select(F.monotonically_increasing_id().alias("row"), F.col("id").alias("doc_id"), "text").write.parquet(path)
    numbered = spark.read.parquet(path)
    found, block = [], first
    while block is not None:
        path = scratch_path(spark, "hits")
        part = _searched(spark, numbered.select(F.col("row").alias("id"), "text"), block)
        # the first block's rows are all kept: they have the documents' numbers of words
        (part if not found else part.where("size(starts) > 0")).write.parquet(path)
        found.append(spark.read.parquet(path))
        block = second if len(found) == 1 else next(blocks, None)
    pieces = found[0]
    for part in found[1:]:
        pieces = pieces.unionByName(part)
    lists = [F.collect_list(F.struct("starts", "ends", "items")).alias("m"), F.max("n_words").alias("n_words")]
    merged = _merged(pieces.groupBy("id").agg(*lists).select("id", "n_words", "m.starts", "m.ends", "m.items"))
    named = numbered.select("row", "doc_id").join(merged, F.col("row") == F.col("id"))
    return named.select(F.col("doc_id").alias("id"), "n_words", "starts", "ends", "items")


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document.

    A document or item whose text is null or has no word has no words: it is not hit, and hits nothing. Very long
    texts are searched whole, in segments that overlap by a window; very long items in slices that do. Items given
    twice count once, by their id; items without an id hit words but are no item of the result. Rows given twice
    give two rows. Without documents there are no rows, without benchmark items no hits. Other columns are ignored.
    """
    found = occurrences(spark, docs, items, block_bytes)
    n_hit = F.expr("aggregate(zip_with(ends, starts, (b, a) -> b - a), 0L, (s, n) -> s + n)")
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
