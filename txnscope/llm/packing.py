"""Packing of tokenised documents into fixed-length sequences by a configuration program.

Only the histogram of piece lengths reaches the driver: at most ``capacity`` counts, whatever the corpus
size. Over it, a covering program asks for the fewest sequences, fractions allowed, whose configurations (how
many pieces of which lengths share one sequence) cover every count. Each length has a weight that is multiplied by
``exp(STEP * (1 - covered share))``; a knapsack dynamic program over the weights prices all configurations, which gives
a lower bound of the program and, for every length, its best configuration as a new column. The rounds end when the
fractional number of sequences is within ``GAP`` of the bound, or after ``ROUNDS``. The fractions are rounded down, the rest of one carried on to the
next, and the pieces that then remain are packed best-fit. The plan is a short list of (configuration, number of
sequences); Spark numbers the pieces of each length in salted groups and looks their places up in it.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnscope.llm.bpe import Vocabulary
from txnscope.llm.text import (
    SPACED_WORDS,
    byte_symbols,
    documents,
    rare_characters,
    shuffle_width,
    text_blocks,
)
from txnscope.session import scratch_path

CAPACITY = 2048
END_ID = 0
BLOCK_CHARS = 4_000_000
CACHE_WORDS = 500_000
LENGTH_SHIFT = 40  # lengths above, rank within the length below
GAP = 0.003  # the fractional program is solved to this share of its lower bound
ROUNDS = 80  # of pricing at most, which bounds the driver's work; a plan tells the gap that it reached
STEP = 10.0  # how strongly the covered share moves a weight
INNER = 100  # updates of the columns' uses between two pricings
NEAR = 0.01  # a length's best configuration becomes a column if its value is at most this share below one sequence


class SpacedEncoder:
    """Whole-text ids of a byte-level BPE whose words carry their leading space.

    Texts of common characters are split and merged in one call each. In the others, words with rare characters are
    encoded by the library, once each and remembered, and the stretches between them in one call: a text
    may be cut before a space that follows no white space, as no piece of the split goes on over it.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        vocab = Vocabulary.load(path)
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        special = dict(vocab.added)
        ranks = {bytes(byte_of[c] for c in t): i for i, t in enumerate(vocab.tokens) if t and t not in special}
        self.fast = tiktoken.Encoding("spaced", pat_str=SPACED_WORDS, mergeable_ranks=ranks, special_tokens={})
        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        self.special = list(special)
        self.rare = rare_characters()
        self.cut = re.compile(r"(?<=\S)(?= )")
        self.cache: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def common(self, text: str) -> bytes:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        except ValueError:  # runs of very many white spaces pass the bounds of its regular expressions
            return self.ids(text)

    def _rare_word(self, word: str) -> bytes:
        ids = self.cache.get(word)
        if ids is None:
            ids = self.cache[word] = self.ids(word)
        return ids

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        rare = self.rare
        for text in texts:
            if any(s in text for s in self.special):
                yield self.ids(text)
            elif text.isascii() or not rare.search(text):
                yield self.common(text)
            else:
                words = groupby(self.cut.split(text), lambda word: not word.isascii() and bool(rare.search(word)))
                yield b"".join(b"".join(map(self._rare_word, g)) if is_rare else self.common("".join(g)) for is_rare, g in words)


#: One encoder per Python worker: its cache serves the worker's later tasks too.
_ENCODERS: dict[str, SpacedEncoder] = {}


def token_pieces(spark: SparkSession, docs: DataFrame, vocab_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's ids and the end id, and a salt.

    Only documents over ``capacity`` are cut; then the first piece is the shorter one. Null and empty
    texts are one piece, the end id. ``salt`` deals rows out evenly, also rows that are all alike.
    """
    salts = shuffle_width(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.setdefault(vocab_path, None) or SpacedEncoder(vocab_path)
        _ENCODERS[vocab_path] = encoder
        end, n = np.array([END_ID], dtype="<u4").tobytes(), 7919 * TaskContext.get().partitionId()
        for batch in batches:
            for first, texts in text_blocks(batch, 1, BLOCK_CHARS):
                rows: list[tuple[int, int, int, int, int, int]] = []
                for i, ids in enumerate(encoder.encode(texts), first):
                    ids += end
                    total, piece, start = len(ids) // 4, 0, 0
                    while start < total:
                        length = min(capacity, (total - start) % capacity or capacity)
                        crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                        rows.append((i, piece, start, length, crc, n % salts))
                        start, piece, n = start + length, piece + 1, n + 1
                row, piece, start, length, crc, salt = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row)),
                        pa.array(piece, pa.int32()),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                        pa.array(salt, pa.int32()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "salt"],
                )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, salt int"
    return documents(docs).mapInArrow(run, schema)


@dataclass
class Plan:
    """Configurations with the number of sequences that use each.

    ``bound`` is the lower bound of the fractional program, ``fractional`` the value that it was solved to.
    """

    capacity: int
    bound: float = 0.0
    fractional: float = 0.0
    uses: list[tuple[tuple[tuple[int, int], ...], int]] = field(default_factory=list)

    def add(self, config: dict[int, int], times: int) -> None:
        if times and config:
            self.uses.append((tuple(sorted(config.items(), reverse=True)), times))

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.uses)

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys (length, first rank) and rows (first rank, copies, first sequence, offset)."""
        rows, taken, base = [], {}, 0
        for config, times in self.uses:
            offset = 0
            for length, copies in config:
                rank = taken.get(length, 0)
                rows.append((length << LENGTH_SHIFT | rank, rank, copies, base, offset))
                taken[length] = rank + copies * times
                offset += length * copies
            base += times
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
        return table[:, 0].copy(), table[:, 1:].copy()


def price(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Per room up to ``capacity`` the value of the best configuration and the index of its last piece (-1: the best
    of one token less): unbounded knapsack by dynamic programming."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        k = upto[c]
        best[c] = best[c - 1]
        if k:
            total = best[c - lengths[:k]] + values[:k]
            j = k - 1 - int(total[::-1].argmax())  # of equal values the longest piece
            if total[j] > best[c]:
                best[c], choice[c] = total[j], j
    return best, choice


def configurations(lengths: np.ndarray, choice: np.ndarray, first: np.ndarray) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """For each index in ``first`` the best configuration with that piece, as (indexes, copies)."""
    filled = np.maximum.accumulate(np.where(choice >= 0, np.arange(len(choice)), 0))
    at, room = np.arange(len(first)), filled[len(choice) - 1 - lengths[first]]
    configs, pieces = [at], [first]
    while True:
        at, room = at[room > 0], room[room > 0]
        if not len(at):
            break
        configs.append(at)
        pieces.append(choice[room])
        room = filled[room - lengths[choice[room]]]
    key, copies = np.unique(np.concatenate(configs) * len(lengths) + np.concatenate(pieces), return_counts=True)
    ends = np.flatnonzero(np.diff(key // len(lengths))) + 1
    parts = zip(np.split(key % len(lengths), ends), np.split(copies, ends), strict=True)
    return [(tuple(i.tolist()), tuple(k.tolist())) for i, k in parts]


class Covering:
    """The fractional covering program over the counts of ``lengths``, solved by multiplicative weights.

    A piece's weight starts at its share of the capacity, which no configuration exceeds in sum; the first columns are
    those of a plan that covers all, such as best-fit's, as a feasible start. ``uses`` of the columns
    rise while their pieces' weights sum to more than one sequence and fall while to less. After each pricing the
    weights reached become the new starting weights, so coverage tends to one and the weights to an optimal dual.
    """

    def __init__(self, lengths: np.ndarray, counts: np.ndarray, capacity: int):
        self.lengths, self.counts, self.capacity = lengths, counts.astype(float), capacity
        self.weights = lengths / capacity
        self.columns: dict[tuple[tuple[int, ...], tuple[int, ...]], int] = {}
        self.uses = np.zeros(0)
        self.column, self.piece, self.copies = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.bound, self.value = 0.0, np.inf
        self.best_uses = self.uses

    def start(self, plan: Plan) -> None:
        """Columns and uses of a plan that covers all counts."""
        at = {x: i for i, x in enumerate(self.lengths.tolist())}
        uses: dict[tuple[tuple[int, ...], tuple[int, ...]], int] = {}
        for config, times in plan.uses:
            pieces, copies = zip(*sorted((at[x], k) for x, k in config), strict=True)
            uses[pieces, copies] = uses.get((pieces, copies), 0) + times
        self._add(list(uses), 0.0)
        self.uses = self.best_uses = np.array(list(uses.values()), float)
        self.value = float(self.uses.sum())

    def _add(self, configs: list, each: float) -> None:
        column, piece, copies = [self.column], [self.piece], [self.copies]
        for config in configs:
            if config not in self.columns:
                column.append(np.full(len(config[0]), len(self.columns)))
                piece.append(np.array(config[0]))
                copies.append(np.array(config[1], float))
                self.columns[config] = len(self.columns)
        self.column, self.piece, self.copies = (np.concatenate(a) for a in (column, piece, copies))
        self.uses = np.append(self.uses, np.full(len(self.columns) - len(self.uses), each))

    def _covered(self) -> np.ndarray:
        return np.bincount(self.piece, self.copies * self.uses[self.column], len(self.counts)) / self.counts

    def _weights(self, covered: np.ndarray) -> np.ndarray:
        return self.weights * np.exp((STEP * (1 - covered)).clip(-30, 30))

    def price(self) -> None:
        """One pricing: the bound, new columns, then their uses and the weights."""
        best, choice = price(self.lengths, self.weights, self.capacity)
        self.bound = max(self.bound, float(self.counts @ self.weights) / best[-1])
        value = self.weights + best[self.capacity - self.lengths]
        near = np.flatnonzero(value >= min(best[-1], 1.0) * (1 - NEAR))
        # new columns enter small, the smaller the closer the value is to the bound
        entering = min(0.02, (self.value / self.bound - 1) / 4) * self.bound
        self._add(configurations(self.lengths, choice, near), entering / len(self.lengths))
        for _ in range(INNER):
            worth = np.bincount(self.column, self.copies * self._weights(self._covered())[self.piece], len(self.uses))
            self.uses = self.uses * np.exp((worth - 1).clip(-1, 1) / (2 * STEP))
        covered = self._covered()
        self.weights = self._weights(covered).clip(1e-9, 1e9)
        # what is short is covered by sequences of one length, or everything is used a little more
        short = (self.counts * (1 - covered).clip(0) / (self.capacity // self.lengths)).sum()
        total = float(self.uses.sum())
        value = min(total + short, total / covered.min() if covered.min() > 0 else np.inf)
        if value < self.value:
            self.value, self.best_uses = value, self.uses

    def solve(self) -> None:
        """Rounds until the value is within GAP, or one sequence, of the bound; ROUNDS at most."""
        for _ in range(ROUNDS):
            self.price()
            if self.value <= self.bound + max(self.bound * GAP, 1.0):
                return

    def rounded(self) -> Iterator[tuple[dict[int, int], int]]:
        """Whole uses of configurations that cover no count twice, most used first."""
        left, carry = self.counts.astype(np.int64), 0.0
        uses, configs = self.best_uses, list(self.columns)
        for j in np.argsort(-uses, kind="stable").tolist():
            carry += uses[j]
            if carry < 1 - 1e-6:
                continue
            pieces, copies = (np.array(a) for a in configs[j])
            times = min(int(carry + 1e-6), int((left[pieces] // copies).min()))
            if times:
                left[pieces] -= times * copies
                carry -= times
                yield dict(zip(self.lengths[pieces].tolist(), copies.tolist(), strict=True)), times


def best_fit(plan: Plan, left: dict[int, int]) -> None:
    """Pack the remaining counts, longest first, each into the fullest open sequences that fit."""
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}
    rooms: list[int] = []  # of the open sequences, ascending

    def put(room: int, config: dict[int, int], uses: int) -> None:
        if room not in open_:
            open_[room] = []
            bisect.insort(rooms, room)
        open_[room].append((config, uses))

    for length in sorted((x for x, n in left.items() if n), reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                config, times, room = {}, -(-n // (plan.capacity // length)), plan.capacity
            else:
                room = rooms[at]
                config, times = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            each = room // length
            full, rest = min(times, n // each), 0
            if full < times:
                rest = n - full * each
            for copies, uses in ((each, full), (rest, 1 if rest else 0), (0, times - full - (1 if rest else 0))):
                if uses and copies:
                    put(room - copies * length, {**config, length: config.get(length, 0) + copies}, uses)
                elif uses and config:
                    put(room, config, uses)
            n -= full * each + rest
    for groups in open_.values():
        for config, times in groups:
            plan.add(config, times)


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Sequences for the counts of each length; every count is covered exactly.

    Pieces as long as a sequence have one each; for the others the covering program is solved and rounded, and what
    the rounding leaves is packed best-fit.
    """
    left = {x: n for x, n in histogram.items() if n}
    plan = Plan(capacity)
    if capacity in left:
        plan.add({capacity: 1}, left.pop(capacity))
    plan.bound = plan.fractional = float(plan.sequences)
    if left:
        lengths = np.array(sorted(left), dtype=np.int64)
        program = Covering(lengths, np.array([left[x] for x in lengths.tolist()]), capacity)
        start = Plan(capacity)
        best_fit(start, left)
        program.start(start)
        program.solve()
        plan.bound, plan.fractional = plan.bound + program.bound, plan.fractional + program.value
        for config, times in program.rounded():
            plan.add(config, times)
            for x, k in config.items():
                left[x] -= k * times
        best_fit(plan, left)
    return plan


def pack(spark: SparkSession, docs: DataFrame, vocab_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The tokenised pieces (a few numbers each) are written once to the shared checkpoint folder, for the
    histogram and the numbering. Rows with a null doc_id and repeated rows are pieces like any other. An empty
    table gives no rows.
    """
    path = scratch_path(spark, "pieces")
    token_pieces(spark, docs, vocab_path, capacity).write.parquet(path)
    pieces = spark.read.parquet(path)
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.sparkContext.broadcast(make_plan(histogram, capacity).places())

    group = Window.partitionBy("length", "salt")
    ranked = pieces.withColumn("local", F.row_number().over(group.orderBy("doc_id", "piece", "start", "ids_crc32")) - 1)
    counts = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = ranked.join(counts, ["length", "salt"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows = places.value
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = rows[np.searchsorted(keys, length << LENGTH_SHIFT | rank, side="right") - 1]
            ahead, copies = rank - at[:, 0], at[:, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(5)),
                    pa.array(at[:, 2] + ahead // copies, pa.int64()),
                    pa.array(at[:, 3] + ahead % copies * length, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.mapInArrow(place, schema)
