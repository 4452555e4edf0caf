"""BPE encoding by a pair-occurrence index, and decoding.

Within a block of rows the distinct words are laid out once, symbol after symbol. The index maps each
mergeable pair, named by its rank, to all positions where it stands. Ranks are applied in ascending
order, each to all of its positions at once; the pairs that a merge creates on its left and right
join the lists of their own ranks, and entries that a merge made stale are recognised by their
symbols and skipped. A pair that contains a merged token always ranks behind the merge that made
the token, so ascending order over the block equals lowest-rank-first within each word.

Words are independent of each other, so no data moves between tasks: the job is one map over the
table. Memory holds one block's words and a cache of encoded words that is emptied at a set size
(emptying costs time only, never results).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from txnscope.llm.text import (
    byte_symbols,
    documents,
    lower_word_pattern,
    rare_characters,
    rare_lower_words,
    text_blocks,
)

BLOCK_CHARS = 4_000_000
CACHE_WORDS = 500_000


@dataclass(frozen=True)
class Vocabulary:
    """A BPE vocabulary as arrays. Its size is that of the vocabulary file, not of the data."""

    tokens: tuple[str, ...]  # by id
    inner: np.ndarray  # id of each byte inside a word
    final: np.ndarray  # id of each byte at a word's end
    keys: np.ndarray  # left id << 32 | right id, ascending
    ranks: np.ndarray  # rank of each key
    rank_of: dict[int, int]  # rank by left id << 32 | right id
    rules: list[tuple[int, int, int]]  # by rank: left, right and merged id
    added: tuple[tuple[str, int], ...]  # special tokens and their ids

    @staticmethod
    def load(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"].get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        added = tuple((a["content"], a["id"]) for a in spec["added_tokens"])
        tokens = [""] * (1 + max([*vocab.values(), *(i for _, i in added)]))
        for token, i in [*vocab.items(), *added]:
            tokens[i] = token
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = left << 32 | right
        order = np.argsort(keys)
        return Vocabulary(
            tokens=tuple(tokens),
            inner=np.array([vocab[c] for c in byte_symbols()], dtype=np.int64),
            final=np.array([vocab[c + suffix] for c in byte_symbols()], dtype=np.int64),
            keys=keys[order],
            ranks=order.astype(np.int64),
            rank_of={k: r for r, k in enumerate(keys.tolist())},
            rules=list(zip(left.tolist(), right.tolist(), merged.tolist(), strict=True)),
            added=added,
        )

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the pair never merges."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)


class PairIndex:
    """Positions of every active pair in one block of words.

    The symbols and their links lie in arrays that Python and numpy share: long position lists are
    merged by array operations, short ones (most ranks have a few positions) one by one.
    """

    LONG = 40

    def __init__(self, vocab: Vocabulary, symbols: np.ndarray, ends: np.ndarray):
        n = len(symbols)
        follow = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        last = np.flatnonzero(ends)
        follow[last] = -1
        before[last[:-1] + 1] = -1
        self.vocab = vocab
        self.flat = [array("q", x.astype(np.int64).tobytes()) for x in (symbols, follow, before)]
        self.sym, self.next, self.prev = (np.frombuffer(x, dtype=np.int64) for x in self.flat)
        self.lists: dict[int, list[int]] = {}
        self.active: list[int] = []
        self.add(np.flatnonzero(~ends))

    def add(self, at: np.ndarray) -> None:
        """Enter the pairs that start at these positions under their ranks."""
        if not len(at):
            return
        rank = self.vocab.rank(self.sym[at], self.sym[self.next[at]])
        known = rank >= 0
        at, rank = at[known], rank[known]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        rank = rank[order]
        places = at[order].tolist()
        cuts = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist(), len(rank)]
        for r, a, b in zip(rank[cuts[:-1]].tolist(), cuts, cuts[1:], strict=False):
            if r in self.lists:
                self.lists[r] += places[a:b]
            else:
                self.lists[r] = places[a:b]
                heapq.heappush(self.active, r)

    def run(self) -> None:
        rules = self.vocab.rules
        while self.active:
            r = heapq.heappop(self.active)
            at = self.lists.pop(r)
            left, right, merged = rules[r]
            if left == right:
                at.sort()
            (self.apply_long if len(at) > self.LONG else self.apply_short)(left, right, merged, at)

    def apply_short(self, left: int, right: int, merged: int, at: list[int]) -> None:
        sym, nxt, prev = self.flat
        rank_of, lists = self.vocab.rank_of, self.lists
        for p in at:
            if sym[p] != left:
                continue
            q = nxt[p]
            if q < 0 or sym[q] != right:
                continue
            after, before = nxt[q], prev[p]
            sym[p], sym[q], nxt[p] = merged, -1, after
            if after >= 0:
                prev[after] = p
                r = rank_of.get(merged << 32 | sym[after])
                if r is not None:
                    if r in lists:
                        lists[r].append(p)
                    else:
                        lists[r] = [p]
                        heapq.heappush(self.active, r)
            if before >= 0:
                r = rank_of.get(sym[before] << 32 | merged)
                if r is not None:
                    if r in lists:
                        lists[r].append(before)
                    else:
                        lists[r] = [before]
                        heapq.heappush(self.active, r)

    def apply_long(self, left: int, right: int, merged: int, places: list[int]) -> None:
        sym, nxt, prev = self.sym, self.next, self.prev
        at = np.array(places)
        at = at[(sym[at] == left) & (nxt[at] >= 0)]
        at = at[sym[nxt[at]] == right]
        if not len(at):
            return
        if left == right:  # of overlapping pairs the leftmost merges: every other one of a run
            i = np.arange(len(at))
            begins = np.r_[True, nxt[at[:-1]] != at[1:]]
            at = at[(i - np.maximum.accumulate(np.where(begins, i, 0))) % 2 == 0]
        gone = nxt[at]
        after = nxt[gone]
        sym[at], sym[gone], nxt[at] = merged, -1, after
        has_next = after >= 0
        prev[after[has_next]] = at[has_next]
        before = prev[at]
        self.add(np.unique(np.concatenate([before[before >= 0], at[has_next]])))


def encode_words(vocab: Vocabulary, words: list[bytes]) -> list[bytes]:
    """Ids of each (non-empty) word, as little-endian unsigned 32-bit integers."""
    if not words:
        return []
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    stops = np.cumsum(lengths)
    raw = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.zeros(len(raw), dtype=bool)
    ends[stops - 1] = True
    index = PairIndex(vocab, np.where(ends, vocab.final[raw], vocab.inner[raw]), ends)
    index.run()
    alive = index.sym >= 0
    ids = index.sym[alive].astype("<u4").tobytes()
    cuts = (4 * np.cumsum(alive)[stops - 1]).tolist()
    return [ids[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]


def normalise(text: str) -> str:
    """NFC and lower case, for texts of common characters only."""
    return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).lower()


class Encoder:
    """Encodes and decodes texts with the lower-casing word BPE; keeps a cache of words."""

    def __init__(self, vocab: Vocabulary, cache_words: int = CACHE_WORDS):
        self.vocab, self.cache_words = vocab, cache_words
        self.words, self.rare = lower_word_pattern(), rare_characters()
        self.special = {text: np.array([i], dtype="<u4").tobytes() for text, i in vocab.added}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.cache: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """Words in order. A special token's own text stays one piece; no other word equals it."""
        out: list[str] = []
        for k, part in enumerate(self.cut.split(text) if "<|" in text else [text]):
            if k % 2:
                out.append(part)
            elif self.rare.search(part):
                out += rare_lower_words(part)
            else:
                out += self.words.findall(normalise(part))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        pieces = [self.pieces(t) for t in texts]
        if len(self.cache) > self.cache_words:
            self.cache = {}
        cache = self.cache
        cache.update(self.special)
        new = list(set().union(*pieces).difference(cache))
        cache.update(zip(new, encode_words(self.vocab, [w.encode() for w in new]), strict=True))
        return [b"".join(map(cache.__getitem__, p)) for p in pieces]

    def decode(self, ids: bytes) -> str:
        """The token strings with a space between (the vocabulary file names no other decoder)."""
        return " ".join(map(self.vocab.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def token_digests(spark: SparkSession, docs: DataFrame, vocab_path: str) -> DataFrame:
    """Encode every whole text, decode the ids again, and return a digest of both per document.

    Columns: doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes (of the text). A null text counts
    as empty: no tokens, digests of nothing. Rows that repeat, also with the same or a null doc_id,
    give a row each. The vocabulary is read on the driver and broadcast: a fixed file's size.
    """
    vocab = spark.sparkContext.broadcast(Vocabulary.load(vocab_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocab.value)
        for batch in batches:
            for first, texts in text_blocks(batch, 1, BLOCK_CHARS):
                encoded = encoder.encode(texts)
                decoded = (encoder.decode(x).encode() for x in encoded)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array([len(x) // 4 for x in encoded], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in encoded], pa.string()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
                        pa.array([len(t.encode()) for t in texts], pa.int64()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"],
                )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"
    return documents(docs).mapInArrow(run, schema)
