"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie with two roots: pieces that begin a word, and pieces that continue one. Each
node has a failure link and the number of pieces that leave the front of the word when the link is
followed; both are computed once, breadth first. A word is then read once, left to right, and its
piece count is the sum of the popped counts: no piece is built and no character is read again.
The word mark may be a piece of its own (an empty initial piece): then a word that no longer initial piece
begins is the mark and continuing pieces. A word that the vocabulary cannot cover counts as one unknown token.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from txnscope.llm.text import documents, text_blocks

BLOCK_CHARS = 4_000_000
CACHE_WORDS = 400_000
NONE = -1
START, CONTINUE = 0, 1  # the two roots


class CountAutomaton:
    def __init__(self, initial: Iterable[str], continuing: Iterable[str]):
        self.child: list[dict[str, int]] = [{}, {}]
        final = [False, False]
        lone_mark = False
        for root, pieces in ((START, initial), (CONTINUE, continuing)):
            for piece in pieces:
                node = root if piece else NONE
                lone_mark |= root == START and not piece
                for c in piece:
                    at = self.child[node].get(c)
                    if at is None:
                        at = self.child[node][c] = len(self.child)
                        self.child.append({})
                        final.append(False)
                    node = at
                if node != NONE:
                    final[node] = True
        n = len(self.child)
        self.fail, self.popped = [NONE] * n, [0] * n
        if lone_mark:  # the mark is popped, the word's characters are still to come
            self.fail[START], self.popped[START] = CONTINUE, 1
        queue = deque([START, CONTINUE])
        while queue:
            v = queue.popleft()
            for c, u in self.child[v].items():
                queue.append(u)
                if final[u]:  # the whole node is a piece: it pops itself
                    self.fail[u], self.popped[u] = CONTINUE, 1
                    continue
                z, pops = self.fail[v], self.popped[v]
                while z != NONE and c not in self.child[z]:
                    pops += self.popped[z]
                    z = self.fail[z]
                if z != NONE:
                    self.fail[u], self.popped[u] = self.child[z][c], pops

    def count(self, word: str) -> int:
        """Pieces of the greedy longest-match split; 0 if there is none."""
        child, fail, popped = self.child, self.fail, self.popped
        v, n = START, 0
        for c in word:
            while (u := child[v].get(c)) is None:
                if fail[v] == NONE:
                    return 0
                n += popped[v]
                v = fail[v]
            v = u
        while v != CONTINUE:  # the word's end: no child matches any more
            if fail[v] == NONE:
                return 0
            n += popped[v]
            v = fail[v]
        return n


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """(initial, continuing) pieces of a sentencepiece model; its byte and control pieces stay out.

    Initial pieces come without their word mark; the lone mark is the empty piece.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    pieces = [model.id_to_piece(i) for i in ids]
    mark = "▁"
    return [p[1:] for p in pieces if p[0] == mark], [p for p in pieces if p[0] != mark]


def token_counts(spark: SparkSession, docs: DataFrame, initial: list[str], continuing: list[str]) -> DataFrame:
    """Per document: doc_id, n_words, n_tokens, n_unknown over its whole text.

    Words are runs of characters other than ASCII white space. An unknown word is one token. Null and
    empty texts have no words. Rows that repeat give a row each. The automaton is broadcast: its size is
    the vocabulary's. The word cache is emptied at a set size.
    """
    automaton = spark.sparkContext.broadcast(CountAutomaton(initial, continuing))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, cache = automaton.value.count, {}
        for batch in batches:
            for first, texts in text_blocks(batch, 1, BLOCK_CHARS):
                words = [t.encode().split() for t in texts]  # bytes.split breaks at ASCII white space
                if len(cache) > CACHE_WORDS:
                    cache = {}
                for w in set().union(*words).difference(cache):
                    cache[w] = count(w.decode()) or -1
                found = [list(map(cache.__getitem__, x)) for x in words]
                unknown = [x.count(-1) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array([len(x) for x in words], pa.int64()),
                        pa.array([sum(x) + 2 * u for x, u in zip(found, unknown, strict=True)], pa.int64()),
                        pa.array(unknown, pa.int64()),
                    ],
                    names=["doc_id", "n_words", "n_tokens", "n_unknown"],
                )

    return documents(docs).mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")
