"""Removal of repeated passages by a distributed merge sort of suffixes with common-prefix reuse.

A window is any ``LENGTH`` bytes of a text. Each window names one anchor inside itself, the position whose
``GRAM`` bytes have the smallest hash; equal windows name the same place, so only the suffixes at anchors
(about one position in 35) need to be compared. Four passes, dealt by hash, none of them larger than the text:

1. chunks of documents send the hashes of their anchors, packed, to counting groups;
2. these answer which anchors occur more than once; chunks sort the suffixes at those anchors (with the bytes
   before the anchor, reversed, behind them) into runs and send the runs front-coded: of each suffix only what
   differs from the one before;
3. a group merges its runs with a loser tree that keeps each candidate's common prefix with the last winner,
   so a known prefix is never compared again. The common prefixes of the merged order give, for each distance
   between window start and anchor, the classes of equal windows; all but the first window of a class repeat;
4. the chunks get the repeated windows back and cut them out.

Occurrences whose bytes are alike in the same chunk are sent once. Anchors with very many occurrences
are not grouped by anchor but by the hash of each whole window, so that only equal windows meet; equal
ones were already reduced to one per chunk.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnscope.llm.text import shuffle_width

LENGTH = 100  # bytes of a window
GRAM = 32  # bytes hashed at an anchor
REACH = LENGTH - GRAM  # largest distance of an anchor from its window's start
ROW = LENGTH + REACH  # a suffix and the reversed bytes before it
SEGMENT = 1 << 18  # windows of a text looked at in one go
BATCH = 1 << 20  # bytes of segments looked at together
CHUNK_BYTES = 8 << 20  # text of a chunk of documents, about
HOT = 4096  # occurrences from which an anchor's windows are dealt by window

_LOW = np.uint64((1 << 21) - 1)
_MULTIPLIERS = np.random.default_rng(100).integers(1 << 62, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)
_BYTE_HASH = np.random.default_rng(101).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MULTIPLIERS[6]
    return h ^ (h >> np.uint64(32))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each position, by doubling."""
    h, width = _BYTE_HASH[raw], 1
    for level in range(GRAM.bit_length() - 1):
        h = h[: len(h) - width] * _MULTIPLIERS[level] + (h[width:] ^ (h[width:] >> np.uint64(31)))
        width *= 2
    return _mixed(h)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class Chunk:
    """The documents of a chunk in a fixed order, and their anchors."""

    def __init__(self, docs: pa.Table):
        keys = [("_id", "ascending"), ("_text", "ascending")]
        order = pc.sort_indices(docs.select(["_id", "_text"]), sort_keys=keys, null_placement="at_start")
        self.docs = docs.take(order).combine_chunks()
        self.ids = np.asarray(pc.fill_null(self.docs["_id"], np.iinfo(np.int64).min))
        texts = pc.cast(self.docs["_text"], pa.binary())
        self.texts = [memoryview(t.as_buffer()) for t in texts]
        self.size = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        self.raw = np.frombuffer(b"".join(self.texts), dtype=np.uint8)

    def segments(self) -> Iterator[list[tuple[int, int]]]:
        """(first byte, bytes) of runs of up to SEGMENT windows, some at a time; none crosses documents."""
        batch, total = [], 0
        for start, size in zip(self.first.tolist(), self.size.tolist(), strict=False):
            for p in range(0, size - LENGTH + 1, SEGMENT):
                n = min(SEGMENT + LENGTH - 1, size - p)
                if total + n > BATCH:
                    yield batch
                    batch, total = [], 0
                batch.append((start + p, n))
                total += n
        if batch:
            yield batch

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Position in ``raw``, nearest and farthest distance of the windows that name it, gram hash."""
        found = []
        for batch in self.segments():
            starts = np.array([s for s, _ in batch])
            sizes = np.array([n for _, n in batch])
            local = np.concatenate([[0], np.cumsum(sizes)])
            raw = np.concatenate([self.raw[s : s + n] for s, n in batch])
            h = gram_hashes(raw)
            # the position in the low bits makes the leftmost of equal hashes the smallest
            named = sliding_min((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), REACH + 1)
            valid = np.zeros(len(raw) + 1, dtype=np.int8)
            valid[local[:-1]] += 1
            valid[local[1:] - LENGTH + 1] -= 1
            window = np.flatnonzero(np.cumsum(valid, dtype=np.int8)[: len(named)])
            at = (named[window] & _LOW).astype(np.int64)
            cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
            near, far = window[cut[1:] - 1], window[cut[:-1]]
            at = at[cut[:-1]]
            shift = (starts - local[:-1])[np.searchsorted(local, at, side="right") - 1]
            found.append((at + shift, at - near, at - far, h[at]))
        if not found:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def contexts(self, at: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Rows of ROW bytes: the suffix as far as the windows reach, then the bytes before it, reversed."""
        out = np.zeros((len(at), ROW), dtype=np.uint8)
        for i in range(0, len(at), 65536):
            a, lo, hi = (x[i : i + 65536, None] for x in (at, near, far))
            right = np.arange(LENGTH)
            out[i : i + 65536, :LENGTH] = np.where(right < LENGTH - lo, self.raw[np.minimum(a + right, len(self.raw) - 1)], 0)
            left = np.arange(1, REACH + 1)
            out[i : i + 65536, LENGTH:] = np.where(left <= hi, self.raw[np.maximum(a - left, 0)], 0)
        return out

    def occurrences(self, answers: pa.Table, width: int) -> dict:
        """Repeated anchors, and for each of them the first occurrence in the chunk that has the same bytes."""
        at, near, far, h = self.anchors()
        target, seen = (h % np.uint64(width)).astype(np.int64), np.zeros(len(at), dtype=np.uint8)
        order = np.argsort(target, kind="stable")
        begin = np.searchsorted(target[order], np.arange(width + 1))
        for t, data in zip(answers["target"].to_pylist(), answers["data"].to_pylist(), strict=True):
            seen[order[begin[t] : begin[t + 1]]] = np.frombuffer(data, dtype=np.uint8)
        again = np.flatnonzero(seen)
        at, near, far, h, seen = (x[again] for x in (at, near, far, h, seen))
        rows = self.contexts(at, near, far)
        whole = np.concatenate([rows, near[:, None].astype(np.uint8), far[:, None].astype(np.uint8)], axis=1)
        keys = whole.view(f"S{whole.shape[1]}").ravel() if len(whole) else np.zeros(0, "S1")
        # occurrences are in document order, so the first of equal ones is the earliest
        _, first, same = np.unique(keys, return_index=True, return_inverse=True) if len(keys) else (None, np.zeros(0, int), np.zeros(0, int))
        return {"at": at, "near": near, "far": far, "hash": h, "hot": seen == 2, "rows": rows, "first": first, "same": same}


def front_code(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix of each sorted row with the one before, and the bytes that remain."""
    common = np.zeros(len(rows), dtype=np.uint8)
    for i in range(1, len(rows), 65536):
        differ = rows[i : i + 65536] != rows[i - 1 : i - 1 + len(rows[i : i + 65536])]
        common[i : i + 65536] = np.where(differ.any(axis=1), differ.argmax(axis=1), ROW)
    return common, rows[np.arange(ROW) >= common[:, None]]


def front_decode(common: np.ndarray, rest: np.ndarray) -> np.ndarray:
    rows = np.zeros((len(common), ROW), dtype=np.uint8)
    rows[np.arange(ROW) >= common[:, None]] = rest
    here = np.arange(len(common))
    for j in range(ROW):
        rows[:, j] = rows[np.maximum.accumulate(np.where(common <= j, here, 0)), j]
    return rows


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    while known < ROW:
        if a[known : known + 16] != b[known : known + 16]:
            while a[known] == b[known]:
                known += 1
            return known
        known += 16
    return ROW


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """Loser-tree merge of (sorted rows, common prefix with the row before) runs.

    Returns for each place of the merged order the run it comes from, and its common prefix with the place
    before. Each candidate carries its common prefix with the last winner: of two candidates the one with the
    longer prefix is smaller, and only equal prefixes are compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    rows = [r for r, _ in runs] + [[]] * (k - len(runs))
    prefixes = [p for _, p in runs] + [[]] * (k - len(runs))
    at = [0] * k
    head = [r[0] if r else None for r in rows]  # None: the run is used up, larger than all
    known = [0] * k
    loser = [-1] * k

    def smaller(a: int, b: int) -> bool:
        """Whether run a's head goes first; the loser's known prefix becomes that with the winner."""
        x, y = head[a], head[b]
        if x is None or y is None:
            return y is None
        if known[a] != known[b]:
            return known[a] > known[b]
        p = common_prefix(x, y, known[a])
        first = p == ROW or x[p] < y[p]
        known[b if first else a] = p
        return first

    def build(node: int) -> int:
        if node >= k:
            return node - k
        a, b = build(2 * node), build(2 * node + 1)
        first = smaller(a, b)
        loser[node] = b if first else a
        return a if first else b

    winner = build(1) if k > 1 else 0
    order, common = [], []
    while head[winner] is not None:
        order.append(winner)
        common.append(known[winner])
        at[winner] += 1
        i = at[winner]
        if i < len(rows[winner]):
            head[winner], known[winner] = rows[winner][i], prefixes[winner][i]
        else:
            head[winner], known[winner] = None, -1
        node = (winner + k) // 2
        while node:
            other = loser[node]
            if not smaller(winner, other):
                loser[node], winner = winner, other
            node //= 2
    return order, common


def repeated_windows(rows: np.ndarray, common: np.ndarray, near: np.ndarray, far: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each merged row and distance, whether the window has an earlier equal one.

    ``order`` is the rank of each row's place in the corpus. Windows at distance d are equal if the suffixes
    share LENGTH - d bytes, which makes them neighbours in the merged order, and the d bytes before are equal.
    """
    out = np.zeros((len(rows), REACH + 1), dtype=bool)
    by_place = np.argsort(order, kind="stable")
    before = np.zeros(len(rows), dtype=np.uint64)
    for d in range(REACH + 1):
        if d:
            before = before * _MULTIPLIERS[0] + _BYTE_HASH[rows[:, LENGTH + d - 1]]
        run = np.cumsum(common < LENGTH - d).astype(np.uint64)
        own = by_place[((near <= d) & (d <= far))[by_place]]
        key = _mixed(run[own] * _MULTIPLIERS[1] + before[own])
        sort = np.argsort(key, kind="stable")  # stable: the earliest of a class comes first
        again = np.concatenate([[False], key[sort][1:] == key[sort][:-1]]) if len(own) else np.zeros(0, bool)
        out[own[sort[again]], d] = True
    return out


def _messages(chunk: int, targets: np.ndarray, width: int, payload) -> pa.Table:
    """One row for each target that gets something; ``payload(indices)`` makes its bytes."""
    order = np.argsort(targets, kind="stable")
    begin = np.searchsorted(targets[order], np.arange(width + 1))
    out = {t: payload(order[begin[t] : begin[t + 1]]) for t in range(width) if begin[t] < begin[t + 1]}
    return pa.table(
        {
            "target": pa.array(list(out), pa.int32()),
            "chunk": pa.array([chunk] * len(out), pa.int32()),
            "data": pa.array(list(out.values()), pa.binary()),
        }
    )


MESSAGE = "target int, chunk int, data binary"


def _count_anchors(messages: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x, dtype=np.uint64) for x in messages["data"].to_pylist()]
    _, same, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    level = ((counts > 1).astype(np.uint8) + (counts > HOT).astype(np.uint8))[same]
    answers = np.split(level, np.cumsum([len(p) for p in parts])[:-1])
    return messages.set_column(2, "data", pa.array([a.tobytes() for a in answers], pa.binary()))


def _send_runs(docs: pa.Table, answers: pa.Table, width: int) -> pa.Table:
    number = docs["chunk"][0].as_py() if docs.num_rows else 0
    chunk = Chunk(docs)
    found = chunk.occurrences(answers, width)
    pick = found["first"]
    near, far, h, hot = (found[x][pick] for x in ("near", "far", "hash", "hot"))
    # a hot anchor's rows are taken apart into one row for each window
    copies = np.where(hot, far - near + 1, 1)
    row = np.repeat(np.arange(len(pick)), copies)
    step = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
    near = np.where(hot[row], near[row] + step, near[row])
    far = np.where(hot[row], near, far[row])
    rows = found["rows"][pick][row] if len(row) else np.zeros((0, ROW), np.uint8)
    split = np.flatnonzero(hot[row])
    if len(split):  # cut each row down to its one window, and deal it by that window's hash
        part = rows[split]
        right, left = np.arange(LENGTH), np.arange(1, REACH + 1)
        part[:, :LENGTH] *= right < LENGTH - near[split][:, None]
        part[:, LENGTH:] *= left <= far[split][:, None]
        rows[split] = part
        sums = np.zeros(len(split), dtype=np.uint64)
        for j in range(ROW):
            sums = sums * _MULTIPLIERS[2] + _BYTE_HASH[part[:, j]]
        h = h[row]
        h[split] = _mixed(sums + near[split].astype(np.uint64))
    else:
        h = h[row]
    at = found["at"][pick][row] if len(row) else np.zeros(0, np.int64)
    doc = np.searchsorted(chunk.first, at, side="right") - 1

    def run(members: np.ndarray) -> bytes:
        own = rows[members]
        members = members[np.argsort(own.view(f"S{ROW}").ravel(), kind="stable")]
        common, rest = front_code(rows[members])
        fields = (common, rest, near[members].astype(np.uint8), far[members].astype(np.uint8), row[members].astype(np.int32))
        place = (chunk.ids[doc[members]], doc[members].astype(np.int32), (at - chunk.first[doc])[members])
        return pickle.dumps(fields + place, protocol=5)

    return _messages(number, (h % np.uint64(width)).astype(np.int64), width, run)


def _merge(messages: pa.Table) -> pa.Table:
    chunks = messages["chunk"].to_pylist()
    runs = [pickle.loads(x) for x in messages["data"].to_pylist()]
    rows = [front_decode(r[0], r[1]) for r in runs]
    lines = [[x.tobytes() for x in r] for r in rows]
    source, common = merge_runs([(x, r[0].tolist()) for x, r in zip(lines, runs, strict=True)])
    del lines
    source, common = np.array(source), np.array(common)
    offset = np.cumsum([0, *(len(r) for r in rows)])
    order = np.empty(len(source), dtype=np.int64)  # merged order -> row of the joined runs
    for k in range(len(runs)):
        mine = np.flatnonzero(source == k)
        order[mine] = offset[k] + np.arange(len(mine))
    near, far, row, ids, doc, pos = (np.concatenate([r[i] for r in runs])[order] for i in range(2, 8))
    number = np.repeat(chunks, [len(r) for r in rows])[order]
    place = np.empty(len(order), dtype=np.int64)
    place[np.lexsort((pos, doc, number, ids))] = np.arange(len(order))
    again = repeated_windows(np.concatenate(rows)[order], common, near, far, place)
    keep = again.any(axis=1)
    out = []
    for k, c in enumerate(chunks):
        mine = np.flatnonzero((source == k) & keep)
        if len(mine):
            out.append((c, pickle.dumps((row[mine], np.packbits(again[mine], axis=1)), protocol=5)))
    return pa.table(
        {
            "target": messages["target"][: len(out)],
            "chunk": pa.array([c for c, _ in out], pa.int32()),
            "data": pa.array([x for _, x in out], pa.binary()),
        }
    )


def _removed(chunk: Chunk, found: dict, replies: list[bytes]) -> np.ndarray:
    """Per byte of the chunk, whether a repeated window covers it."""
    first, same = found["first"], found["same"]
    again = np.zeros((len(first), REACH + 1), dtype=bool)
    for row, bits in map(pickle.loads, replies):
        np.logical_or.at(again, row, np.unpackbits(bits, axis=1, count=REACH + 1).astype(bool))
    starts = np.zeros(len(chunk.raw) + 1, dtype=np.int8)
    later = np.ones(len(same), dtype=bool)
    later[first] = False
    for d in range(REACH + 1):
        own = (found["near"] <= d) & (d <= found["far"])
        starts[(found["at"] - d)[own & (later | again[same, d])]] = 1
    total = np.cumsum(starts[:-1], dtype=np.int32)
    covered = total > 0
    covered[LENGTH:] = total[LENGTH:] > total[:-LENGTH]
    return covered


def _spans(covered: np.ndarray) -> np.ndarray:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return edge.reshape(-1, 2)


def _dealt(docs: DataFrame, carry: list[str]) -> tuple[DataFrame, int]:
    """Documents with their chunk, and the number of chunks: by the size of all text, and no fewer than
    the session's shuffle partitions. Carried columns get names of their own."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    width = max(shuffle_width(spark), -(-total // CHUNK_BYTES))
    named = docs.select(
        F.col("doc_id").cast("bigint").alias("_id"),
        text.alias("_text"),
        *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)],
    )
    return named.withColumn("chunk", F.pmod(F.xxhash64("_id", "_text"), F.lit(width)).cast("int")), width


def _repeats(docs: DataFrame, carry: list[str], finish, schema: str) -> DataFrame:
    dealt, width = _dealt(docs, carry)

    def send_anchors(table: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        h = chunk.anchors()[3]
        return _messages(table["chunk"][0].as_py(), (h % np.uint64(width)).astype(np.int64), width, lambda i: h[i].tobytes())

    def send_runs(table: pa.Table, answers: pa.Table) -> pa.Table:
        return _send_runs(table, answers, width)

    def remove(key, table: pa.Table, messages: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        is_answer = pc.field("kind") == 0
        answers, replies = messages.filter(is_answer), messages.filter(~is_answer)
        found = chunk.occurrences(answers, width)
        found["rows"] = None
        return finish(chunk, _removed(chunk, found, replies["data"].to_pylist()))

    by_chunk = dealt.groupBy("chunk")
    answers = by_chunk.applyInArrow(send_anchors, MESSAGE).groupBy("target").applyInArrow(_count_anchors, MESSAGE)
    runs = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(send_runs, MESSAGE)
    replies = runs.groupBy("target").applyInArrow(_merge, MESSAGE)
    both = answers.withColumn("kind", F.lit(0)).unionByName(replies.withColumn("kind", F.lit(1)))
    return by_chunk.cogroup(both.groupBy("chunk")).applyInArrow(remove, schema)


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """Per row of the table: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    A byte goes if it lies in LENGTH bytes that also start earlier: in a smaller doc_id, or earlier in the same
    document. Rows that share a doc_id are told apart by chunk and text; a null doc_id comes first. Null and
    empty texts, and all texts under LENGTH bytes, lose nothing. ``spans`` lists the removed byte ranges.
    """

    def finish(chunk: Chunk, covered: np.ndarray) -> pa.Table:
        rows = []
        for a, b in zip(chunk.first[:-1].tolist(), chunk.first[1:].tolist(), strict=True):
            gone = covered[a:b]
            spans = _spans(gone)
            kept = chunk.raw[a:b][~gone] if len(spans) else chunk.raw[a:b]
            rows.append((b - a, int(gone.sum()), len(spans), hashlib.sha256(kept.tobytes()).hexdigest(), ",".join(f"{x}:{y}" for x, y in spans.tolist())))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
        return pa.table({"doc_id": chunk.docs["_id"]} | {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans string"
    return _repeats(docs, [], finish, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents, all columns, without their repeated bytes; ``n_chars`` follows the text.

    A character that is only partly covered stays whole. Null texts stay null.
    """
    carry = docs.columns

    def finish(chunk: Chunk, covered: np.ndarray) -> pa.Table:
        inner = (chunk.raw & 0xC0) == 0x80  # bytes that continue a character
        kept = ~covered
        head = np.flatnonzero(~inner)
        if len(head):
            kept = np.repeat(np.logical_or.reduceat(kept, head), np.diff(np.append(head, len(kept))))
        texts = [chunk.raw[a:b][kept[a:b]].tobytes().decode() for a, b in zip(chunk.first[:-1].tolist(), chunk.first[1:].tolist(), strict=True)]
        out = {c: chunk.docs[f"_c{i}"] for i, c in enumerate(carry)}
        was = out["text"].is_null().to_pylist()
        out["text"] = pa.array([None if n else t for n, t in zip(was, texts, strict=True)], pa.string())
        if "n_chars" in out:
            sizes = pa.array([None if n else len(t) for n, t in zip(was, texts, strict=True)], pa.int64())
            out["n_chars"] = sizes.cast(out["n_chars"].type)
        return pa.table(out)

    return _repeats(docs, carry, finish, docs.schema)
