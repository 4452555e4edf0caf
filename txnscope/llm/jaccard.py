"""Near-duplicate join on word shingles with Bayesian candidate pruning.

Texts with the same words in the same order are one class from the start; what follows works on one member
of each. Bands of MinHash values propose candidates. Inside a bucket, pairs are compared a few MinHash values
at a time: given the matches so far, a pair leaves when the posterior probability that its similarity reaches
the threshold (uniform prior) falls below a tolerance. The rest is verified on the shingle sets. A pair that
shares several buckets is counted in that of its first common band, and buckets with the same members are
kept once. Large buckets are cut into blocks, and each pair of blocks is a task of its own. Tasks run twice: on
signatures alone they name the members that have a surviving pair; with the shingle sets of those they report each
member's number of links and a spanning star of the links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from txnscope.llm.text import documents, text_blocks
from txnscope.session import scratch_path

THRESHOLD = 0.8
WORDS = 5
VALUES = 128  # MinHash values of a signature
BAND = 4  # values of a band
BANDS = 24  # a pair at 0.8 misses all of them with probability 3e-6
STEP = 16  # values compared before the posterior is looked at again
TOLERANCE = 1e-9
BLOCK = 1024  # members of a bucket's block
BLOCK_CHARS = 2_000_000
CACHE_WORDS = 200_000
SIEVE_BITS = 16  # for each class whose text is wanted: one row in 16 passes the sieve for nothing
SIEVE_CLASSES = 4_000_000  # up to so many classes the sieve (8 MB then) is broadcast; more texts are joined without it

_RNG = np.random.default_rng(5)
_A = _RNG.integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_M = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Distinct shingle hashes of texts; keeps a cache of word hashes."""

    def __init__(self):
        self.cache: dict[bytes, int] = {}

    def words(self, texts: list[str]) -> list[list[bytes]]:
        words = [t.encode().split() for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        for w in set().union(*words).difference(self.cache):
            self.cache[w] = xxhash.xxh3_64_intdigest(w)
        return words

    def shingles(self, words: list[bytes]) -> np.ndarray:
        """Sorted 64-bit hashes of all WORDS-word shingles; of all words together in shorter texts."""
        if not words:
            return np.zeros(0, dtype=np.uint64)
        h = np.fromiter(map(self.cache.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(WORDS, len(words))
        n = len(h) - width + 1
        s = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            s = (s ^ (s >> np.uint64(32))) * _M + h[k : k + n]
        s = (s ^ (s >> np.uint64(29))) * _M
        return np.unique(s ^ (s >> np.uint64(32)))


def key_of(words: list[bytes]) -> bytes | None:
    """Names the class of all texts with these words; none for texts without words."""
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else None


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(VALUES, np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), 1024):
        low = np.minimum(low, (shingles[None, i : i + 1024] * _A[:, None] + _B[:, None]).min(axis=1))
    return (low >> np.uint64(32)).astype("<u4")


def fewest_matches(compared: int, threshold: float, tolerance: float) -> int:
    """Fewest matches of so many compared values that keep a pair: the smallest m for which the
    posterior P(similarity >= threshold) = P(Binomial(compared + 1, threshold) <= m) reaches the tolerance."""
    n, total = compared + 1, 0.0
    for m in range(n + 1):
        total += math.comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
        if total >= tolerance:
            return m
    return n


def surviving_pairs(left: np.ndarray, right: np.ndarray, triangle: bool, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (row of left, row of right) that no comparison step prunes."""
    keep_p, keep_q = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    need = [fewest_matches(k, threshold, tolerance) for k in range(STEP, VALUES + 1, STEP)]
    for base in range(0, len(left), 256):
        part = left[base : base + 256]
        matches = np.zeros((len(part), len(right)), dtype=np.int16)
        for k in range(STEP):
            matches += part[:, k, None] == right[None, :, k]
        good = matches >= need[0]
        if triangle:
            good &= np.arange(len(right))[None, :] > (base + np.arange(len(part)))[:, None]
        p, q = np.nonzero(good)
        m = matches[p, q]
        p += base
        for step in range(1, VALUES // STEP):
            cols = slice(step * STEP, (step + 1) * STEP)
            for i in range(0, len(p), 65536):
                m[i : i + 65536] += (left[p[i : i + 65536], cols] == right[q[i : i + 65536], cols]).sum(axis=1, dtype=np.int16)
            good = m >= need[step]
            p, q, m = p[good], q[good], m[good]
        keep_p.append(p)
        keep_q.append(q)
    return np.concatenate(keep_p), np.concatenate(keep_q)


def common_counts(sets: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets p[i] and q[i]."""
    if len(p) <= 64:
        both = [len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(p.tolist(), q.tolist(), strict=True)]
        return np.array(both, dtype=np.int64)
    used = np.unique(np.concatenate([p, q]))
    owner = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
    _, column, times = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
    shared = times[column] > 1  # a shingle of one set only is in no intersection
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    a, b = np.searchsorted(used, p), np.searchsorted(used, q)
    total, width = np.zeros((len(used), len(used)), dtype=np.float32), 4096
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        here = slice(*np.searchsorted(column, [low, low + width]))
        block = np.zeros((len(used), width), dtype=np.float32)
        block[owner[here], column[here] - low] = 1
        total += block @ block.T
    return total[a, b].astype(np.int64)


def candidate_pairs(rows: dict, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a task's members that survive the pruning and have no earlier band in common."""
    sig, side, band = rows["signature"], rows["side"], rows["band"]
    if (side == 2).all():
        p, q = surviving_pairs(sig, sig, True, threshold, tolerance)
    else:
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        p, q = surviving_pairs(sig[a], sig[b], False, threshold, tolerance)
        p, q = a[p], b[q]
    first = np.ones(len(p), dtype=bool)
    for c in range(band):
        for i in range(0, len(p), 65536):
            s = slice(i, i + 65536)
            cols = slice(c * BAND, (c + 1) * BAND)
            first[s] &= (sig[p[s], cols] != sig[q[s], cols]).any(axis=1)
    return p[first], q[first]


def link_bucket(rows: dict, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """For the members of one task: copies that each is linked to here, and a root for each linked set."""
    n = len(rows["signature"])
    p, q = candidate_pairs(rows, threshold, tolerance)
    sets = rows["shingles"]
    size = np.array([len(x) for x in sets], dtype=np.int64)
    both = common_counts(sets, p, q)
    near = both / (size[p] + size[q] - both) >= threshold if len(p) else np.zeros(0, bool)
    p, q = p[near], q[near]
    copies = rows["copies"]
    links = np.bincount(p, copies[q], n).astype(np.int64) + np.bincount(q, copies[p], n).astype(np.int64)
    root = np.arange(n)
    while len(p):  # smallest index reachable, by halving paths
        low = np.minimum(root[p], root[q])
        new = root.copy()
        np.minimum.at(new, p, low)
        np.minimum.at(new, q, low)
        np.minimum.at(new, root[p], low)
        np.minimum.at(new, root[q], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return links, root


def _signatures(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for first, texts in text_blocks(batch, 1, BLOCK_CHARS):
                words = shingler.words(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(map(key_of, words), pa.binary()),
                        pa.array([signature(shingler.shingles(w)).tobytes() if w else None for w in words], pa.binary()),
                    ],
                    names=["doc_id", "key", "signature"],
                )

    return documents(docs).mapInArrow(run, "doc_id long, key binary, signature binary")


def _shingle_sets(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for first, texts in text_blocks(batch, 1, BLOCK_CHARS):
                sets = [shingler.shingles(w).tobytes() for w in shingler.words(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(sets, pa.binary())], names=["key", "shingles"]
                )

    return docs.select("key", "text").mapInArrow(run, "key binary, shingles binary")


def _buckets(members: DataFrame) -> DataFrame:
    """bucket, band, size and key of all buckets with two members or more; equal member sets once."""
    band = [F.struct(F.lit(b).alias("band"), F.xxhash64(F.lit(b), F.substring("signature", 1 + 4 * BAND * b, 4 * BAND)).alias("bucket")) for b in range(BANDS)]
    rows = members.select("key", F.explode(F.array(*band)).alias("at")).select("key", "at.*")
    mark = F.xxhash64("key")
    sizes = rows.groupBy("bucket", "band").agg(
        F.count("*").alias("size"), F.bit_xor(mark).alias("mark"), F.sum(F.xxhash64("key", F.lit(1)).cast("decimal(20,0)")).alias("mark2")
    )
    once = (
        sizes.where("size > 1")
        .groupBy("size", "mark", "mark2")
        .agg(F.min(F.struct("band", "bucket")).alias("at"))
        .select("at.bucket", "at.band", "size")
    )
    return rows.join(once, ["bucket", "band"])


def _tasks(buckets: DataFrame) -> DataFrame:
    """One row for each member and pair of blocks that its block is in; side 2: pairs inside the block."""
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("key", F.lit(2)), blocks).cast("int")
    dealt = buckets.select("bucket", "band", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return dealt.select(
        "bucket", "band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "key", side.alias("side")
    )


TASK = ["bucket", "band", "low", "high"]


def _dealt(tasks: DataFrame, finish, schema: str) -> DataFrame:
    """``finish`` applied to the whole rows of one task after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            ids = np.stack([table[c].to_numpy() for c in TASK])
            cuts = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1).tolist(), table.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                task = tuple(ids[:, a].tolist())
                if task != open_ and parts:
                    yield finish(pa.concat_tables(parts))
                    parts = []
                open_ = task
                parts.append(table.slice(a, b - a))
        if parts:
            yield finish(pa.concat_tables(parts))

    return tasks.repartition(*TASK).sortWithinPartitions(*TASK).mapInArrow(run, schema)


def _task_rows(t: pa.Table) -> dict:
    return {
        "band": t["band"][0].as_py(),
        "side": t["side"].to_numpy(),
        "signature": np.frombuffer(b"".join(t["signature"].to_pylist()), dtype="<u4").reshape(-1, VALUES),
    }


def _candidates(tasks: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """The rows of each task whose member has a surviving pair in it; signatures decide."""

    def finish(t: pa.Table) -> pa.RecordBatch:
        p, q = candidate_pairs(_task_rows(t), threshold, tolerance)
        kept = t.select([*TASK, "key", "side"]).take(pa.array(np.union1d(p, q)))
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in kept.columns], names=kept.column_names)

    return _dealt(tasks, finish, "bucket long, band int, low int, high int, key binary, side int")


def _links(tasks: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """key, links and root (a key) of each member with links, for each task."""

    def finish(t: pa.Table) -> pa.RecordBatch:
        rows = _task_rows(t)
        rows["copies"] = t["copies"].to_numpy()
        rows["shingles"] = [np.frombuffer(x, dtype=np.uint64) for x in t["shingles"].to_pylist()]
        links, root = link_bucket(rows, threshold, tolerance)
        linked = np.flatnonzero(links)
        keys = t["key"].combine_chunks()
        return pa.RecordBatch.from_arrays(
            [keys.take(pa.array(linked)), pa.array(links[linked]), keys.take(pa.array(root[linked]))], names=["key", "links", "root"]
        )

    return _dealt(tasks, finish, "key binary, links long, root binary")


def _slots(keys: list[bytes], ids: list[int | None], bits: int) -> np.ndarray:
    """The sieve's bit of each row: of its words and its id."""
    own = np.frombuffer(b"".join(k[:8] for k in keys), dtype="<u8")
    named = np.array([i or 0 for i in ids], dtype=np.int64).astype(np.uint64)
    return (own ^ (named * _M)) % np.uint64(bits)


def _sieve(classes: DataFrame) -> tuple[int, np.ndarray] | None:
    """(bits, words of 64 bits) with the bits of the classes' first rows (key, doc_id) set; none for too many classes."""
    count = classes.count()
    if not count or count > SIEVE_CLASSES:
        return None
    bits = -(-count * SIEVE_BITS // 64) * 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = _slots(batch.column(0).to_pylist(), batch.column(1).to_pylist(), bits)
            set_ = (np.uint64(1) << (slot % np.uint64(64))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((slot // np.uint64(64)).astype(np.int64)), pa.array(set_)], names=["word", "bits"])

    words = np.zeros(bits // 64, dtype=np.int64)
    for r in classes.select("key", "doc_id").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():
        words[r["word"]] = r["bits"]
    return bits, words.view(np.uint64)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node and root (its component's smallest node) for the nodes of (u, v) edges.

    Alternating large-star and small-star rounds; each round is written to the shared folder, and the rounds
    end when one changes nothing. Nothing is collected but a count and a checksum.
    """
    state, path = None, scratch_path(spark, "edges")
    edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().write.parquet(path)
    while True:
        e = spark.read.parquet(path)
        found = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if found == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state, path = found, scratch_path(spark, "edges")
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small.unionByName(low.select("u", F.col("m").alias("v"))).distinct().write.parquet(path)


def _linked_classes(spark: SparkSession, docs: DataFrame, threshold: float, tolerance: float) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, key), classes of equal words (key, copies, doc_id), links per key, and (node, root) per linked key."""
    path = scratch_path(spark, "signatures")
    _signatures(docs).write.parquet(path)
    rows = spark.read.parquet(path)
    classes = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature")
    )
    path = scratch_path(spark, "classes")
    classes.write.parquet(path)
    classes = spark.read.parquet(path)

    path = scratch_path(spark, "candidates")
    tasks = _tasks(_buckets(classes.select("key", "signature")))
    _candidates(tasks.join(classes.select("key", "signature"), "key"), threshold, tolerance).write.parquet(path)
    tasks = spark.read.parquet(path)
    wanted = classes.select("key", "copies", "doc_id", "signature").join(tasks.select("key").distinct(), "key", "left_semi")
    path = scratch_path(spark, "wanted")
    wanted.write.parquet(path)
    wanted = spark.read.parquet(path)
    # of each wanted class the row with its smallest id brings the words
    texts = _keyed_texts(docs, _sieve(wanted)).join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"])
    payload = wanted.drop("doc_id").join(_shingle_sets(texts), "key")

    path = scratch_path(spark, "links")
    _links(tasks.join(payload, "key"), threshold, tolerance).write.parquet(path)
    links = spark.read.parquet(path)
    total = links.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(spark, links.select(F.col("key").alias("u"), F.col("root").alias("v")))
    return rows, classes, total, roots


def near_duplicates(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """Per row of the table: doc_id, class_id, n_links, n_copies.

    ``n_links`` counts the other rows whose shingle set has Jaccard similarity >= threshold with this row's,
    copies with the same words included (``n_copies`` counts these and the row itself). ``class_id`` is the
    smallest doc_id of the connected component of links (null if all its ids are null). Texts of fewer than
    five words have one shingle, all their words; texts without words (null, empty, white space) are linked to
    nothing and are their own class. Rows that repeat an id are rows of their own.
    """
    rows, classes, total, roots = _linked_classes(spark, docs, threshold, tolerance)
    worded = rows.where("key IS NOT NULL")
    linked = classes.select("key", "copies", "doc_id").join(total, "key").join(roots.withColumnRenamed("node", "key"), "key")
    smallest = linked.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    linked = linked.join(smallest, "root").select("key", "links", "class_id")
    every = classes.select("key", "copies", "doc_id").join(linked, "key", "left").select(
        "key",
        F.when(F.col("links").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.col("copies").alias("n_copies"),
    )
    answer = worded.select("doc_id", "key").join(every, "key").select("doc_id", "class_id", "n_links", "n_copies")
    none = rows.where("key IS NULL").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"), F.lit(1).cast("bigint").alias("n_copies")
    )
    return answer.unionByName(none)


def one_per_class(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """The documents, all columns, that stay when each class of :func:`near_duplicates` keeps one.

    The row with the class's smallest doc_id stays (a null doc_id counts as larger than all others; rows that
    repeat an id and its words leave one row). Texts without words all stay.
    """
    _, classes, _, roots = _linked_classes(spark, docs, threshold, tolerance)
    linked = classes.select("key", "doc_id").join(roots.withColumnRenamed("node", "key"), "key")
    first = linked.groupBy("root").agg(F.min_by("key", F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("key"))
    lost = linked.select("key").join(first.select("key"), "key", "left_anti")
    stay = classes.select("key", "doc_id").join(lost, "key", "left_anti").select(_tag("key", "doc_id"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).field("text").to_pylist()
            found = [key_of((t or "").encode().split()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["row", "key"])

    # the nested row keeps its columns apart from the ones added here
    schema = StructType([StructField("row", docs.schema), StructField("key", BinaryType())])
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")).mapInArrow(keys, schema)
    # one row per (words, id): sorted and reduced before the shuffle, so a hot group never reaches one task
    worded = keyed.where("key IS NOT NULL").select("row", _tag("key", F.col("row.doc_id").cast("bigint"))).dropDuplicates(["tag"])
    kept = worded.join(stay, "tag", "left_semi")
    return kept.select("row.*").unionByName(keyed.where("key IS NULL").select("row.*"))


def _tag(key: str, doc_id) -> Column:
    return F.concat_ws(":", F.hex(key), F.col(doc_id) if isinstance(doc_id, str) else doc_id).alias("tag")


def _keyed_texts(docs: DataFrame, sieve: tuple[int, np.ndarray] | None) -> DataFrame:
    """key and text of the rows that pass the sieve: all rows that it was made for, and few others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_blocks(batch, 1, BLOCK_CHARS):
                keys = [key_of(t.encode().split()) for t in texts]
                rows = np.flatnonzero([k is not None for k in keys])
                if sieve and len(rows):
                    bits, words = sieve
                    ids = batch.column(0).slice(first, len(texts)).to_pylist()
                    slot = _slots([keys[i] for i in rows], [ids[i] for i in rows], bits)
                    rows = rows[(words[slot // np.uint64(64)] >> (slot % np.uint64(64))) & np.uint64(1) == 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[i] for i in rows], pa.binary()), batch.column(1).slice(first, len(texts)).take(pa.array(rows))],
                    names=["key", "text"],
                )

    return documents(docs).mapInArrow(run, "key binary, text string")
