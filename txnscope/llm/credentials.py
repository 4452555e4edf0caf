"""Secrets in texts, with multipart credentials linked by co-occurrence.

Strong spans (assignments, access identifiers, long hex runs) are reported as they are. Weak parts, that alone
are mostly harmless, are reported only if a complementary part stands in the same scope (a paragraph),
however far away: a secret-like value beside an access identifier or beside or in an endpoint, and a
short-lived or client identifier beside a secret. Extraction is one pass over the texts; linking reads the few
parts of each (row, scope) once, by windows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnscope.llm.text import documents
from txnscope.session import scratch_path

#: Kinds in the order of reports; the first three are strong.
KINDS = ("assign", "access", "hex", "key_id", "secret", "endpoint")
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEY_ID = re.compile(r"(?<![A-Za-z0-9])(?:A(?:SIA|ROA|IDA)[A-Z0-9]{12,}|(?i:client|key)_?(?i:id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_-]{8,})")
SECRET = re.compile(r"(?<![A-Za-z0-9/+=_.-])[A-Za-z0-9/+]{32,}={0,2}(?![A-Za-z0-9/+=_.-])")
ENDPOINT = re.compile(r"(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]{4,}")
PARAGRAPH = re.compile(r"\n\s*\n")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
#: Which kinds complete a weak kind.
PARTNERS = {"key_id": ("assign", "hex", "secret"), "secret": ("access", "key_id", "endpoint")}


def strong_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), by start and kind: leftmost non-overlapping matches that pass their length check."""
    out = []
    lowered = text.lower()
    if "passw" in lowered or "secret" in lowered or "token" in lowered or "api" in lowered:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def weak_spans(text: str, strong: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that no strong span overlaps; endpoints also around strong spans."""
    out = []
    if "SIA" in text or "ROA" in text or "IDA" in text or "=" in text or ":" in text:
        out += [(m.start(), 3, m.end()) for m in KEY_ID.finditer(text)]
    for m in SECRET.finditer(text):
        value = m[0]
        if any(c.isdigit() for c in value) and any(c.isupper() for c in value) and any(c.islower() for c in value):
            out.append((m.start(), 4, m.end()))
    if "://" in text:
        out += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    if strong and out:  # of the strong spans that start before a part's end, the furthest end
        starts, reach = [s[0] for s in strong], list(accumulate((s[2] for s in strong), max))
        out = [x for x in out if x[1] == 5 or not (i := bisect_left(starts, x[2])) or reach[i - 1] <= x[0]]
    return sorted(out)


def _extract(docs: DataFrame) -> DataFrame:
    part = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("scope", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            strong, weak, ids = [], [], []
            for value in batch.column(1):
                text = value.as_py()
                s = strong_spans(text)
                w = weak_spans(text, s)
                both: list[tuple] = []
                if any(k in (3, 4) for _, k, _ in w):  # a scope's number, for the parts in order
                    breaks, scope = [m.start() for m in PARAGRAPH.finditer(text)], 0
                    for x in sorted(s + w):
                        while scope < len(breaks) and breaks[scope] < x[0]:
                            scope += 1
                        both.append((*x, scope))
                strong.append([{"start": a, "kind": k, "end": b} for a, k, b in s])
                weak.append([{"start": a, "kind": k, "end": b, "scope": c} for a, k, b, c in both])
                ids.append(uid)
                uid += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    batch.column(0),
                    pa.array(strong, pa.list_(pa.struct(list(part)[:3]))),
                    pa.array(weak, pa.list_(part)),
                ],
                names=["uid", "doc_id", "strong", "parts"],
            )

    schema = (
        "uid long, doc_id long, strong array<struct<start: int, kind: int, end: int>>, "
        "parts array<struct<start: int, kind: int, end: int, scope: int>>"
    )
    return documents(docs).mapInArrow(run, schema)


def linked(found: DataFrame) -> DataFrame:
    """uid, start, kind and end of the weak parts that have a complementary part in their scope.

    A partner does not overlap the part: one of the kind ends before the part or starts behind it, so a scope's
    first end and last start of the kind decide. Or it is an endpoint around a secret: endpoints do not overlap
    each other, so the furthest end of those that start before the secret decides.
    """
    parts = found.where(F.size("parts") > 0).select("uid", F.explode("parts").alias("p")).select("uid", "p.*")
    scope = Window.partitionBy("uid", "scope")
    completed = F.lit(False)
    for kind, others in PARTNERS.items():
        partner = F.col("kind").isin([KINDS.index(o) for o in others])
        first_end = F.min(F.when(partner, F.col("end"))).over(scope)
        last_start = F.max(F.when(partner, F.col("start"))).over(scope)
        apart = (first_end <= F.col("start")) | (last_start >= F.col("end"))
        completed |= (F.col("kind") == KINDS.index(kind)) & F.coalesce(apart, F.lit(False))
    around = F.max(F.when(F.col("kind") == KINDS.index("endpoint"), F.col("end"))).over(scope.orderBy("start"))
    completed |= (F.col("kind") == KINDS.index("secret")) & F.coalesce(around >= F.col("end"), F.lit(False))
    return parts.withColumn("completed", completed).where("completed").select("uid", "start", "kind", "end")


def _joined(spans: str):
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, x -> concat(get(array({names}), x.kind), ':', x.start, ':', x.end)), ',')")


def secrets(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row of the table: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    Offsets are code points, ends exclusive. Null and empty texts have none. Rows that repeat each get a
    row: rows are told apart by a number given when the extraction is written to the shared folder.
    """
    path = scratch_path(spark, "secrets")
    _extract(docs).write.parquet(path)
    found = spark.read.parquet(path)
    added = linked(found).groupBy("uid").agg(F.collect_set(F.struct("start", "kind", "end")).alias("added"))
    counts = [F.expr(f"CAST(size(filter(strong, x -> x.kind = {k})) AS BIGINT)").alias(f"n_{KINDS[k]}") for k in range(3)]
    joined = found.select("uid", "doc_id", "strong").join(added, "uid", "left")
    every = F.when(F.col("added").isNull(), F.col("strong")).otherwise(F.sort_array(F.concat("strong", "added")))
    return joined.withColumn("every", every).select(
        "doc_id",
        *counts,
        F.sha2(_joined("strong"), 256).alias("base_sha256"),
        _joined("every").alias("spans"),
        F.greatest(F.size("added"), F.lit(0)).cast("bigint").alias("n_linked"),
    )
