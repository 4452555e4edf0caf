"""Stream metrics without extra jobs: ``observe`` + a progress listener.

``observe`` computes named aggregates as a side effect of the micro-batch that already
runs (no second pass like ``count()``); the listener receives them with each progress
event on the driver, where only these few numbers arrive.
"""

from __future__ import annotations

import threading
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from txnscope.config import ANOMALY

TXN_STATS = "txn_stats"
KEPT_BATCHES = 10_000  # metrics of so many batches are kept one by one; totals cover all


def batch_line(query: str, batch_id: int, metric: str, values: dict[str, int]) -> str:
    """One line for a job's log, e.g. ``hot_path batch 7 anomaly_windows: windows=120 flagged=4``."""
    return f"{query} batch {batch_id} {metric}: " + " ".join(f"{k}={v}" for k, v in values.items())


def observe_transactions(
    txns: DataFrame, name: str = TXN_STATS, threshold: float = ANOMALY.rules[0].threshold
) -> DataFrame:
    """Attach per-batch counters: rows seen and rows above the amount threshold."""
    return txns.observe(
        name,
        F.count(F.lit(1)).alias("total_sent"),
        F.count_if(F.col("amount") > F.lit(threshold)).alias("total_anomalies"),
    )


class ProgressCollector(StreamingQueryListener):
    """Accumulates observed metrics, by query and metric name and by batch, and watermark drops by query name.

    ``report`` receives a line for each batch's metrics as they arrive, e.g. ``print`` in a job.
    """

    def __init__(self, report: Callable[[str], None] | None = None) -> None:
        self._lock = threading.Lock()
        self._report = report
        self._ended: dict[str, threading.Event] = {}
        self._by_batch: deque[tuple[str, int, str, dict[str, int]]] = deque(maxlen=KEPT_BATCHES)
        self.totals: dict[tuple[str, str], dict[str, int]] = {}
        self.dropped_by_watermark: dict[str, int] = {}
        self.batches: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802 (listener API)
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        name = p.name or str(p.id)
        with self._lock:
            self.batches[name] = self.batches.get(name, 0) + 1
            for metric_name, row in (p.observedMetrics or {}).items():
                acc = self.totals.setdefault((name, metric_name), {})
                values = {k: v or 0 for k, v in row.asDict().items()}
                for k, v in values.items():
                    acc[k] = acc.get(k, 0) + v
                self._by_batch.append((name, p.batchId, metric_name, values))
                if self._report:
                    self._report(batch_line(name, p.batchId, metric_name, values))
            dropped = sum(op.numRowsDroppedByWatermark for op in (p.stateOperators or []))
            self.dropped_by_watermark[name] = self.dropped_by_watermark.get(name, 0) + dropped

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end(str(event.runId)).set()

    def _end(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait for a query's end and for its last event, which follows all its progress events."""
        query.awaitTermination()
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end event of {query.name or query.id} within {seconds} seconds")

    def stats(self, name: str = TXN_STATS, query: str | None = None) -> dict[str, float]:
        """Running totals and the anomalous share in percent (2 decimals).

        Queries that share a source each report its rows: where several report the metric, ``query`` names one.
        """
        with self._lock:
            found = {q: dict(acc) for (q, metric), acc in self.totals.items() if metric == name}
        if query is None and len(found) > 1:
            raise ValueError(f"{name} is reported by {sorted(found)}: name one")
        acc = found.get(query, {}) if query else next(iter(found.values()), {})
        total = acc.get("total_sent", 0)
        high = acc.get("total_anomalies", 0)
        acc["pct_anomalies"] = round(100.0 * high / total, 2) if total else None
        return acc


    def frame(self, spark: SparkSession, name: str = TXN_STATS, query: str | None = None) -> DataFrame:
        """:func:`stats` as one row: total_sent, total_anomalies, pct_anomalies (half-up like the batch form)."""
        acc = self.stats(name, query)
        counts = [(int(acc.get("total_sent", 0)), int(acc.get("total_anomalies", 0)))]
        total = F.nullif(F.col("total_sent"), F.lit(0))
        share = F.round(F.lit(100.0) * F.col("total_anomalies") / total, 2)
        return spark.createDataFrame(counts, "total_sent long, total_anomalies long").withColumn("pct_anomalies", share)

    def batches_frame(self, spark: SparkSession, metric: str) -> DataFrame:
        """query, batch_id, windows, flagged of each batch that emitted windows (the newest KEPT_BATCHES batches).

        A batch that ran again after a restart counts once, as it ran last.
        """
        with self._lock:
            found = {(q, b): v for q, b, m, v in self._by_batch if m == metric and v.get("windows")}
        rows = [(q, b, int(v["windows"]), int(v.get("flagged", 0))) for (q, b), v in sorted(found.items())]
        return spark.createDataFrame(rows, "query string, batch_id long, windows long, flagged long")


def attach_collector(spark: SparkSession, report: Callable[[str], None] | None = None) -> ProgressCollector:
    collector = ProgressCollector(report)
    spark.streams.addListener(collector)
    return collector


def rows_dropped_by_watermark(query: StreamingQuery) -> int:
    """Late rows dropped in the last batch. Counted after partial aggregation, so this is
    a lower bound on dropped events."""
    last = query.lastProgress or {}
    return sum(op.get("numRowsDroppedByWatermark", 0) for op in last.get("stateOperators", []))
