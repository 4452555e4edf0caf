"""Run the hot and cold paths from one source definition, screened or as they come.

Each ``start`` is an independent query with its own offsets, checkpoint and trigger (the
source is read twice); the driver then waits until either ends. Restart policy is the
caller's: re-running with the same roots resumes from the checkpoints.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from txnscope.config import ANOMALY, COLD_TRIGGER, HOT_TRIGGER, RuleProfile
from txnscope.streaming.paths import anomaly_table, screened_stream, start_cold, start_hot, start_intake


@dataclass(frozen=True)
class PipelineRoots:
    hot: str  # keyed anomaly table (log + checkpoint)
    cold: str  # partitioned transactions table
    cold_checkpoint: str


def run_both(
    spark: SparkSession,
    source: Callable[[SparkSession], DataFrame],
    roots: PipelineRoots,
    profile: RuleProfile = ANOMALY,
    available_now: bool = False,
    wait: bool = True,
    state_partitions: int | None = None,
    hot_trigger: str = HOT_TRIGGER,
    cold_trigger: str = COLD_TRIGGER,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start cold then hot path over ``source(spark)`` (a streaming frame of parsed
    transactions). With ``wait`` the call blocks until either query terminates (both,
    for ``available_now``) and re-raises its error."""
    # Forget queries that ended earlier in this session, or the wait below returns at once.
    spark.streams.resetTerminated()
    cold = start_cold(
        source(spark), roots.cold, roots.cold_checkpoint, available_now=available_now, trigger=cold_trigger, query_name="cold_path"
    )
    hot = start_hot(
        source(spark), anomaly_table(roots.hot), profile, available_now=available_now, trigger=hot_trigger,
        query_name="hot_path", state_partitions=state_partitions,
    )
    if wait:
        _wait(spark, (cold, hot), available_now)
    return cold, hot


def _wait(spark: SparkSession, queries: tuple[StreamingQuery, ...], available_now: bool) -> None:
    if available_now:  # they finish by themselves: wait for all
        for q in queries:
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()
    for q in queries:
        if q.exception() is not None:
            raise q.exception()


def run_screened(
    spark: SparkSession,
    envelope: Callable[[SparkSession], DataFrame],
    roots: PipelineRoots,
    profile: RuleProfile = ANOMALY,
    available_now: bool = False,
    wait: bool = True,
    state_partitions: int | None = None,
    hot_trigger: str = HOT_TRIGGER,
    cold_trigger: str = COLD_TRIGGER,
    as_of: str | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Screen ``envelope(spark)`` into the lake once, and run the hot path on its valid rows only.

    The source is read and parsed by the intake alone. The hot path follows the lake's committed files, so rejected
    records reach no window, and a record is at most one intake trigger later there. For ``available_now`` the hot
    path starts when the intake has ended, so that it sees all that was there.
    """
    spark.streams.resetTerminated()
    _make_folder(spark, roots.cold)
    intake = start_intake(
        envelope(spark), roots.cold, roots.cold_checkpoint, available_now=available_now, trigger=cold_trigger, query_name="intake"
    )
    if available_now:
        intake.awaitTermination()
    hot = start_hot(
        screened_stream(spark, roots.cold), anomaly_table(roots.hot), profile, as_of=as_of, available_now=available_now,
        trigger=hot_trigger, query_name="hot_path", state_partitions=state_partitions,
    )
    if wait:
        _wait(spark, (intake, hot), available_now)
    return intake, hot


def _make_folder(spark: SparkSession, path: str) -> None:
    """A file stream's folder must be there when the stream starts."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
