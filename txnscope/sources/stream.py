"""Streaming sources adapted to the envelope ``(data BINARY, arrival_time TIMESTAMP)``.

The source format is a parameter: Kafka in production (its ``value``/``timestamp``
columns map straight onto the envelope, records keyed by user), file sources for tests
and replays. Kafka needs the ``spark-sql-kafka`` package on the classpath; nothing here
imports it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnscope.sources.payload import decode_payload, to_envelope

KAFKA = "kafka"
TEXT = "text"


def raw_stream(
    spark: SparkSession,
    fmt: str = KAFKA,
    options: dict[str, str] | None = None,
    path: str | None = None,
    starting: str = "latest",
) -> DataFrame:
    """Envelope stream from ``fmt``.

    * ``kafka``: pass ``kafka.bootstrap.servers`` and ``subscribe`` in ``options``; reading
      starts at ``starting`` offsets (``latest`` like the original job; ``earliest`` for
      replays). Partition count of the topic bounds source parallelism; set
      ``minPartitions`` to split large partitions across more tasks.
    * ``text`` (one JSON record per line) and other file formats: ``path`` is a folder;
      arrival time is the micro-batch processing time.
    """
    opts = dict(options or {})
    reader = spark.readStream.format(fmt)
    if fmt == KAFKA:
        opts.setdefault("startingOffsets", starting)
    for key, value in opts.items():
        reader = reader.option(key, value)
    raw = reader.load(path) if path else reader.load()
    if fmt == KAFKA:
        return to_envelope(raw, data="value", arrival_time="timestamp")
    return to_envelope(raw, data="value", arrival_time=None)


def transaction_stream(spark: SparkSession, fmt: str = KAFKA, **kwargs) -> DataFrame:
    """Parsed transactions from a raw stream (decode of :func:`raw_stream`)."""
    return decode_payload(raw_stream(spark, fmt, **kwargs))
