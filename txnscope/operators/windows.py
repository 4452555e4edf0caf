"""Windowed per-user aggregation, the engine's core operator.

One operator serves both rule profiles, tumbling and sliding windows, batch and
streaming input: ``groupBy(window(event_timestamp), user_id).agg(profile metrics)``
followed by the profile's rules. Physically this is a partial hash aggregate, one shuffle
on (window, user_id) and a final hash aggregate; a hot user collapses to one row per
task per window before the shuffle, so skew in users does not reach the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.config import (
    COUNT,
    DISTINCT_CATEGORIES,
    MAX_AMOUNT,
    MIN_AMOUNT,
    TOTAL_AMOUNT,
    RuleProfile,
)
from txnscope.functions.rules import rule_columns_sql

EVENT_TIME = "event_timestamp"

# Metric name -> aggregate expression.
METRIC_SQL = {
    COUNT: "count(1)",
    MAX_AMOUNT: "max(amount)",
    # exact decimals: a sum of doubles depends on the order of rows, and rules compare it strictly
    TOTAL_AMOUNT: "CAST(sum(TRY_CAST(amount AS DECIMAL(28,10))) AS DOUBLE)",
    MIN_AMOUNT: "min(amount)",
    # HyperLogLog++; exact for the small per-window category counts it is used for.
    DISTINCT_CATEGORIES: "approx_count_distinct(merchant_category)",
}


def with_watermark(df: DataFrame, delay: str | None) -> DataFrame:
    """Declare the event-time watermark on streaming input; batch frames pass through."""
    if df.isStreaming and delay:
        return df.withWatermark(EVENT_TIME, delay)
    return df


def _with_categories(df: DataFrame, profile: RuleProfile) -> DataFrame:
    """Payloads without a category: the distinct count is 0, as over all-NULL input."""
    if DISTINCT_CATEGORIES in profile.metrics and "merchant_category" not in df.columns:
        return df.withColumn("merchant_category", F.lit(None).cast("string"))
    return df


def _grouped(
    df: DataFrame,
    profile: RuleProfile,
    window: str | None,
    slide: str | None,
    watermark: str | None | bool,
) -> DataFrame:
    duration = window or profile.window
    delay = profile.watermark if watermark is True else (watermark or None)
    src = with_watermark(_with_categories(df, profile), delay)
    bucket = F.window(EVENT_TIME, duration, slide) if slide else F.window(EVENT_TIME, duration)
    return src.groupBy(bucket.alias("window"), F.col("user_id")).agg(
        *[F.expr(METRIC_SQL[m]).alias(m) for m in profile.metrics]
    )


_FLAT = ("window.start AS window_start", "window.end AS window_end", "user_id")

# Metric -> its partial value in a pane, and how the panes of a window merge. Distinct counts are kept as sketches,
# which merge without counting a category of two panes twice; totals stay exact decimals until the last step.
PANE_SQL = METRIC_SQL | {
    TOTAL_AMOUNT: "sum(TRY_CAST(amount AS DECIMAL(28,10)))",
    DISTINCT_CATEGORIES: "hll_sketch_agg(merchant_category)",
}
PANE_MERGE_SQL = {
    COUNT: f"sum({COUNT})",
    MAX_AMOUNT: f"max({MAX_AMOUNT})",
    MIN_AMOUNT: f"min({MIN_AMOUNT})",
    TOTAL_AMOUNT: f"CAST(sum({TOTAL_AMOUNT}) AS DOUBLE)",
    DISTINCT_CATEGORIES: f"hll_sketch_estimate(hll_union_agg({DISTINCT_CATEGORIES}))",
}
# Panes are merged in groups of at least so many window starts, so that no task holds all panes of a user.
_GROUP_STARTS = 64
_UNIT_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
                "week": 604_800_000_000}


def _micros(duration: str) -> int | None:
    """``'5 minutes'`` -> microseconds; None for forms this shortcut does not handle."""
    parts = duration.strip().lower().split()
    if len(parts) != 2 or not parts[0].isdigit():
        return None
    unit = parts[1][:-1] if parts[1].endswith("s") else parts[1]
    return int(parts[0]) * _UNIT_MICROS[unit] if unit in _UNIT_MICROS else None


def _pane_plan_applies(df: DataFrame, profile: RuleProfile, duration: str, slide: str | None) -> int | None:
    """Panes per window when the batch pane plan gives the same result, else None."""
    if df.isStreaming or not slide or any(m not in PANE_MERGE_SQL for m in profile.metrics):
        return None
    size, step = _micros(duration), _micros(slide)
    if not size or not step or size <= step or size % step:
        return None
    return size // step


def _sliding_by_panes(df: DataFrame, profile: RuleProfile, duration: str, slide: str, per_pane: int) -> DataFrame:
    """Sliding windows from panes (tumbling windows of one slide), for batch input.

    Spark's own sliding window copies every row into each of its ``duration/slide``
    windows before the map-side aggregate, so with sparse users about that many rows per
    event cross the shuffle. Here rows are first aggregated per (pane, user), with a
    map-side partial aggregate, so a user holding a third of all rows collapses to one row
    per task and pane. Panes are then hash-partitioned by user and group of window starts;
    a pane whose windows start in two groups goes to both. Each pane is expanded into its
    windows of the group and merged inside the partition: the grouping is already satisfied,
    so there is no third exchange. A task holds a bounded number of panes of a user, however
    many transactions the user has and however long the time range is. Count, max, min and
    total merge exactly, distinct counts through their sketches.
    """
    step = _micros(slide)
    starts = f"({max(_GROUP_STARTS, 16 * per_pane) * step}L)"
    panes = (
        _with_categories(df, profile)
        .groupBy(F.window(EVENT_TIME, slide).alias("pane"), F.col("user_id"))
        .agg(*[F.expr(PANE_SQL[m]).alias(m) for m in profile.metrics])
        .selectExpr("user_id", *profile.metrics, "unix_micros(pane.start) AS pane_start")
    )
    grouped = panes.selectExpr(
        "*",
        f"explode(sequence(CAST(floor((pane_start - {(per_pane - 1) * step}L) / {starts}) AS BIGINT), "
        f"CAST(floor(pane_start / {starts}) AS BIGINT))) AS starts",
    ).repartition("user_id", "starts")
    expanded = grouped.selectExpr(
        "user_id", "starts", *profile.metrics, f"explode(sequence(0, {per_pane - 1})) AS k", "pane_start"
    ).selectExpr("user_id", "starts", *profile.metrics, f"pane_start - k * {step}L AS window_micros")
    merged = (
        expanded.where(f"CAST(floor(window_micros / {starts}) AS BIGINT) = starts")
        .groupBy("user_id", "starts", "window_micros")
        .agg(*[F.expr(PANE_MERGE_SQL[m]).alias(m) for m in profile.metrics])
    )
    return merged.selectExpr(
        "timestamp_micros(window_micros) AS window_start",
        f"timestamp_micros(window_micros + {per_pane * step}L) AS window_end",
        "user_id",
        *profile.metrics,
    )


def window_metrics(
    df: DataFrame,
    profile: RuleProfile,
    window: str | None = None,
    slide: str | None = None,
    watermark: str | None | bool = True,
) -> DataFrame:
    """Per (window, user) metrics of ``profile`` with flat ``window_start``/``window_end``.

    ``watermark=True`` uses the profile's delay, a string overrides it, ``False``/``None``
    disables it (streaming state would then grow without bound).
    """
    duration = window or profile.window
    per_pane = _pane_plan_applies(df, profile, duration, slide)
    if per_pane:
        return _sliding_by_panes(df, profile, duration, slide, per_pane)
    return _grouped(df, profile, window, slide, watermark).selectExpr(*_FLAT, *profile.metrics)


def aggregate(
    df: DataFrame,
    profile: RuleProfile,
    window: str | None = None,
    slide: str | None = None,
    watermark: str | None | bool = True,
) -> DataFrame:
    """Window metrics plus one indicator per rule and the profile's flag column."""
    duration = window or profile.window
    per_pane = _pane_plan_applies(df, profile, duration, slide)
    if per_pane:
        metrics = _sliding_by_panes(df, profile, duration, slide, per_pane)
        return metrics.selectExpr("*", *rule_columns_sql(profile))
    grouped = _grouped(df, profile, window, slide, watermark)
    return grouped.selectExpr(*_FLAT, *profile.metrics, *rule_columns_sql(profile))


def sliding_stream(df: DataFrame, profile: RuleProfile, window: str, slide: str) -> DataFrame:
    """Sliding windows on a stream, from panes: two chained stateful aggregations, for append mode.

    The first seals panes (tumbling windows of one slide) as the watermark passes them; the second merges sealed
    panes into the windows that contain them. A row is kept once per pane instead of once per window, and each
    window costs one update per pane instead of one per row. Windows come out once, when the watermark passes
    their end, like those of one aggregation; ``window`` must be a whole number of slides.
    """
    size, step = _micros(window), _micros(slide)
    if not size or not step or size % step:
        raise ValueError(f"{window} is no whole number of {slide}")
    panes = (
        with_watermark(_with_categories(df, profile), profile.watermark)
        .groupBy(F.window(EVENT_TIME, slide), F.col("user_id"))
        .agg(*[F.expr(PANE_SQL[m]).alias(m) for m in profile.metrics])
    )
    # a pane's time is its last instant: no window ends between the two
    placed = panes.select(F.window_time("window").alias("pane_time"), "user_id", *profile.metrics)
    merged = placed.groupBy(F.window("pane_time", window, slide), F.col("user_id")).agg(
        *[F.expr(PANE_MERGE_SQL[m]).alias(m) for m in profile.metrics]
    )
    return merged.selectExpr(*_FLAT, *profile.metrics, *rule_columns_sql(profile))


def flagged(df: DataFrame, profile: RuleProfile) -> DataFrame:
    """Keep windows where the profile fired (NULL counts as not fired)."""
    return df.where(profile.flagged)
