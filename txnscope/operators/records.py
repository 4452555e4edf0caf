"""Hot-table records built from window aggregates (one SQL projection each, no row loop).

``as_of`` is the detection/processing time stamped on each record, given as a SQL
expression. Streaming sinks use ``current_timestamp()`` (fixed per micro-batch);
reproducible runs pass a column name such as ``window_end`` or a timestamp literal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from txnscope.config import ALERT_STATUS_NEW, ANOMALY, FRAUD, RuleProfile
from txnscope.functions.rules import flag_list_sql, severity_sql
from txnscope.functions.values import (
    DAY_SECONDS,
    epoch_plus_days_sql,
    iso_local_sql,
    iso_utc_sql,
    money_sql,
    user_key_sql,
    window_key_sql,
)

NOW = "current_timestamp()"


def anomaly_records(windows: DataFrame, profile: RuleProfile = ANOMALY, as_of: str | None = None) -> DataFrame:
    """Flagged windows -> keyed anomaly records (key ``user#window_start``).

    A NULL rule indicator (all amounts NULL) does not raise its flag; the record is still
    written when another rule fired, with a NULL ``max_amount``.
    """
    at = as_of or NOW
    return windows.where(profile.flagged).selectExpr(
        f"{window_key_sql('user_id', 'window_start')} AS transaction_id",
        "user_id",
        f"{iso_local_sql('window_start')} AS window_start",
        f"{iso_local_sql('window_end')} AS window_end",
        "transaction_count",
        f"{money_sql('max_amount')} AS max_amount",
        f"{flag_list_sql(profile)} AS {profile.flags_column}",
        f"true AS {profile.flagged}",
        f"{iso_utc_sql(at)} AS detected_at",
        f"{epoch_plus_days_sql(at, profile.record_ttl_days)} AS ttl",
    )


def fraud_aggregates(windows: DataFrame, profile: RuleProfile = FRAUD, as_of: str | None = None) -> DataFrame:
    """Every window -> aggregate record keyed by (pk=user, sk=window_start)."""
    at = as_of or NOW
    return windows.selectExpr(
        f"{user_key_sql('user_id')} AS pk",
        f"{iso_local_sql('window_start')} AS sk",
        "user_id",
        f"{iso_local_sql('window_start')} AS window_start",
        f"{iso_local_sql('window_end')} AS window_end",
        "transaction_count",
        f"{money_sql('total_amount')} AS total_amount",
        f"{money_sql('max_amount')} AS max_amount",
        f"{money_sql('min_amount')} AS min_amount",
        "distinct_merchant_categories AS distinct_categories",
        f"coalesce({profile.flagged}, false) AS {profile.flagged}",
        f"{flag_list_sql(profile)} AS {profile.flags_column}",
        f"{iso_utc_sql(at)} AS processed_at",
        f"{epoch_plus_days_sql(at, profile.record_ttl_days)} AS ttl",
    )


def alert_expiry_sql(profile: RuleProfile = FRAUD) -> str:
    """Expiry of an alert, from that of its aggregate row."""
    return f"ttl + {(profile.alert_ttl_days - profile.record_ttl_days) * DAY_SECONDS}"


def fraud_alerts(aggregates: DataFrame, profile: RuleProfile = FRAUD) -> DataFrame:
    """Alerts derived from aggregate records (apply to the *latest* row per key).

    Deriving alerts from the newest aggregate row means an alert disappears when a later
    update (e.g. a refund) un-flags its window, instead of lingering as a stale row.
    """
    return aggregates.where(profile.flagged).selectExpr(
        "concat_ws('#', pk, sk) AS alert_id",
        "user_id",
        "window_start",
        "window_end",
        "transaction_count",
        "total_amount",
        "max_amount",
        profile.flags_column,
        f"{severity_sql(profile.flags_column)} AS severity",
        f"'{ALERT_STATUS_NEW}' AS status",
        "processed_at AS created_at",
        f"{alert_expiry_sql(profile)} AS ttl",
    )
