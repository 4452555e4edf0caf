"""Scalar helpers: ISO text, money, record keys, expiry stamps, lenient coercion.

Each helper exists in two forms: ``*_sql`` returns Spark SQL expression text over column
names or SQL expressions (used with ``selectExpr``/``F.expr``, so a whole projection is
handed to Catalyst in one call), and the plain name returns a ``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnscope.config import NULL_USER_KEY

DAY_SECONDS = 86_400
MONEY = T.DecimalType(18, 2)
MONEY_SQL = "DECIMAL(18,2)"

_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _iso_sql(c: str, suffix: str) -> str:
    # Python's isoformat(): microseconds appear only when non-zero.
    return (
        f'CASE WHEN unix_micros({c}) % 1000000 = 0 THEN date_format({c}, "{_SECONDS}{suffix}") '
        f'ELSE date_format({c}, "{_MICROS}{suffix}") END'
    )


def iso_local_sql(c: str) -> str:
    """Timestamp as offset-free ISO text (``2024-01-01T00:00:00``), session time zone."""
    return _iso_sql(c, "")


def iso_utc_sql(c: str) -> str:
    """Timestamp as ISO text with offset (``2024-01-01T00:00:00+00:00``)."""
    return _iso_sql(c, "xxx")


def money_sql(c: str) -> str:
    """Amount as DECIMAL(18,2), rounded half-up (2.675 -> 2.68); null if it does not fit or is not a number."""
    return f"TRY_CAST({c} AS {MONEY_SQL})"


def user_key_sql(user: str) -> str:
    """User part of record keys; a missing user keys as ``None``."""
    return f"coalesce({user}, '{NULL_USER_KEY}')"


def window_key_sql(user: str, window_start: str) -> str:
    """Deterministic record key ``user#window_start``."""
    return f"concat_ws('#', {user_key_sql(user)}, {iso_local_sql(window_start)})"


def epoch_plus_days_sql(as_of: str, days: int) -> str:
    """Expiry stamp: epoch seconds of ``as_of`` plus ``days`` days (BIGINT)."""
    return f"unix_timestamp({as_of}) + {days * DAY_SECONDS}"


def lenient_number_sql(c: str, data_type: str = "double") -> str:
    """Coerce to a number; anything unparsable becomes NULL instead of failing."""
    return f"try_cast({c} AS {data_type})"


def lenient_timestamp_sql(c: str) -> str:
    """ISO-8601 text (any offset) or a timestamp to TIMESTAMP; bad text -> NULL."""
    return f"try_to_timestamp(CAST({c} AS STRING))"


# Column forms ------------------------------------------------------------------------
def iso_local(c: str) -> Column:
    return F.expr(iso_local_sql(c))


def iso_utc(c: str) -> Column:
    return F.expr(iso_utc_sql(c))


def money(c: str) -> Column:
    return F.expr(money_sql(c))


def window_key(user: str, window_start: str) -> Column:
    return F.expr(window_key_sql(user, window_start))


def epoch_plus_days(as_of: str, days: int) -> Column:
    return F.expr(epoch_plus_days_sql(as_of, days))


def lenient_number(c: str, data_type: str = "double") -> Column:
    return F.expr(lenient_number_sql(c, data_type))


def lenient_timestamp(c: str) -> Column:
    return F.expr(lenient_timestamp_sql(c))
