"""Column expressions shared by operators: built-in Spark SQL expressions only.

``*_sql`` helpers return expression text for ``selectExpr``/``F.expr``; the others
return ``Column`` objects.
"""

from txnscope.functions.rules import (
    apply_rules,
    flag_list,
    flag_list_sql,
    flagged_or_false,
    flagged_sql,
    indicator_sql,
    rule_columns_sql,
    severity,
    severity_sql,
)
from txnscope.functions.values import (
    epoch_plus_days,
    epoch_plus_days_sql,
    iso_local,
    iso_local_sql,
    iso_utc,
    iso_utc_sql,
    lenient_number,
    lenient_number_sql,
    lenient_timestamp,
    lenient_timestamp_sql,
    money,
    money_sql,
    window_key,
    window_key_sql,
)

__all__ = [
    "apply_rules",
    "epoch_plus_days",
    "epoch_plus_days_sql",
    "flag_list",
    "flag_list_sql",
    "flagged_or_false",
    "flagged_sql",
    "indicator_sql",
    "iso_local",
    "iso_local_sql",
    "iso_utc",
    "iso_utc_sql",
    "lenient_number",
    "lenient_number_sql",
    "lenient_timestamp",
    "lenient_timestamp_sql",
    "money",
    "money_sql",
    "rule_columns_sql",
    "severity",
    "severity_sql",
    "window_key",
    "window_key_sql",
]
