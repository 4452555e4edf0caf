"""Rule evaluation as SQL expressions over window metrics (no UDFs, no row loops).

Comparisons are strict ``>``. The OR over rules is SQL three-valued: a NULL metric (all
amounts NULL) yields a NULL indicator, ``NULL OR true`` is true and ``NULL OR false`` is
NULL, so such a window is dropped by ``filter(flagged)``; in flag lists a NULL
indicator simply does not fire.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.config import SEVERITY_HIGH, SEVERITY_MEDIUM, Rule, RuleProfile


def _literal(value: float) -> str:
    if isinstance(value, int):
        return str(value)
    return f"{float(value)!r}D"  # double literal


def indicator_sql(rule: Rule) -> str:
    return f"({rule.metric} > {_literal(rule.threshold)})"


def flagged_sql(profile: RuleProfile) -> str:
    """OR of every rule of the profile, written over the metric columns."""
    return "(" + " OR ".join(indicator_sql(r) for r in profile.rules) + ")"


def rule_columns_sql(profile: RuleProfile) -> list[str]:
    """``indicator AS is_x`` for each rule, then ``... AS <flagged>``."""
    out = [f"{indicator_sql(r)} AS {r.indicator}" for r in profile.rules]
    out.append(f"{flagged_sql(profile)} AS {profile.flagged}")
    return out


def flag_list_sql(profile: RuleProfile) -> str:
    """Ordered ``ARRAY<STRING>`` of fired rule labels, over the indicator columns."""
    items = ", ".join(f"CASE WHEN {r.indicator} THEN '{r.flag}' END" for r in profile.rules)
    return f"array_compact(array({items}))"


def severity_sql(flags: str) -> str:
    """HIGH when more than one rule fired, else MEDIUM."""
    return f"CASE WHEN size({flags}) > 1 THEN '{SEVERITY_HIGH}' ELSE '{SEVERITY_MEDIUM}' END"


# Column / DataFrame forms ------------------------------------------------------------
def apply_rules(df: DataFrame, profile: RuleProfile) -> DataFrame:
    """Add one boolean indicator per rule and the profile's OR-ed flag column."""
    return df.selectExpr("*", *rule_columns_sql(profile))


def flag_list(profile: RuleProfile) -> Column:
    return F.expr(flag_list_sql(profile))


def flagged_or_false(profile: RuleProfile) -> Column:
    """The flag column with NULL read as not flagged (for rows written regardless)."""
    return F.expr(f"coalesce({profile.flagged}, false)")


def severity(flags: str) -> Column:
    return F.expr(severity_sql(flags))
