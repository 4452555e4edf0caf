"""Rule profiles: a rule is data, a profile is an ordered list of rules plus timing.

Every rule is a strict ``>`` comparison of one window metric against a threshold; a
window is flagged when any rule fires (three-valued OR, so a NULL metric never raises
its own flag). Two profiles reproduce the two rule sets of the original pipeline.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Metric name -> aggregate it is computed with (see operators.windows.METRICS).
COUNT = "transaction_count"
MAX_AMOUNT = "max_amount"
TOTAL_AMOUNT = "total_amount"
MIN_AMOUNT = "min_amount"
DISTINCT_CATEGORIES = "distinct_merchant_categories"


@dataclass(frozen=True)
class Rule:
    flag: str  # label written into the flag list
    indicator: str  # boolean column holding the rule outcome
    metric: str  # window metric compared
    threshold: float  # strict greater-than

    def __post_init__(self) -> None:
        if not self.flag or not self.indicator:
            raise ValueError("rule needs a flag label and an indicator column")


@dataclass(frozen=True)
class RuleProfile:
    name: str
    rules: tuple[Rule, ...]
    metrics: tuple[str, ...]
    flagged: str  # OR of all indicators
    flags_column: str  # ordered list of fired flag labels
    window: str = "1 minute"
    watermark: str = "2 minutes"
    record_ttl_days: int = 30
    alert_ttl_days: int = 30
    extra: dict = field(default_factory=dict)

    def with_window(self, window: str) -> "RuleProfile":
        return replace(self, window=window)

    def with_watermark(self, watermark: str) -> "RuleProfile":
        return replace(self, watermark=watermark)

    def with_thresholds(self, **thresholds: float) -> "RuleProfile":
        """Override thresholds by indicator name, e.g. ``is_high_amount=500``."""
        unknown = set(thresholds) - {r.indicator for r in self.rules}
        if unknown:
            raise KeyError(f"unknown rule indicator(s): {sorted(unknown)}")
        rules = tuple(
            replace(r, threshold=thresholds.get(r.indicator, r.threshold)) for r in self.rules
        )
        return replace(self, rules=rules)


# ---------------------------------------------------------------------------------------
# Thresholds, labels and timings of the two original rule sets.
#
# Rule set A ("anomaly"): max amount > 2000, count > 3; 1-minute windows, 2-minute
#   watermark; records expire 30 days after detection.
# Rule set B ("fraud"): max amount > 1000, count > 5, total > 3000; 1-minute windows,
#   5-minute watermark; aggregate rows expire after 7 days, alerts after 30 days.
# Flag labels: HIGH_AMOUNT, HIGH_FREQUENCY (A); HIGH_SINGLE_TRANSACTION, HIGH_FREQUENCY,
#   HIGH_TOTAL_SPEND (B). Alert severity HIGH when more than one rule fired, else MEDIUM;
#   new alerts have status NEW. Triggers: hot path 10 seconds, cold path 30 seconds.
# ---------------------------------------------------------------------------------------
ANOMALY = RuleProfile(
    name="anomaly",
    rules=(
        Rule("HIGH_AMOUNT", "is_high_amount", MAX_AMOUNT, 2000.0),
        Rule("HIGH_FREQUENCY", "is_high_frequency", COUNT, 3),
    ),
    metrics=(COUNT, MAX_AMOUNT),
    flagged="is_anomaly",
    flags_column="anomaly_flags",
    window="1 minute",
    watermark="2 minutes",
    record_ttl_days=30,
    alert_ttl_days=30,
)

FRAUD = RuleProfile(
    name="fraud",
    rules=(
        Rule("HIGH_SINGLE_TRANSACTION", "is_high_amount", MAX_AMOUNT, 1000.0),
        Rule("HIGH_FREQUENCY", "is_high_frequency", COUNT, 5),
        Rule("HIGH_TOTAL_SPEND", "is_high_total_spend", TOTAL_AMOUNT, 3000.0),
    ),
    metrics=(COUNT, TOTAL_AMOUNT, MAX_AMOUNT, MIN_AMOUNT, DISTINCT_CATEGORIES),
    flagged="is_fraud",
    flags_column="fraud_flags",
    window="1 minute",
    watermark="5 minutes",
    record_ttl_days=7,
    alert_ttl_days=30,
)

SEVERITY_HIGH = "HIGH"
SEVERITY_MEDIUM = "MEDIUM"
ALERT_STATUS_NEW = "NEW"
HOT_TRIGGER = "10 seconds"
COLD_TRIGGER = "30 seconds"
# Column written as the table key when the user is missing (text of Python's None).
NULL_USER_KEY = "None"
