"""txnscope: threshold-rule anomaly detection over payment transactions on Spark.

Every transform is ``DataFrame -> DataFrame`` and runs unchanged on batch tables and on
Structured Streaming input. No UDFs, no RDDs, no driver-side loops over data.

Layout
------
``sources``    events adapter, JSON payload decode/encode/quarantine, cold lake reads, synthetic data
``functions``  column expressions: rule flags, flag lists, keys, money, ISO time text, expiry
``operators``  windowed aggregation, record builders, cold-table analytics, serving views
``sinks``      date-partitioned cold lake writer, keyed latest-wins log tables
``streaming``  hot/cold/final streaming queries, both-paths runner, progress metrics
``plans``      the named query catalogue and its DuckDB oracle SQL
"""

from txnscope.config import ANOMALY, FRAUD, Rule, RuleProfile
from txnscope.session import build_session, pin_utc, scratch_path

__all__ = [
    "ANOMALY",
    "FRAUD",
    "Rule",
    "RuleProfile",
    "build_session",
    "pin_utc",
    "scratch_path",
]
