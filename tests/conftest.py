from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txnscope.schemas import TRANSACTION  # noqa: E402
from txnscope.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # The checkpoint folder comes from the environment's Spark defaults when it names one;
    # otherwise txnscope.session.shared_root creates a private folder (local master only).
    session = build_session("local[*]", app_name="txnscope-tests", shuffle_partitions=8)
    yield session
    session.stop()


def ts(text: str) -> datetime:
    """UTC wall time (the session time zone is UTC)."""
    return datetime.fromisoformat(text)


def txn_frame(spark, rows):
    """Rows of (transaction_id, user_id, amount, event_time[, merchant_category])."""
    full = []
    for r in rows:
        tid, user, amount, when = r[:4]
        category = r[4] if len(r) > 4 else None
        moment = ts(when) if isinstance(when, str) else when
        full.append((tid, user, amount, "m", category, moment, moment))
    return spark.createDataFrame(full, TRANSACTION)
