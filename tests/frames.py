"""Small hand-made source frames."""

from __future__ import annotations

import datetime

from renewlens import schemas

AS_OF = datetime.date(2024, 4, 14)


def days(n: int) -> datetime.date:
    return AS_OF + datetime.timedelta(days=n)


def accounts(spark, *ids, **changes):
    rows = [
        {
            "account_idx": i,
            "account_id": key,
            "company_name": f"Company {i}",
            "industry": "Retail",
            "plan_type": "Growth",
            "country": "Germany",
            "contract_start_date": days(-100),
            **changes,
        }
        for i, key in enumerate(ids)
    ]
    return spark.createDataFrame(rows, schemas.ACCOUNTS)


def subscriptions(spark, *rows):
    """Rows of (subscription_id, account_id, revenue, status, renewal day offset)."""
    return spark.createDataFrame(
        [(s, a, r, st, None if d is None else days(d)) for s, a, r, st, d in rows],
        schemas.SUBSCRIPTIONS,
    )


def events(spark, *rows):
    """Rows of (event_id, account_id, day offset, minutes, pages)."""
    return spark.createDataFrame(
        [(e, a, "Search", days(d), m, p) for e, a, d, m, p in rows], schemas.USAGE_EVENTS
    )
