"""Row builders for the financing fixtures."""

from __future__ import annotations

import datetime as dt

from stratum import schemas

UTC = dt.timezone.utc


def base_row(**changes):
    row = {
        "financing_id": "F1",
        "customer_id": "C1",
        "vehicle_type": "CAR",
        "vehicle_id": "V",
        "vehicle_brand": "Toyota",
        "vehicle_model": "X",
        "vehicle_year": 2025,
        "segment": "premium",
        "region": "SOUTH",
        "state": "PR",
        "city": "Curitiba",
        "financed_amount": 100.0,
        "down_payment": 0.0,
        "installment_count": 24,
        "monthly_installment": 10.0,
        "interest_rate_monthly": 1.5,
        "status": "ACTIVE",
        "currency": "BRL",
        "created_at": dt.datetime(2026, 1, 1, tzinfo=UTC),
    }
    row.update(changes)
    return row


def frame(spark, rows):
    return spark.createDataFrame(
        [tuple(r[c] for c in schemas.FINANCING_COLUMNS) for r in rows], schemas.FINANCING
    )
