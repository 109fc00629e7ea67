"""Randomised checks against plain-Python models (many cases per Spark job)."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from helpers import UTC, base_row, frame
from stratum import schemas
from stratum.functions.rules import first_violation, silver_rules, transaction_rules
from stratum.functions import normalize
from stratum.operators import summarize


def _half_up(value: Decimal, places: int) -> Decimal:
    return value.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def test_exact_sums_and_means_match_decimal_arithmetic(spark):
    rng = random.Random(7)
    rows, groups = [], {}
    for i in range(3000):
        g = f"g{rng.randrange(60)}"
        cents = rng.randrange(-500000, 5000000) if g != "g0" else rng.randrange(1, 400)
        amount = cents / 100
        rows.append((dt.datetime(2026, 1, 1, tzinfo=UTC), g, amount))
        groups.setdefault(g, []).append(Decimal(cents) / 100)
    df = spark.createDataFrame(rows, "event_time timestamp, category string, amount double")
    got = {r.category: r for r in summarize.category_summary(df, "1 day").collect()}
    for g, values in groups.items():
        total = sum(values)
        mean = total / len(values)
        assert got[g].event_count == len(values)
        assert got[g].total_amount == float(total), g
        # half away from zero, like a NUMERIC column
        expected = _half_up(abs(mean), 2) * (1 if mean >= 0 else -1)
        assert got[g].average_amount == float(expected), g


CHOICES = {
    "financing_id": ["F1", None],
    "vehicle_type": ["CAR", "MOTORCYCLE", " car ", "TRUCK", None, "", "\tCAR"],
    "region": ["SOUTH", "NORTH", "SP", " south ", "XX", None, ""],
    "status": ["ACTIVE", "active ", "FOO", None],
    "financed_amount": [100.0, 0.0, -1.0, None],
    "monthly_installment": [10.0, 0.0, -2.0, None],
    "created_at": [dt.datetime(2026, 1, 1, tzinfo=UTC), None],
    "segment": [" Premium ", "standard", None],
}


def _model(row, normalise, rule_set):
    r = dict(row)
    if normalise:
        for c in normalize.UPPER_COLUMNS:
            if r.get(c) is not None:
                r[c] = r[c].strip(" ").upper()
        for c in normalize.LOWER_COLUMNS:
            if r.get(c) is not None:
                r[c] = r[c].strip(" ").lower()

    def not_in(v, domain):
        return v is not None and v not in domain

    def le0(v):
        return v is not None and v <= 0

    if rule_set == "transaction":
        checks = [
            ("missing_id", r["financing_id"] is None),
            ("bad_vehicle_type", not_in(r["vehicle_type"], schemas.VEHICLE_TYPES)),
            ("bad_region", not_in(r["region"], schemas.REGIONS + schemas.STATE_CODES)),
            ("missing_amount", r["financed_amount"] is None),
            ("nonpositive_amount", le0(r["financed_amount"])),
            ("nonpositive_installment", le0(r["monthly_installment"])),
        ]
    else:
        checks = [
            ("missing_id", r["financing_id"] is None),
            ("bad_vehicle_type", not_in(r["vehicle_type"], schemas.VEHICLE_TYPES)),
            ("bad_region", not_in(r["region"], schemas.REGIONS)),
            ("bad_status", not_in(r["status"], schemas.STATUSES)),
            ("nonpositive_amount", le0(r["financed_amount"])),
            ("nonpositive_installment", le0(r["monthly_installment"])),
            ("missing_created_at", r["created_at"] is None),
        ]
    return next((code for code, hit in checks if hit), None)


def test_rule_sets_match_python_model(spark):
    rng = random.Random(11)
    rows = []
    for i in range(2000):
        changes = {c: rng.choice(v) for c, v in CHOICES.items()}
        rows.append({**base_row(**changes), "vehicle_id": f"V{i}"})
    df = frame(spark, rows)
    t = {r.vehicle_id: r.reason for r in df.select(
        "vehicle_id", first_violation(transaction_rules()).alias("reason")).collect()}
    s = {r.vehicle_id: r.reason for r in normalize.clean(df).select(
        "vehicle_id", first_violation(silver_rules()).alias("reason")).collect()}
    for row in rows:
        assert t[row["vehicle_id"]] == _model(row, False, "transaction"), row
        assert s[row["vehicle_id"]] == _model(row, True, "silver"), row
    assert F is not None


CONTRACT_CHOICES = {
    "financing_id": ["FIN-0000000001", "FIN-20260918-000001", "FIN-123", None],
    "customer_id": ["CUS-0000000A", "CUS-abc", "CUS-ABCDEFGH", None],
    "vehicle_type": ["CAR", "MOTORCYCLE", "TRUCK", None],
    "vehicle_brand": ["Toyota", "T", "", None],
    "vehicle_model": ["X", "", None],
    "vehicle_year": [1999, 2000, 2100, 2101, None],
    "segment": ["premium", "SUV", None],
    "region": ["SOUTH", "SP", "", None],
    "state": ["PR", "pr", "PRX", None],
    "city": ["Curitiba", "C", None],
    "financed_amount": [100.01, 0.0, -1.0, 10.005, None],
    "down_payment": [0.0, -0.01, 1.1, 2.345, None],
    "installment_count": [0, 1, 120, 121, None],
    "monthly_installment": [5.25, 0.0, -3.333, None],
    "interest_rate_monthly": [0.0, 1.5, 100.0, 100.5, -0.1, None],
    "status": ["ACTIVE", "active", None],
    "currency": ["BRL", "USD", None],
    "created_at": [dt.datetime(2026, 1, 1, tzinfo=UTC), None],
}


def _contract_model(r):
    import re

    from stratum.functions.rules import (
        CONTRACT_CENTS, CONTRACT_ENUMS, CONTRACT_MIN_LENGTH, CONTRACT_PATTERNS, CONTRACT_RANGES)

    out = [f"required:{c}" for c in schemas.FINANCING_COLUMNS if r[c] is None]
    out += [f"pattern:{c}" for c, p in CONTRACT_PATTERNS if r[c] is not None and not re.search(p, r[c])]
    out += [f"enum:{c}" for c, v in CONTRACT_ENUMS if r[c] is not None and r[c] not in v]
    for c, low, high, exclusive in CONTRACT_RANGES:
        v = r[c]
        if v is None:
            continue
        if (v <= low if exclusive else v < low) or (high is not None and v > high):
            out.append(f"range:{c}")
    for c in CONTRACT_CENTS:
        v = r[c]
        if v is not None and float(_half_up(Decimal(repr(v)), 2)) != v:
            out.append(f"cents:{c}")
    out += [f"length:{c}" for c, n in CONTRACT_MIN_LENGTH if r[c] is not None and len(r[c]) < n]
    return ",".join(out)


def test_contract_rules_match_python_model(spark):
    from stratum.functions.rules import contract_rules
    from stratum.operators import validate

    rng = random.Random(5)
    rows = [{**base_row(**{c: rng.choice(v) for c, v in CONTRACT_CHOICES.items()}), "vehicle_id": f"V{i}"}
            for i in range(2000)]
    got = {r.vehicle_id: r.violation_text for r in validate.contract_check(frame(spark, rows), contract_rules())
           .select("vehicle_id", "violation_text").collect()}
    for row in rows:
        assert got[row["vehicle_id"]] == _contract_model(row), row
