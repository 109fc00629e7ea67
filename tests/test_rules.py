from pyspark.sql import functions as F

from helpers import base_row, frame
from stratum.functions.rules import contract_rules, first_violation, silver_rules, transaction_rules
from stratum.functions import normalize
from stratum.operators import validate

# (case, changes, transaction result, silver result); None = passes
VALIDATION_CASES = [
    ("R1", {}, None, None),
    ("R2", {"financing_id": None}, "missing_id", "missing_id"),
    ("R3", {"vehicle_type": "TRUCK"}, "bad_vehicle_type", "bad_vehicle_type"),
    ("R4", {"vehicle_type": None}, None, None),
    ("R5", {"vehicle_type": " car "}, "bad_vehicle_type", None),
    ("R6", {"region": "SP"}, None, "bad_region"),
    ("R7", {"region": None}, None, None),
    ("R8", {"region": " south "}, "bad_region", None),
    ("R9", {"status": "FOO"}, None, "bad_status"),
    ("R10", {"status": None}, None, None),
    ("R11", {"financed_amount": None}, "missing_amount", None),
    ("R12", {"financed_amount": 0.0}, "nonpositive_amount", "nonpositive_amount"),
    ("R13", {"financed_amount": -5.0, "monthly_installment": -1.0}, "nonpositive_amount", "nonpositive_amount"),
    ("R14", {"monthly_installment": 0.0}, "nonpositive_installment", "nonpositive_installment"),
    ("R15", {"monthly_installment": None}, None, None),
    ("R16", {"created_at": None}, None, "missing_created_at"),
    ("R17", {"vehicle_type": "TRUCK", "region": "XX", "financed_amount": -1.0}, "bad_vehicle_type", "bad_vehicle_type"),
    ("R18", {c: None for c in base_row()}, "missing_id", "missing_id"),
    ("R19", {"region": ""}, "bad_region", "bad_region"),
    ("R20", {"vehicle_type": "\tCAR"}, "bad_vehicle_type", "bad_vehicle_type"),
]


def _reasons(spark, rules, normalise):
    rows = [{**base_row(**changes), "vehicle_id": case} for case, changes, _, _ in VALIDATION_CASES]
    df = frame(spark, rows)
    if normalise:
        df = normalize.clean(df)
    out = df.select(F.col("vehicle_id").alias("case"), first_violation(rules).alias("r")).collect()
    return {r["case"]: r["r"] for r in out}


def test_transaction_rules_first_hit(spark):
    got = _reasons(spark, transaction_rules(), normalise=False)
    assert got == {case: t for case, _, t, _ in VALIDATION_CASES}


def test_silver_rules_after_normalisation(spark):
    got = _reasons(spark, silver_rules(), normalise=True)
    assert got == {case: s for case, _, _, s in VALIDATION_CASES}


def test_split_keeps_rejects_and_conserves_rows(spark):
    rows = [base_row(**changes) for _, changes, _, _ in VALIDATION_CASES]
    df = frame(spark, rows)
    valid, invalid = validate.validate_transactions(df)
    assert valid.count() + invalid.count() == len(rows)
    assert "validation_reason" not in valid.columns
    assert invalid.filter(F.col("validation_reason").isNull()).count() == 0


def test_strict_mode_rejects_unknown(spark):
    df = frame(spark, [base_row(vehicle_type=None), base_row(monthly_installment=None)])
    valid, invalid = validate.split(df, transaction_rules(), strict=True)
    assert valid.count() == 0
    reasons = sorted(r[0] for r in invalid.select("validation_reason").collect())
    assert reasons == ["bad_vehicle_type", "nonpositive_installment"]


def test_to_silver_drops_provenance_and_normalises(spark):
    df = frame(spark, [base_row(segment=" Premium ", region=" south ", vehicle_type="car")])
    df = df.withColumn("source_file", F.lit("f")).withColumn("ingestion_time", F.current_timestamp())
    out = validate.to_silver(df).collect()
    assert len(out) == 1
    assert (out[0]["segment"], out[0]["region"], out[0]["vehicle_type"]) == ("premium", "SOUTH", "CAR")
    assert "source_file" not in out[0].asDict()


CONTRACT_BASE = dict(
    financing_id="FIN-0000000001", customer_id="CUS-0000000A", vehicle_type="CAR", vehicle_id="V",
    vehicle_brand="Toyota", vehicle_model="X", vehicle_year=2025, segment="premium", region="SOUTH",
    state="PR", city="Curitiba", financed_amount=100.01, down_payment=0.0, installment_count=24,
    monthly_installment=5.25, interest_rate_monthly=1.5, status="ACTIVE", currency="BRL",
)
CONTRACT_CASES = [
    ("C1", {}, ""),
    ("C2", {"financing_id": "FIN-20260918-000001"}, "pattern:financing_id"),
    ("C3", {"customer_id": "CUS-abc"}, "pattern:customer_id"),
    ("C4", {"state": "sp"}, "pattern:state"),
    ("C5", {"vehicle_type": "TRUCK", "segment": "SUV"}, "enum:vehicle_type,enum:segment"),
    ("C6", {"region": "SP"}, "enum:region"),
    ("C7", {"status": "active", "currency": "USD"}, "enum:status,enum:currency"),
    ("C8", {"vehicle_year": 1999}, "range:vehicle_year"),
    ("C9", {"vehicle_year": 2100, "installment_count": 120}, ""),
    ("C10", {"installment_count": 121}, "range:installment_count"),
    ("C11", {"financed_amount": 0.0}, "range:financed_amount"),
    ("C12", {"financed_amount": 10.005}, "cents:financed_amount"),
    ("C13", {"down_payment": -1.0}, "range:down_payment"),
    ("C14", {"monthly_installment": -3.333}, "range:monthly_installment,cents:monthly_installment"),
    ("C15", {"interest_rate_monthly": 100.5}, "range:interest_rate_monthly"),
    ("C16", {"vehicle_brand": "T", "vehicle_model": "", "city": "C"},
     "length:vehicle_brand,length:vehicle_model,length:city"),
    ("C17", {"region": None, "created_at": None}, "required:region,required:created_at"),
    ("C18", {"financed_amount": 0.29, "down_payment": 1.1}, ""),
]


def test_contract_rule_count():
    assert len(contract_rules()) == 39


def test_contract_cases(spark):
    rows = [base_row(**{**CONTRACT_BASE, **changes}) for _, changes, _ in CONTRACT_CASES]
    checked = validate.contract_check(frame(spark, rows), contract_rules())
    got = [(r["violation_text"], r["violation_count"], list(r["violations"]))
           for r in checked.select("violation_text", "violation_count", "violations").collect()]
    for (case, _, expected), (text, count, arr) in zip(CONTRACT_CASES, got):
        assert text == expected, case
        assert count == (len(expected.split(",")) if expected else 0), case
        assert ",".join(arr) == expected, case


def test_reason_profile(spark):
    rows = [base_row(financing_id=None), base_row(financing_id=None), base_row(region="XX")]
    _, invalid = validate.validate_transactions(frame(spark, rows))
    got = {r[0]: r[1] for r in validate.reason_profile(invalid).collect()}
    assert got == {"missing_id": 2, "bad_region": 1}


def test_reason_profiles_one_pass_matches_separate_profiles(spark):
    rows = [base_row(**changes) for _, changes, _, _ in VALIDATION_CASES]
    df = frame(spark, rows)
    got = {(r.rule_set, r.validation_reason): r.row_count for r in validate.reason_profiles(
        df, {"transaction": (transaction_rules(), False), "silver": (silver_rules(), True)}).collect()}
    _, t_bad = validate.validate_transactions(df)
    _, s_bad = validate.to_silver(df, with_rejects=True)
    want = {("transaction", r[0]): r[1] for r in validate.reason_profile(t_bad).collect()}
    want.update({("silver", r[0]): r[1] for r in validate.reason_profile(s_bad).collect()})
    assert got == want


def test_raw_contract_checks(spark):
    lines = spark.createDataFrame([
        ('{"financing_id": "F1", "created_at": "2026-09-18T23:34:20.446440+00:00"}',),
        ('{"financing_id": "F2", "created_at": "2026-01-01T00:00:00Z", "promo": 1, "x": null}',),
        ('{"financing_id": "F3", "created_at": "18/09/2026"}',),
        ('{broken',),
        ('   ',),
    ], "value string")
    got = [r.raw_violation_text for r in validate.raw_contract_check(lines).collect()]
    assert got == ["", "additional:promo,additional:x", "format:created_at", "parse:json"]


def test_fifteen_column_rows_split_one_valid_one_invalid(spark):
    # F-C: the 19-column event without vehicle_id, state, city and created_at
    cols = [c for c in base_row() if c not in ("vehicle_id", "state", "city", "created_at")]
    rows = [
        {**base_row(financing_id="FIN-1", vehicle_type="CAR", region="SP", segment="SUV")},
        {**base_row(financing_id="FIN-2", vehicle_type="INVALID", region="SP", segment="SUV")},
    ]
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows],
                               ", ".join(f"{c} {'double' if c in ('financed_amount', 'down_payment', 'monthly_installment', 'interest_rate_monthly') else 'int' if c in ('vehicle_year', 'installment_count') else 'string'}" for c in cols))
    valid, invalid = validate.validate_transactions(df)
    assert valid.count() == 1 and invalid.count() == 1
    assert invalid.collect()[0]["validation_reason"] == "bad_vehicle_type"
    assert len(df.columns) == 15


def test_contract_patterns_refuse_a_trailing_line_feed(spark):
    from stratum.functions.rules import CONTRACT_PATTERNS, whole

    df = spark.createDataFrame([("FIN-0000000001\n",), ("FIN-0000000001",)], "id string")
    assert [r[0] for r in df.select(df.id.rlike(whole(CONTRACT_PATTERNS[0][1]))).collect()] == [False, True]
