"""Contracts read from a JSON Schema document."""

import copy
import json

import pytest

from helpers import base_row, frame
from stratum import schemas
from stratum.functions.contract import Contract, read_contract
from stratum.functions.rules import contract_document, contract_rules
from stratum.session import create_file

ROWS = [
    base_row(), base_row(financing_id=None), base_row(financing_id="FIN-1\n"), base_row(vehicle_year=1999, vehicle_brand="X"),
    base_row(financed_amount=0.0, down_payment=0.001, installment_count=121, region="SP", state="pr"), base_row(segment=None),
]


def hits(df):
    return [set(r.violations) for r in df.collect()]


def test_document_gives_the_same_rules(spark, tmp_root):
    from stratum.operators.validate import contract_check

    create_file(spark, tmp_root + "/c.json", json.dumps(contract_document(), indent=2))
    contract = read_contract(spark, tmp_root + "/c.json")
    assert len(contract.rules()) == len(contract_rules()) == 39
    assert {r.code for r in contract.rules()} == {r.code for r in contract_rules()}
    assert hits(contract.check(frame(spark, ROWS))) == hits(contract_check(frame(spark, ROWS), contract_rules()))
    assert contract.schema().fieldNames() == list(schemas.FINANCING_COLUMNS)


def test_a_changed_document_changes_the_rules(spark):
    doc = copy.deepcopy(contract_document())
    doc["required"].remove("segment")
    doc["properties"]["vehicle_year"]["maximum"] = 2020
    doc["properties"]["region"]["enum"] = ["SP"]
    doc["properties"]["installment_count"] = {"type": "integer", "multipleOf": 5, "exclusiveMaximum": 120}
    doc["properties"]["city"]["maxLength"] = 3
    got = hits(Contract.of(doc).check(frame(spark, [base_row(segment=None, installment_count=120, vehicle_year=2021), base_row(region="SP", city="Rio", vehicle_year=2020, installment_count=24)])))
    common = {"pattern:financing_id", "pattern:customer_id"}
    assert got == [common | {"range:vehicle_year", "enum:region", "range:installment_count", "length:city"}, common | {"step:installment_count"}]


def test_raw_checks_follow_the_document(spark):
    doc = {"type": "object", "properties": {"a": {"type": "string", "format": "date-time"}, "b": {"type": "number"}}, "additionalProperties": False}
    lines = ['{"a": "2026-01-01T00:00:00Z", "b": 1}', '{"a": "01/02/2026", "c": 1, "d": 2}', "no json", "{}"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    raw = lambda d: [list(r[0]) for r in df.select(Contract.of(d).raw_violations(df.value)).collect()]
    assert raw(doc) == [[], ["additional:c", "additional:d", "format:a"], ["parse:json"], []]
    assert raw({**doc, "additionalProperties": True})[1] == ["format:a"]


@pytest.mark.parametrize("change,message", [
    ({"oneOf": []}, "keywords"), ({"type": "array"}, "type"), ({"format": "email"}, "format"), ({"multipleOf": 0.25}, "multipleOf"),
])
def test_what_has_no_rule_is_refused(change, message, spark):
    doc = {"type": "object", "properties": {"a": {"type": "number", **change}}}
    with pytest.raises(ValueError, match=message):
        Contract.of(doc).rules()
    with pytest.raises(ValueError, match="not declared"):
        Contract.of({"type": "object", "required": ["x"]})
