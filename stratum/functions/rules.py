"""Quality rules as data, compiled to one Spark column each.

A :class:`Rule` is a stable code plus a boolean ``Column`` that is true when
the row violates it. Rule sets are ordered lists; two compilations exist:

* :func:`first_violation` - the code of the first rule hit (``NULL`` = row
  passes), a single ``CASE WHEN`` chain evaluated inside whole-stage codegen;
* :func:`all_violations` - every rule hit, in rule order, as ``array<string>``.

Null semantics follow SQL three-valued logic: a comparison on ``NULL`` is
unknown and does not reject the row (``NULL NOT IN (...)`` passes). A rule
built with ``null_is_violation=True`` - or any rule set compiled with
``strict=True`` - treats unknown as a violation instead.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratum import schemas


@dataclass(frozen=True)
class Rule:
    code: str
    violated: Column
    null_is_violation: bool = False

    def test(self, strict: bool = False) -> Column:
        if self.null_is_violation or strict:
            return F.coalesce(self.violated, F.lit(True))
        return self.violated

    def hit(self) -> Column:
        """True iff violated; unknown counts as not violated (all-hits mode)."""
        return F.coalesce(self.test(), F.lit(False))


def whole(pattern: str) -> str:
    """The pattern with its end anchored at the very end: Java's ``$`` also fits
    before a trailing line feed."""
    return pattern[:-1] + r"\z" if pattern.endswith("$") else pattern


def first_violation(rules: Sequence[Rule], strict: bool = False) -> Column:
    """Code of the first violated rule, ``NULL`` when the row passes."""
    if not rules:
        return F.lit(None).cast("string")
    chain = F.when(rules[0].test(strict), F.lit(rules[0].code))
    for rule in rules[1:]:
        chain = chain.when(rule.test(strict), F.lit(rule.code))
    return chain


def all_violations(rules: Sequence[Rule]) -> Column:
    """``array<string>`` of every violated rule code, in rule order."""
    hits = F.array(*[F.when(r.hit(), F.lit(r.code)) for r in rules])
    return F.filter(hits, lambda x: x.isNotNull())


# ---------------------------------------------------------------------------
# Rule sets of the data product
# ---------------------------------------------------------------------------

def _c(name: str) -> Column:
    return F.col(name)


def transaction_rules() -> list[Rule]:
    """Validator of the generated transaction stream (no normalisation first)."""
    return [
        Rule("missing_id", _c("financing_id").isNull()),
        Rule("bad_vehicle_type", ~_c("vehicle_type").isin(*schemas.VEHICLE_TYPES)),
        Rule("bad_region", ~_c("region").isin(*(schemas.REGIONS + schemas.STATE_CODES))),
        Rule("missing_amount", _c("financed_amount").isNull()),
        Rule("nonpositive_amount", _c("financed_amount") <= 0),
        Rule("nonpositive_installment", _c("monthly_installment") <= 0),
    ]


def silver_rules() -> list[Rule]:
    """Validator of the silver layer (applied after normalisation)."""
    return [
        Rule("missing_id", _c("financing_id").isNull()),
        Rule("bad_vehicle_type", ~_c("vehicle_type").isin(*schemas.VEHICLE_TYPES)),
        Rule("bad_region", ~_c("region").isin(*schemas.REGIONS)),
        Rule("bad_status", ~_c("status").isin(*schemas.STATUSES)),
        Rule("nonpositive_amount", _c("financed_amount") <= 0),
        Rule("nonpositive_installment", _c("monthly_installment") <= 0),
        Rule("missing_created_at", _c("created_at").isNull()),
    ]


# --- Fixed values of the data contract (JSON Schema document) --------------
CONTRACT_PATTERNS = (
    ("financing_id", "^FIN-[0-9]{10}$"),
    ("customer_id", "^CUS-[A-Z0-9]{8}$"),
    ("state", "^[A-Z]{2}$"),
)
CONTRACT_ENUMS = (
    ("vehicle_type", schemas.VEHICLE_TYPES),
    ("segment", schemas.SEGMENTS),
    ("region", schemas.REGIONS),
    ("status", schemas.STATUSES),
    ("currency", schemas.CURRENCIES),
)
# (column, minimum, maximum, minimum is exclusive)
CONTRACT_RANGES = (
    ("vehicle_year", 2000, 2100, False),
    ("financed_amount", 0, None, True),
    ("down_payment", 0, None, False),
    ("installment_count", 1, 120, False),
    ("monthly_installment", 0, None, True),
    ("interest_rate_monthly", 0, 100, False),
)
CONTRACT_CENTS = ("financed_amount", "down_payment", "monthly_installment")
CONTRACT_MIN_LENGTH = (("vehicle_brand", 2), ("vehicle_model", 1), ("city", 2))
# --- end of fixed values -----------------------------------------------------


# RFC 3339 date-time, as required by the contract's ``format: date-time``.
CONTRACT_DATETIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"


def raw_contract_violations(value: Column) -> Column:
    """Contract rules only the raw JSON text can answer, in this order:
    ``parse:json`` (not a JSON object), ``additional:<key>`` for each key the
    contract does not declare (document order), ``format:created_at``.
    """
    keys = F.json_object_keys(value)
    extra = F.transform(
        F.filter(keys, lambda k: ~k.isin(*schemas.FINANCING_COLUMNS)),
        lambda k: F.concat(F.lit("additional:"), k),
    )
    created = F.get_json_object(value, "$.created_at")
    head = F.array(F.when(keys.isNull(), F.lit("parse:json")))
    tail = F.array(F.when(created.isNotNull() & ~created.rlike(whole(CONTRACT_DATETIME)),
                          F.lit("format:created_at")))
    return F.filter(F.concat(head, F.coalesce(extra, F.array().cast("array<string>")), tail),
                    lambda x: x.isNotNull())


def contract_rules() -> list[Rule]:
    """The 39 row rules of the contract: required, pattern, enum, range, cents, length.

    A null value violates only its ``required`` rule.
    """
    rules = [Rule(f"required:{c}", _c(c).isNull()) for c in schemas.FINANCING_COLUMNS]
    rules += [Rule(f"pattern:{c}", ~_c(c).rlike(whole(p))) for c, p in CONTRACT_PATTERNS]
    rules += [Rule(f"enum:{c}", ~_c(c).isin(*values)) for c, values in CONTRACT_ENUMS]
    for c, low, high, exclusive in CONTRACT_RANGES:
        below = _c(c) <= low if exclusive else _c(c) < low
        cond = below if high is None else (below | (_c(c) > high))
        rules.append(Rule(f"range:{c}", cond))
    rules += [Rule(f"cents:{c}", F.round(_c(c), 2) != _c(c)) for c in CONTRACT_CENTS]
    rules += [Rule(f"length:{c}", F.length(_c(c)) < n) for c, n in CONTRACT_MIN_LENGTH]
    return rules


def contract_document() -> dict:
    """The fixed values above as the JSON Schema document that they come from; a
    changed document is read by :mod:`stratum.functions.contract`."""
    names = {"string": "string", "int": "integer", "double": "number", "timestamp": "string"}
    properties: dict[str, dict] = {f.name: {"type": names[f.dataType.simpleString()]} for f in schemas.FINANCING.fields}
    properties["created_at"]["format"] = "date-time"
    for c, pattern in CONTRACT_PATTERNS:
        properties[c]["pattern"] = pattern
    for c, values in CONTRACT_ENUMS:
        properties[c]["enum"] = list(values)
    for c, low, high, exclusive in CONTRACT_RANGES:
        properties[c]["exclusiveMinimum" if exclusive else "minimum"] = low
        if high is not None:
            properties[c]["maximum"] = high
    for c in CONTRACT_CENTS:
        properties[c]["multipleOf"] = 0.01
    for c, n in CONTRACT_MIN_LENGTH:
        properties[c]["minLength"] = n
    return {"type": "object", "additionalProperties": False, "required": list(schemas.FINANCING_COLUMNS), "properties": properties}
