"""Data contracts as documents: a JSON Schema of flat records becomes rules.

The document is the input: another limit, key or enum in it gives other rules, another
declared schema and other raw-text checks. The vocabulary is what flat records need
(see ``KEYWORDS``); a keyword beyond it raises, as a rule that is skipped in silence
would accept what the document forbids.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from decimal import Decimal
from typing import Any, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

from stratum.functions.rules import CONTRACT_DATETIME, Rule, all_violations, whole

TYPES = {"string": StringType(), "integer": LongType(), "number": DoubleType(), "boolean": BooleanType()}
#: Keywords of a property that become rules, and those that say nothing about values.
KEYWORDS = {"type", "pattern", "enum", "minimum", "exclusiveMinimum", "maximum", "exclusiveMaximum", "multipleOf",
            "minLength", "maxLength", "format"}
NOTES = {"description", "title", "examples", "default", "$comment"}


@dataclass(frozen=True)
class Contract:
    """A document whose keywords are known."""

    properties: Mapping[str, Mapping[str, Any]]
    required: tuple[str, ...]
    closed: bool  # no other keys

    @classmethod
    def of(cls, document: Mapping[str, Any]) -> Contract:
        if document.get("type") != "object":
            raise ValueError("a contract describes an object")
        properties = document.get("properties", {})
        for name, spec in properties.items():
            if unknown := set(spec) - KEYWORDS - NOTES:
                raise ValueError(f"{name}: keywords {sorted(unknown)} have no rule")
            if spec.get("type") not in TYPES:
                raise ValueError(f"{name}: type {spec.get('type')!r} is none of {sorted(TYPES)}")
            if spec.get("format", "date-time") != "date-time":
                raise ValueError(f"{name}: format {spec['format']!r} has no rule")
        required = tuple(document.get("required", ()))
        if undeclared := set(required) - set(properties):
            raise ValueError(f"required but not declared: {sorted(undeclared)}")
        return cls(properties, required, document.get("additionalProperties") is False)

    def _with(self, *keywords: str):
        return [(c, s) for c, s in self.properties.items() if any(k in s for k in keywords)]

    def schema(self) -> StructType:
        """Declared columns for a typed read of the records."""
        def kind(spec: Mapping[str, Any]) -> DataType:
            return TimestampType() if spec.get("format") == "date-time" else TYPES[spec["type"]]

        return StructType([StructField(c, kind(s)) for c, s in self.properties.items()])

    def rules(self) -> list[Rule]:
        """Row rules: required, pattern, enum, range, step, length, in the document's
        order each. A null value violates only its ``required`` rule."""
        out = [Rule(f"required:{c}", F.col(c).isNull()) for c in self.required]
        out += [Rule(f"pattern:{c}", ~F.col(c).rlike(whole(s["pattern"]))) for c, s in self._with("pattern")]
        out += [Rule(f"enum:{c}", ~F.col(c).isin(*s["enum"])) for c, s in self._with("enum")]
        for c, s in self._with("minimum", "exclusiveMinimum", "maximum", "exclusiveMaximum"):
            out.append(Rule(f"range:{c}", _outside(F.col(c), s)))
        out += [Rule(f"{_step_name(s['multipleOf'])}:{c}", _off_step(F.col(c), s["multipleOf"])) for c, s in self._with("multipleOf")]
        for c, s in self._with("minLength", "maxLength"):
            out.append(Rule(f"length:{c}", _any([F.length(c) < s[k] if k == "minLength" else F.length(c) > s[k]
                                                 for k in ("minLength", "maxLength") if k in s])))
        return out

    def raw_violations(self, value: Column) -> Column:
        """What only a record's text can answer: ``parse:json`` (no JSON object),
        ``additional:<key>`` for keys that a closed contract doesn't declare,
        ``format:<key>`` for texts that are no RFC 3339 date-time."""
        keys = F.json_object_keys(value)
        found = [F.array(F.when(keys.isNull(), F.lit("parse:json")))]
        if self.closed:
            extra = F.filter(keys, lambda k: ~k.isin(*self.properties))
            found.append(F.coalesce(F.transform(extra, lambda k: F.concat(F.lit("additional:"), k)), F.array().cast("array<string>")))
        for c, _ in self._with("format"):
            text = F.get_json_object(value, f"$['{c}']")
            found.append(F.array(F.when(text.isNotNull() & ~text.rlike(whole(CONTRACT_DATETIME)), F.lit(f"format:{c}"))))
        return F.filter(F.concat(*found), lambda x: x.isNotNull())

    def check(self, df: DataFrame) -> DataFrame:
        """``violations`` (array), ``violation_text`` and ``violation_count`` of every row."""
        return df.withColumn("violations", all_violations(self.rules())).withColumns(
            {"violation_text": F.array_join("violations", ","), "violation_count": F.size("violations")}
        )


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _outside(value: Column, spec: Mapping[str, Any]) -> Column:
    tests = {"minimum": value.__lt__, "exclusiveMinimum": value.__le__, "maximum": value.__gt__, "exclusiveMaximum": value.__ge__}
    return _any([test(spec[k]) for k, test in tests.items() if k in spec])


def _decimals(step: float | int) -> int | None:
    """s if the step is 10^-s."""
    d = Decimal(str(step)).normalize()
    return -int(d.as_tuple().exponent) if d.as_tuple().digits == (1,) and d <= 1 else None


def _step_name(step: float | int) -> str:
    return "cents" if _decimals(step) == 2 else "step"


def _off_step(value: Column, step: float | int) -> Column:
    """Whether a value is no multiple: decimal steps by rounding, whole ones by remainder."""
    places = _decimals(step)
    if places is not None:
        return F.round(value, places) != value
    if step != int(step) or step <= 0:
        raise ValueError(f"multipleOf {step} is neither a power of ten nor a whole number")
    return value % int(step) != 0


def read_contract(spark: SparkSession, path: str) -> Contract:
    """The contract in the JSON document at ``path`` (any URI)."""
    return Contract.of(json.loads(spark.read.text(path, wholetext=True).first()[0]))
