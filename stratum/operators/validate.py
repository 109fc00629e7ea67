"""Classify, split and profile rows against an ordered rule set."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions import normalize
from stratum.functions.rules import (
    Rule,
    all_violations,
    raw_contract_violations,
    first_violation,
    silver_rules,
    transaction_rules,
)

REASON = "validation_reason"


def classify(df: DataFrame, rules: Sequence[Rule], *, strict: bool = False,
             reason: str = REASON) -> DataFrame:
    """Add the first violated rule code (``NULL`` = valid)."""
    return df.withColumn(reason, first_violation(rules, strict))


def split(df: DataFrame, rules: Sequence[Rule], *, strict: bool = False,
          reason: str = REASON) -> tuple[DataFrame, DataFrame]:
    """``(valid, invalid)``: both branches share one classified plan.

    Writers that need both should write the classified frame once (see
    :func:`stratum.sinks.files.write_split`) so the source is scanned once.
    """
    classified = classify(df, rules, strict=strict, reason=reason)
    valid = classified.filter(F.col(reason).isNull()).drop(reason)
    invalid = classified.filter(F.col(reason).isNotNull())
    return valid, invalid


def validate_transactions(events: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """The transaction validator: no normalisation, six rules, first hit wins."""
    return split(events, transaction_rules(), strict=strict)


def to_silver(bronze: DataFrame, *, strict: bool = False,
              with_rejects: bool = False):
    """Normalise, apply the silver rules, drop provenance.

    Returns the silver rows, or ``(silver, rejects)`` with ``with_rejects``.
    """
    cleaned = normalize.clean(bronze)
    drop = [c for c in ("source_file", "ingestion_time", "_corrupt_record") if c in cleaned.columns]
    valid, invalid = split(cleaned, silver_rules(), strict=strict)
    if drop:
        valid = valid.drop(*drop)
    return (valid, invalid) if with_rejects else valid


def reason_profile(invalid: DataFrame, reason: str = REASON) -> DataFrame:
    """``(validation_reason, row_count)`` - one partial/final hash aggregate."""
    return invalid.groupBy(reason).agg(F.count(F.lit(1)).alias("row_count"))


def reason_profiles(df: DataFrame, rule_sets: dict[str, tuple[Sequence[Rule], bool]],
                    *, strict: bool = False) -> DataFrame:
    """Rejection profile of several rule sets in one pass over ``df``.

    ``rule_sets`` maps a name to ``(rules, normalise_first)``. Sets on raw
    values are evaluated first, then the dimensions are normalised in place
    and the remaining sets evaluated; Catalyst collapses the steps into one
    projection over one scan. ``inline`` turns each row's reasons into
    ``(rule_set, validation_reason)`` pairs and one partial/final aggregate
    counts them.
    """
    ordered = sorted(rule_sets.items(), key=lambda item: item[1][1])  # raw sets first
    tagged, cleaned = df, False
    for name, (rules, normalise_first) in ordered:
        if normalise_first and not cleaned:
            tagged, cleaned = normalize.clean(tagged), True
        tagged = tagged.withColumn(f"__reason_{name}", first_violation(rules, strict))
    pairs = tagged.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("rule_set"), F.col(f"__reason_{name}").alias(REASON))
        for name in rule_sets
    ])))
    return (
        pairs.filter(F.col(REASON).isNotNull())
        .groupBy("rule_set", REASON).agg(F.count(F.lit(1)).alias("row_count"))
    )


def contract_check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Every violated contract rule per row: array, joined text and count."""
    # each rule is evaluated once; text and count come from the array
    return df.withColumn("violations", all_violations(rules)).withColumns(
        {"violation_text": F.array_join("violations", ","), "violation_count": F.size("violations")}
    )


def raw_contract_check(lines: DataFrame, value: str = "value") -> DataFrame:
    """Raw JSON-lines text -> the contract checks a typed read cannot make.

    Adds ``raw_violations`` (array) and ``raw_violation_text``; blank lines
    are skipped like the JSON reader skips them.
    """
    v = F.col(value)
    return lines.filter(F.trim(v) != "").withColumns({
        "raw_violations": raw_contract_violations(v),
    }).withColumn("raw_violation_text", F.array_join("raw_violations", ","))
