"""The stored ledger: policies and ablations without the texts."""

import pytest

from frames import docs, workers  # noqa: F401 - fixtures
from stratum.llm import rule_ledger


def test_a_stored_ledger_serves_policies_without_its_texts(spark, docs, tmp_root, monkeypatch):
    texts = ["word " * 60, "few words", None, "", " ".join(f"w{i}" for i in range(80)), "AB CD " * 3 + " ".join(f"X{i}" for i in range(90))]
    book = rule_ledger.ledger(rule_ledger.measure(docs([*enumerate(texts), (None, "x"), (1, "few words")])))
    rule_ledger.write_ledger(book, tmp_root + "/book")
    back = rule_ledger.read_ledger(spark, tmp_root + "/book")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, book.collect()), key=str)
    plan = back._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan
    for policy in rule_ledger.POLICIES.values():
        rows = back.collect()
        want = {}
        for r in rule_ledger.RULES:
            if r.name in policy.rules:
                own = 1 << r.bit
                want[r.name] = (sum(bool(x.fail_bits & own) for x in rows), sum(x.fail_bits & policy.mask == own for x in rows))
        assert {x.rule: (x.n_fail, x.n_only) for x in rule_ledger.ablation(back, policy).collect()} == want
        kept = rule_ledger.apply_policy(back, policy).where("kept").count()
        assert kept == sum(not x.fail_bits & policy.mask for x in rows)
    monkeypatch.setattr(rule_ledger, "RULES", rule_ledger.RULES[:-1])
    with pytest.raises(ValueError, match="other rules"):
        rule_ledger.read_ledger(spark, tmp_root + "/book")


def test_an_empty_ledger(spark, docs, tmp_root):
    rule_ledger.write_ledger(rule_ledger.ledger(rule_ledger.measure(docs([]))), tmp_root + "/none")
    assert rule_ledger.read_ledger(spark, tmp_root + "/none").collect() == []
