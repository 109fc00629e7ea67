"""The driver contract's static shape (no Spark job needed)."""

import bench
import __spark_entry__ as E
from stratum.plans import catalog, oracle


def test_bench_headline_queries_are_registered():
    assert set(bench.HEADLINE) <= set(E.queries())
    assert len(bench.HEADLINE) == len(set(bench.HEADLINE))


def test_every_query_has_a_sql_twin_and_names_are_plain():
    q, sql = catalog.queries(), oracle.oracle_sql()
    assert set(q) == set(sql)
    assert set(q) <= set(E.queries()) and set(sql) <= set(E.oracle_sql()) <= set(E.queries())
    for name in q:
        assert name.isidentifier() and name == name.lower()
        assert "pipeline" not in name and not name.startswith("op")
