"""Every core query with SQL gives the same rows as its SQL."""

import pytest
from oracle import compare

from cohortloom.plans import registry

ORACLES = registry.oracles()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, name):
    assert compare(spark, registry.queries()[name], ORACLES[name], sf_dir) == ""


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert registry.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark, monkeypatch):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
