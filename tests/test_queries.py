"""Every registered query against its SQL twin, over all rows."""

from __future__ import annotations

import pytest

import __spark_entry__
from clickloom import oracle, registry
from tests.compare import differences


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_twin(spark, samples_folder, name):
    assert differences(spark, samples_folder, name) == []


def test_every_query_has_a_twin():
    assert set(registry.QUERIES) == set(oracle.ORACLE)
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())
    assert set(oracle.ORACLE) <= set(__spark_entry__.oracle_sql())


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() == 24
