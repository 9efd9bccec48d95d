"""Every query of the library against its SQL, and the entry points."""

from __future__ import annotations

import pytest
from compare import SMALL, TINY, same_as_sql

from tidemark.plans import registry


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_its_sql(spark, name):
    assert same_as_sql(spark, registry.queries()[name], registry.oracle_sql()[name], TINY) > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns
    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_flagship_at_the_larger_scale(spark):
    assert same_as_sql(spark, registry.queries()["rank_topk"], registry.oracle_sql()["rank_topk"], SMALL) > 0


def test_weights_must_total_one():
    from tidemark.functions.scalar import composite

    with pytest.raises(ValueError, match="total 1"):
        composite({"hook": "0.5", "emotion": "0.4"})
