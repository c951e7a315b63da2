import pytest

import __spark_entry__ as entry
from seqmill.plans.queries import ORACLE_SQL, QUERIES
from tests.oracle import same


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, sf_dir, name):
    same(spark, sf_dir, QUERIES[name], ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).limit(1).count() == 1


def test_rows_that_say_something(spark):
    """Queries whose rows depend on thresholds have many different ones."""
    for name in ("chimera_consensus", "filter_reads", "closed_ref", "closed_ref_closure", "numts", "transition_matrix", "greedy_clusters", "preclosed_small", "predenovo_small", "merge_pairs"):
        assert QUERIES[name](spark, "/root/testdata/sf0.01").distinct().count() > 20, name


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
