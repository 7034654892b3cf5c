"""Every registered query against its SQL counterpart, at the smallest scale."""

import pytest

from __spark_entry__ import entry
from covercast.catalog import ITERATIVE, queries
from covercast.oracle import oracle_sql
from compare import connect, difference, type_differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    relation = duck.sql(oracle_sql()[name])
    assert difference(df.toPandas(), relation.df()) is None
    assert type_differences(df, relation) == []


def test_every_query_but_the_iterative_ones_has_sql():
    assert set(queries()) == set(oracle_sql()) | set(ITERATIVE)


def test_model_scores_cover_every_coming_slot(spark):
    scored = queries()["model_scores"](spark, SF_DIR)
    coming = queries()["upcoming_slot"](spark, SF_DIR)
    assert scored.count() == coming.count() > 0
    assert scored.filter("hot_probability between 0 and 1").count() == scored.count()


def test_flagship_gives_both_labels(spark):
    rows = entry(spark).select("is_hot").distinct().collect()
    assert {r.is_hot for r in rows} == {0, 1}
