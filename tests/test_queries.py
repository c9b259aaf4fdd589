"""Registered queries against their SQL twins on the smallest tables."""

import pytest

from rolefit.plans.catalog import QUERIES
from rolefit.plans.oracle import ORACLE, stop_words
from rolefit.operators import lexical
from tools.check import compare, connect

# Approximate results have no twin; tests/test_ann.py measures them against exact retrieval.
WITHOUT_TWIN = {"ann_knn", "ann_recall"}
# Keys that a filter loses are rarer than the rows of the smallest tables.
MAY_BE_EMPTY = {"bloom_false_positives"}


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, db, sf_dir, name):
    difference, rows, _, _ = compare(spark, db, sf_dir, name)
    assert not difference and (rows > 0 or name in MAY_BE_EMPTY)


def test_every_twin_belongs_to_a_query():
    assert set(ORACLE) == set(QUERIES) - WITHOUT_TWIN


def test_both_sides_use_the_same_stop_words(spark):
    assert stop_words() == lexical.stop_words()
