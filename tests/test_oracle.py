"""Every registered query beside its SQL, at the smallest scale."""

import pytest

from tabwright.checks import queries
from tabwright.checks.compare import connect, difference
from tabwright.checks.oracle import ORACLE
from tabwright.checks.queries import QUERIES
from tabwright.plans import training


@pytest.fixture(autouse=True)
def few_trees(monkeypatch):
    """Smaller trees and fewer trials than the registered queries run with; what is compared is the same."""
    monkeypatch.setattr(queries, "TREES", 3)
    monkeypatch.setattr(queries, "TRIALS", 2)
    for parameters in (training.SEED_PARAMETERS, training.CHALLENGER_PARAMETERS):
        monkeypatch.setitem(parameters, "max_depth", 3)


@pytest.fixture(scope="module")
def connection(tiny):
    return connect(tiny)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(name, spark, connection, tiny):
    assert difference(name, spark, connection, tiny) is None
