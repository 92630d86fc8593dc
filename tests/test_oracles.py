"""Every registered query against its SQL oracle (DuckDB) at sf0.01."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, duck
from conftest import SF01
from plan_report import plan_text, summarize

from lakemart.plans.oracles import ORACLES
from lakemart.plans.queries import QUERIES as OWN

QUERIES = {name: fn for name, fn in entry.queries().items() if name in OWN}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only = {"label_classifier", "label_ranking"}
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == rows_only


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF01)
    plan = summarize(plan_text(df))
    assert not plan["forbidden"], plan          # no cartesian / nested-loop join, no Python evaluation
    r = compare(spark, con, SF01, name, lambda *_: df, ORACLES.get(name))
    assert r["status"] in ("ok", "rows-only"), r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["title", "rating_sum", "average_rating"]
    assert len(df.collect()) > 0
