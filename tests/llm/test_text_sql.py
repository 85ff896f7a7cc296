"""Queries of this package with an SQL form agree with it on whole tables, and run where their texts say."""

from __future__ import annotations

import re

import agreement
import pytest
from conftest import SMALL

from ebbtide.llm import oracle, queries

NATIVE = ("op3_personal_data", "op4_chat_formatting", "op9_url_reputation", "op10_source_mix")


@pytest.fixture(scope="module")
def connection():
    return agreement.connect(SMALL)


@pytest.mark.parametrize("name", list(oracle.all_sql()))
def test_query_agrees_with_sql(spark, connection, name):
    df = queries.all_queries()[name](spark, SMALL)
    relation = connection.sql(oracle.all_sql()[name])
    names = df.columns
    assert sorted(relation.columns) == sorted(names)
    key = lambda r: tuple((v is None, v) for v in r)
    got = sorted((tuple(r) for r in df.collect()), key=key)
    want = sorted(relation.project(", ".join(names)).fetchall(), key=key)
    assert got == want


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = queries.all_queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"EvalPython|InPandas|InArrow|CartesianProduct|NestedLoop", plan)


def test_all_operators_and_the_pipeline_are_registered():
    import __spark_entry__ as driver

    names = driver.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in names
