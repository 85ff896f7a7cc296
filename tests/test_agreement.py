"""Every query with an SQL form agrees with it, on whole tables."""

from __future__ import annotations

import agreement
import pytest
from conftest import SMALL

from ebbtide.plans.oracle import all_sql
from ebbtide.plans.queries import all_queries


@pytest.fixture(scope="module")
def connection():
    return agreement.connect(SMALL)


@pytest.mark.parametrize("name", list(all_sql()))
def test_query_agrees_with_sql(spark, connection, name):
    assert agreement.differences(spark, connection, name, SMALL) == []


def test_only_fitted_models_lack_sql():
    without = set(all_queries()) - set(all_sql())
    assert without == {
        "gbt_scores", "gbt_importance", "gbt_rounds", "gbt_rolling_eval", "level_wise_scores", "level_wise_importance",
        "linear_calibrated_scores", "linear_importance", "sketched_quantiles",
    }
    assert set(all_sql()) <= set(all_queries())


def test_entry_is_the_flagship(spark):
    import __spark_entry__ as driver

    df = driver.entry(spark)
    assert df.count() == 150
    assert len(df.columns) == 54
    assert set(driver.oracle_sql()) <= set(driver.queries())
