"""Every registered query against DuckDB, on the smallest tables."""

import oracle
import pytest

from stratalake.oracles import ORACLES
from stratalake.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLES)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, duck, name):
    assert oracle.differences(REGISTRY[name](spark, SF_DIR), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", ["fct_sales_by_product", "revenue_nulls_first", "dim_date", "dim_weather"])
def test_row_order(spark, duck, name):
    sql = ORACLES[name] if "ORDER BY" in ORACLES[name] else f"{ORACLES[name]} ORDER BY date"
    expected = duck.execute(sql).fetchall()
    assert [r[1] for r in REGISTRY[name](spark, SF_DIR).collect()] == [r[1] for r in expected]
