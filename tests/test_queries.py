"""Every registered query against its plain SQL on the smallest data."""

import decimal
import os

import pytest

from tagloom.plans import REGISTRY, run
from tagloom.plans.inputs import BASE, INPUTS, Inputs, with_inputs

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")

# queries with a join or state that splits hot keys
SALTED = [
    "last_active_bets", "last_active_deposits", "last_active_bet_time", "last_active_cash", "advance_active_days",
    "bet_analysis", "bet_analysis_by_lobby", "game_dict", "offer_info", "offer_applicant", "vip_level", "vip_login",
    "login_location", "promotion_types", "ga_user_id_decode", "lifecycle_day", "tag_deposit_method", "tag_good_customer",
    "tag_good_customer_v1", "tag_custom_upload", "ods_to_dw",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f") if value else "0"
    return value


def table(arrow):
    names = sorted(arrow.column_names)
    types = [str(arrow.schema.field(n).type).replace("large_", "") for n in names]
    return names, types, sorted(repr([plain(r[n]) for n in names]) for r in arrow.to_pylist())


def check(df, duck, sql):
    got, expected = table(df.toArrow()), table(duck.sql(sql).to_arrow_table())
    assert got[0] == expected[0]
    assert got[1] == expected[1]
    assert got[2] == expected[2]
    return got[2]


@pytest.mark.parametrize("name", sorted(INPUTS))
def test_inputs_agree(spark, duck, name):
    check(Inputs(spark, FOLDER)[name], duck, with_inputs(f"SELECT * FROM {name}", "TIMESTAMP"))


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    check(run(name)(spark, FOLDER), duck, REGISTRY[name].sql)


@pytest.mark.parametrize("name", SALTED)
def test_query_with_salted_plans(skewed, duck, name):
    check(run(name)(skewed, FOLDER), duck, REGISTRY[name].sql)


def test_every_query_has_sql():
    assert [n for n, q in REGISTRY.items() if q.sql is None] == []
