"""The entry module: queries, their SQL, and that both agree on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
#: One query of each kind; the driver compares all of them.
CHECKED = ["level_fee_commission", "elite_level", "team_bonus", "integrity_report", "cdc_latest_state"]


def rows(values):
    return sorted([tuple(str(v) for v in r) for r in values])


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = entry.queries()[name](spark, DATA)
    found = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.select(names).collect()) == rows(found.fetchall())


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["user_id", "level", "commission", "n_orders"]
