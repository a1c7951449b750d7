import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, norm

SF = "/root/testdata/sf0.001"
SAMPLE = ("mart_demand_volume", "mart_supply_demand_balance", "mart_abc_xyz_zones", "mart_tipping_behavior", "clean_split",
          "dq_report", "audit_export", "merge_batch_realtime", "fraud_summary")


def test_every_check_belongs_to_a_query():
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and len(names) > 190


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    result = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert [names[i] for i in order] == columns
    assert got == sorted(tuple(norm(r[i]) for i in order) for r in result.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ("read_clusters", "stream_cluster"))
def test_clusters_of_rides_equal_sql(spark, name):
    test_query_equals_sql(spark, name)
