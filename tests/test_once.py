from glob import glob
from types import SimpleNamespace

import pytest

from hackstand import catalog
from hackstand.session import scratch_root


@pytest.mark.parametrize("name", ["sink_incremental", "export_drift", "sink_partitioned"])
def test_mart_is_evaluated_once(spark, name):
    """What is written in two steps comes from one stored copy of the mart."""
    demand = spark.range(8).selectExpr("'green' as service_id", "cast(1996 + id as int) as year", "1 as month", "id as viajes")
    before = set(glob(f"{scratch_root(spark)}/demand-*"))
    assert catalog.load()[name].build(SimpleNamespace(spark=spark, demand=demand)).count() == (1 if name == "export_drift" else 8)
    assert len(set(glob(f"{scratch_root(spark)}/demand-*")) - before) == 1
