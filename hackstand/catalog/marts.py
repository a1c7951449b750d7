"""Queries: marts and the checks on them."""

from pyspark.sql import functions as F

from hackstand.catalog.registry import query
from hackstand.catalog.sql import compose, half
from hackstand.plans import marts
from hackstand.operators import ranking

_D = "strftime(fecha_viaje, '%Y-%m-%d') as fecha_viaje"
_B = ("strftime(bloque_temporal_t, '%Y-%m-%d %H:%M:%S') as bloque_temporal_t, "
      "strftime(bloque_temporal_t_plus_1, '%Y-%m-%d %H:%M:%S') as bloque_temporal_t_plus_1")

query("mart_demand_volume", compose(f"select * replace ({_D}) from demand"))(lambda t: t.demand)
query("mart_financial_performance", compose(f"select * replace ({_D}) from financial"))(lambda t: t.financial)
query("mart_operational_profile", compose(f"select * replace ({_D}) from operational"))(lambda t: t.operational)
query("mart_supply_demand_balance", compose(f"select * replace ({_B}) from balance"))(lambda t: t.balance)
query("join_supply_demand", compose(f"select * replace ({_B}) from balance"))(
    lambda t: marts.supply_demand_join(t.facts, t.zones)
)
query("mart_abc_xyz_zones", compose("select * from abc_xyz"))(lambda t: t.abc_xyz)
query("mart_tipping_behavior", compose(f"select * replace ({_D}) from tipping"))(lambda t: t.tipping)
query("feat_arima_trips", compose(
    "select * replace (strftime(pickup_hour, '%Y-%m-%d %H:%M:%S') as pickup_hour) from hourly"
))(lambda t: t.hourly)
