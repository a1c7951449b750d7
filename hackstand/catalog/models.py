"""Queries: feature stores, clustering, anomaly scores, forecasts."""

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.catalog import ride_sql  # noqa: F401  (defines the rides expressions)
from hackstand.catalog.registry import query
from hackstand.catalog.sections import long_form, section_sql
from hackstand.catalog.sql import TAXI, compose, define, half, part_sql, passengers_sql, pct, time, values_sql, xavg, xsum
from hackstand.catalog.trips import CANDIDATE_SQL, COST_SQL, SPEED_SQL, TOLL_SQL
from hackstand.operators.quantiles import exact_quantiles, impute_median
from hackstand.plans import forecast, forest, kmodes
from hackstand.session import materialise
from hackstand.settings import DEFAULTS

# ---- feature stores ----

define("fraud_feat", f"""
select trip_id, service_id, ratecode_id, cast(epoch(dropoff_datetime) - epoch(pickup_datetime) as bigint) as duracion_viaje_segundos,
  trip_distance, fare_amount, extra, mta_tax, {SPEED_SQL} as velocidad_promedio_calculada, {COST_SQL} as costo_por_distancia,
  {TOLL_SQL} as ratio_peaje_tarifa, {CANDIDATE_SQL} as is_anomaly_candidate, year, month
from facts where {TAXI}
""")
_HOUR = "hour(pickup_datetime)"
define("kfeat", f"""
select trip_id, service_id, p.borough as borough_pu, d.borough as borough_do, {part_sql(_HOUR)} as franja_horaria,
  case when isodow(pickup_datetime) >= 6 then 'Fin de Semana' else 'Día Laborable' end as dia_categoria, hvfhs_license_num,
  (select name from (values {values_sql(fv.PAYMENT_NAMES)}) v(id, name) where id = payment_type_id) as payment_type,
  (select name from (values {values_sql(fv.RATECODE_NAMES)}) v(id, name) where id = ratecode_id) as ratecode,
  case when service_id <> 'fhvhv' then {passengers_sql('passenger_count')} end as passenger_group, year, month
from facts left join zones p on p.location_id = pickup_location_id left join zones d on d.location_id = dropoff_location_id
where service_id <> 'fhv'
""")
query("feat_isolation_fraud", compose("select * from fraud_feat"))(lambda t: t.fraud_features)
query("feat_kmodes_trips", compose("select * from kfeat"))(lambda t: t.cluster_features)

# ---- K-Modes ----

SERVICE = "yellow"
_F = list(kmodes.features_of(SERVICE))
_COLS = ", ".join(_F)


def _gap(left: str, right: str) -> str:
    return "(" + " + ".join(f"(case when {left}.{f} = {right}.{f} then 0 else 1 end)" for f in _F) + ")"


define("combos", f"select {_COLS}, count(*) as w from kfeat where service_id = '{SERVICE}' and "
       + " and ".join(f"{f} is not null" for f in _F) + " group by all")
define("dense", "select *, " + " + ".join(f"sum(w) over (partition by {f})" for f in _F) + " as density from combos")
define("seed0", f"select {_COLS} from dense order by density desc, {_COLS} limit 1")
define("seed1", f"select {', '.join('d.' + f for f in _F)} from dense d join seed0 a on true order by {_gap('d', 'a')}*density desc, {', '.join('d.' + f for f in _F)} limit 1")
define("seed2", f"select {', '.join('d.' + f for f in _F)} from dense d join seed0 a on true join seed1 b on true "
       f"order by least({_gap('d', 'a')}, {_gap('d', 'b')})*density desc, {', '.join('d.' + f for f in _F)} limit 1")
define("gaps", f"select c.*, {_gap('c', 'a')} as g0, {_gap('c', 'b')} as g1, {_gap('c', 's')} as g2 "
       "from combos c join seed0 a on true join seed1 b on true join seed2 s on true")
define("labelled", "select *, case when g0 <= g1 and g0 <= g2 then 0 when g1 <= g2 then 1 else 2 end as cluster_id from gaps")
define("trip_labels", f"select k.*, l.cluster_id from kfeat k join labelled l using ({_COLS}) where service_id = '{SERVICE}'")


def _seeded(store):
    combos = materialise(kmodes.combinations(store, SERVICE), "combos")
    seeds = kmodes.initial_modes(combos, _F, 3)
    return combos, seeds


def _labelled(t):
    """The service's trips, written once as they are read to seed, to label and to join, and their labels."""
    store = materialise(t.cluster_features.filter(F.col("service_id") == SERVICE), "clusters")
    return store, kmodes.labels(store, SERVICE, _seeded(store)[1])


@query("kmodes_encode", compose("select " + ", ".join(f"count(distinct {f}) as {f}" for f in _F) + ", count(*) as combinaciones, cast(sum(w) as bigint) as viajes from combos"))
def _encode(t):
    return kmodes.combinations(t.cluster_features, SERVICE).agg(
        *[F.count_distinct(f).alias(f) for f in _F], F.count(F.lit(1)).alias("combinaciones"), F.sum("w").alias("viajes"))


@query("kmodes_init", compose(" union all ".join(f"select {i} as pos, {_COLS}, (select count(*) from combos) as combinaciones from seed{i}" for i in range(3))))
def _init(t):
    combos, seeds = _seeded(t.cluster_features)
    n = combos.agg(F.count(F.lit(1)).alias("combinaciones"))
    rows = F.array(*[F.struct(F.lit(i).alias("pos"), *[F.lit(v).alias(f) for f, v in zip(_F, s)]) for i, s in enumerate(seeds)])
    return n.select(F.inline(rows), "combinaciones")


@query("kmodes_labels", compose("select trip_id, cluster_id from trip_labels"))
def _labels(t):
    return _labelled(t)[1].select("trip_id", "cluster_id")


query("kmodes_sizes", compose("select cluster_id, count(*) as count from trip_labels group by 1"))(
    lambda t: kmodes.sizes(_labelled(t)[1]))
query("cluster_counts", compose("select 'Cluster ' || cast(cluster_id as varchar) as name, count(*) as count from trip_labels group by 1"))(
    lambda t: kmodes.counts_per_cluster(_labelled(t)[1]))
_LONG = " union all ".join(f"select cluster_id, '{f}' as feature, {f} as value, w from labelled" for f in _F)
_VALUES = f"(select cluster_id, feature, value, sum(w) as n from ({_LONG}) group by 1,2,3)"
_TOPS = f"(select *, row_number() over (partition by cluster_id, feature order by n desc, value) as rn from {_VALUES})"


@query("kmodes_centers", compose(f"select cluster_id, (select cast(sum(w) as bigint) from labelled l where l.cluster_id = x.cluster_id) as n_rows, "
                                 + ", ".join(f"max(case when feature = '{f}' then value end) as {f}" for f in _F) + f" from {_TOPS} x where rn = 1 group by 1"))
def _centers(t):
    combos, seeds = _seeded(t.cluster_features)
    return kmodes.centers(kmodes.assign(combos, _F, seeds), _F)


@query("kmodes_profiles", compose(f"""
select cluster_id, feature, max(case when rn = 1 then value end) as top_value, {pct('max(n)', 'sum(n)')} as top_pct, count(*) as n_unique
from {_TOPS} group by 1,2
"""))
def _profiles(t):
    combos, seeds = _seeded(t.cluster_features)
    return kmodes.profiles(kmodes.assign(combos, _F, seeds), _F)


_D = ["borough_pu", "franja_horaria", "payment_type"]
_DLONG = " union all ".join(f"select cluster_id, '{f}' as feature, coalesce({f}, 'N/A') as value from trip_labels" for f in _D)


@query("kmodes_distributions", compose(f"""
select cluster_id, feature, value, count(*) as count, {half('cast(count(*) as double)/sum(count(*)) over (partition by cluster_id, feature)*100e0')} as pct
from ({_DLONG}) group by 1,2,3
"""))
def _distributions(t):
    store, labels = _labelled(t)
    return kmodes.distributions(labels, store, _D)


@query("join_labels_features", compose("select trip_id, cluster_id, borough_pu, franja_horaria from trip_labels"))
def _labels_features(t):
    store, labels = _labelled(t)
    return kmodes.with_features(labels, store, ["borough_pu", "franja_horaria"])


@query("kmodes_step", compose(f"""
select cast(sum(w*least(g0, g1, g2)) as bigint) as costo, count(*) as combinaciones from labelled
"""))
def _step(t):
    combos, seeds = _seeded(t.cluster_features)
    gap = F.array_min(F.array(*[kmodes.distance(_F, s) for s in seeds]))
    return combos.agg(F.sum(F.col("w") * gap).alias("costo"), F.count(F.lit(1)).alias("combinaciones"))


_N = "(select cast(sum(w) as double) as n{c} from labelled where cluster_id = {c})"


_COMPLETE = " union all ".join(
    f"select service_id, count(*) as viajes from kfeat where service_id = '{s}' and " + " and ".join(f"{f} is not null" for f in kmodes.features_of(s)) + " group by 1"
    for s in fv.PRICED_SERVICES)


@query("kmodes_fit")
def _fit(t):
    """Sizes of the clusters of the tuned number of clusters, for every service."""
    store, out = materialise(t.cluster_features, "clusters"), []
    for service, tuned in kmodes.train_all(store).items():
        best = kmodes.best_of(tuned)
        out.append(kmodes.sizes(kmodes.labels(store, service, best.fit.modes)).withColumns(
            {"service_id": F.lit(service), "k": F.lit(best.k), "costo": F.lit(best.fit.cost), "rondas": F.lit(best.fit.iterations)}))
    return reduce(DataFrame.unionByName, out)


@query("kmodes_labelled", compose(f"select service_id, viajes, viajes as repartidos, true as k_valido from ({_COMPLETE})"))
def _labelled_all(t):
    """Every complete trip of every service has one cluster of the tuned model."""
    store, out = materialise(t.cluster_features, "clusters"), []
    for service, tuned in kmodes.train_all(store).items():
        best = kmodes.best_of(tuned)
        sizes = kmodes.labels(store, service, best.fit.modes).groupBy("service_id").agg(
            F.count(F.lit(1)).alias("repartidos"), F.min(F.col("cluster_id") < best.k).alias("k_valido"))
        out.append(kmodes.combinations(store, service).agg(F.sum("w").alias("viajes")).withColumn("service_id", F.lit(service)).join(sizes, "service_id"))
    return reduce(DataFrame.unionByName, out)


@query("kmodes_tune")
def _tune(t):
    """Cost and silhouette of every number of clusters from 2 to 8 of every service, and which one is taken."""
    rows = []
    for service, tuned in kmodes.train_all(t.cluster_features).items():
        best = kmodes.best_of(tuned)
        rows += [(service, x.k, x.fit.cost, round(x.silhouette, 6), x is best) for x in tuned]
    return t.spark.createDataFrame(rows, "service_id string, k int, cost long, silhouette double, elegido boolean")


# ---- quantiles and anomaly scores ----

query("exact_quantile", compose("""
select ratecode_id, floor(quantile_cont(costo_por_distancia, 0.95)*1e6+0.5)/1e6 as p95, floor(median(costo_por_distancia)*1e6+0.5)/1e6 as mediana
from fraud_feat group by 1
"""))(lambda t: _two_quantiles(t.fraud_features))


def _two_quantiles(features):
    found = exact_quantiles(features, ["ratecode_id"], "costo_por_distancia", {"p95": 0.95, "mediana": 0.5})
    return found.select("ratecode_id", *[forest.half_up(F.col(c), 6).alias(c) for c in ("p95", "mediana")])


_SIX = {"ratio_peaje_tarifa": "case when ratio_peaje_tarifa > 0 then ratio_peaje_tarifa end"}


@query("impute_median", compose(
    "select trip_id, " + ", ".join(f"coalesce({c}, median({c}) over (partition by ratecode_id), 0)::double as {c}" for c in forest.FEATURES)
    + " from (select trip_id, ratecode_id, " + ", ".join(f"{_SIX.get(c, c)} as {c}" for c in forest.FEATURES) + " from fraud_feat)"))
def _imputed(t):
    """Medians and trips come from one copy of the features."""
    features = t.fraud_features.withColumn("ratio_peaje_tarifa", F.when(F.col("ratio_peaje_tarifa") > 0, F.col("ratio_peaje_tarifa")))
    stored = materialise(features.select("trip_id", "ratecode_id", *forest.FEATURES), "fraud")
    return impute_median(stored, ["ratecode_id"], forest.FEATURES).select("trip_id", *forest.FEATURES)


define("ratio_iso", f"""
select f.*, {half('costo_por_distancia/mid', 6)} as isolation from fraud_feat f
join (select ratecode_id as rc, median(costo_por_distancia) as mid from fraud_feat group by 1) on rc = ratecode_id
where costo_por_distancia is not null
""")
define("scores", """
select trip_id, ratecode_id, service_id, year, month, isolation as anomaly_score, isolation > cut as is_fraud, 'ok' as model_status, is_anomaly_candidate
from ratio_iso join (select ratecode_id as rc2, quantile_cont(isolation, 0.95) as cut from ratio_iso group by 1) on rc2 = ratecode_id
""")
query("fraud_baseline", compose("select * from scores"))(lambda t: forest.ratio_scores(t.fraud_features))


@query("fraud_summary", compose(" union all ".join([
    section_sql("total", [], {"total_scored": "count(*)", "fraud_count": "count(case when is_fraud then 1 end)",
                              "fraud_rate": pct("count(case when is_fraud then 1 end)", "count(*)")}, "scores"),
    section_sql("by_ratecode", ["ratecode_id"], {"total": "count(*)", "fraud": "count(case when is_fraud then 1 end)",
                                                 "fraud_rate": pct("count(case when is_fraud then 1 end)", "count(*)")}, "scores"),
    section_sql("score_stats", [], {"score_min": "min(anomaly_score)", "score_max": "max(anomaly_score)",
                                    "score_mean": half(f"{xsum('anomaly_score', 6)}/count(*)", 6),
                                    "score_std": half("stddev_samp(anomaly_score)", 4)}, "scores"),
    section_sql("leakage", [], {"estimated_leakage": half(f"coalesce({xsum('fare_amount')}, 0)")},
                "scores join fraud_feat using (trip_id) where is_fraud"),
])))
def _fraud_summary(t):
    features = materialise(t.fraud_features, "fraud")
    parts = forest.summary(forest.ratio_scores(features), features)
    return long_form({
        "total": (parts["total"], [], ["total_scored", "fraud_count", "fraud_rate"]),
        "by_ratecode": (parts["by_ratecode"], ["ratecode_id"], ["total", "fraud", "fraud_rate"]),
        "score_stats": (parts["score_stats"], [], ["score_min", "score_max", "score_mean", "score_std"]),
        "leakage": (parts["leakage"], [], ["estimated_leakage"]),
    })


_PF = ", ".join(forest.PAGE_FEATURES)
query("topk_scores", compose("select trip_id, ratecode_id, anomaly_score, is_fraud from scores where ratecode_id = 1 order by anomaly_score desc, trip_id limit 100"))(
    lambda t: forest.page(forest.ratio_scores(t.fraud_features).filter("ratecode_id = 1"), [("anomaly_score", "desc"), ("trip_id", "asc")], 100)
    .select("trip_id", "ratecode_id", "anomaly_score", "is_fraud"))


def _page(t):
    features = materialise(t.fraud_features, "fraud")
    return forest.scores_page(forest.ratio_scores(features), features, 2, 50, 25)


query("fraud_scores_page", compose(f"""
select trip_id, s.ratecode_id, anomaly_score, is_fraud, {_PF} from (
  select * from scores where ratecode_id = 2 order by anomaly_score desc, trip_id limit 50 offset 25) s join fraud_feat f using (trip_id)
"""))(_page)


@query("join_scores_features", compose(f"select trip_id, anomaly_score, is_fraud, {_PF} from scores join fraud_feat using (trip_id)"))
def _scores_features(t):
    features = materialise(t.fraud_features, "fraud")
    return forest.ratio_scores(features).select("trip_id", "anomaly_score", "is_fraud").join(
        features.select("trip_id", *forest.PAGE_FEATURES), "trip_id", "left")


_POINTS = f"""
select trip_id, s.ratecode_id, is_fraud, trip_distance, fare_amount, velocidad_promedio_calculada, costo_por_distancia, anomaly_score, 4.12e0 as legal_fare_per_mile from (
  select *, row_number() over (partition by is_fraud order by substr(md5(cast(trip_id as varchar) || 'scatter'), 1, 8), trip_id) as rn from scores) s
join fraud_feat using (trip_id) where rn <= 500
"""


def _scatter(t):
    features = materialise(t.fraud_features, "fraud")
    return forest.scatter(forest.ratio_scores(features), features)


query("fraud_scatter", compose(_POINTS))(_scatter)
query("sample_series", compose(f"select trip_id, is_fraud, anomaly_score from ({_POINTS.strip()})"))(
    lambda t: _scatter(t).select("trip_id", "is_fraud", "anomaly_score"))
query("fraud_counts", compose(f"""
select count(case when is_fraud then 1 end) as fraudes, count(case when is_anomaly_candidate then 1 end) as candidatos,
  {half(f"{xsum('anomaly_score', 6)}/count(*)", 6)} as score_medio from scores
"""))(lambda t: forest.panel_counts(forest.ratio_scores(t.fraud_features)))
_SIZES = "(select ratecode_id, count(*) as n from fraud_feat where ratecode_id is not null group by 1)"
query("model_registry", compose(f"""
select 'isolation_forest' as pipeline, cast(ratecode_id as varchar) as model, n as n_rows_source, 6 as n_features,
  0.05e0 as contamination, 100 as n_estimators, cast(least(n, 256) as integer) as max_samples, 42 as random_state from {_SIZES} where n >= 200
"""))(lambda t: forest.registry_rows(_trained(t)[0]))


def _trained(t):
    return forest.train(materialise(t.fraud_features, "fraud"))


@query("iforest_fit", compose(f"select ratecode_id, n as viajes, 100 as arboles, cast(least(n, 256) as integer) as muestra, 100 as arboles_completos from {_SIZES} where n >= 200"))
def _forest_fit(t):
    features = materialise(t.fraud_features, "fraud")
    trees = forest.fit(materialise(impute_median(features, ["ratecode_id"], forest.FEATURES), "imputed"))
    # a tree over n rows has an odd number of nodes, and each inner node has two followers
    whole = (F.size(F.filter("feature", lambda x: x >= 0)) * 2 + 1 == F.size("feature")) & (F.size("feature") < 2 * F.col("sampled"))
    grown = trees.groupBy("ratecode_id").agg(F.count_distinct("tree").cast("int").alias("arboles"), F.max("sampled").alias("muestra"), F.count(F.when(whole, 1)).cast("int").alias("arboles_completos"))
    return features.groupBy("ratecode_id").agg(F.count(F.lit(1)).alias("viajes")).join(grown, "ratecode_id")


query("iforest_score")(lambda t: _trained(t)[1])


@query("iforest_status", compose(f"""
select ratecode_id, case when ratecode_id is null then 'skipped_no_ratecode' when n >= 2000 then 'ok' else 'skipped_low_rows' end as model_status, is_anomaly_candidate, count(*) as viajes,
  count(case when n >= 2000 then 1 end) as con_valor, bool_or(case when n >= 2000 then true end) as con_corte
from fraud_feat left join (select ratecode_id as rc, count(*) as n from fraud_feat group by 1) on rc = ratecode_id group by 1, 2, 3
"""))
def _status(t):
    """A status for every trip, of models that ask for 2,000 trips: ratecodes with fewer stay in the table without a score."""
    _, scores = forest.train(materialise(t.fraud_features, "fraud"), replace(DEFAULTS.forest, trees=10, min_rows=2000))
    return scores.groupBy("ratecode_id", "model_status", "is_anomaly_candidate").agg(
        F.count(F.lit(1)).alias("viajes"), F.count("anomaly_score").alias("con_valor"),
        F.max(F.when(F.col("model_status") == forest.OK, F.col("is_fraud").isNotNull())).alias("con_corte"))


# ---- forecasts on the hourly rides ----

HORIZON, MIN_ROWS = 48, 200
define("ride_hours", """
select coalesce(pu_borough, 'Unknown') as borough, service_id, date_trunc('hour', pickup_datetime) as pickup_hour, count(*) as trip_count
from rides group by 1,2,3
""")
define("ride_series", """
select h.borough, h.service_id, h.t as pickup_hour, coalesce(cast(trip_count as double), 0) as trip_count, last_hour
from (select borough, service_id, max(pickup_hour) as last_hour, unnest(generate_series(min(pickup_hour), max(pickup_hour), interval 1 hour)) as t
      from ride_hours group by 1,2) h
left join ride_hours y on y.borough = h.borough and y.service_id = h.service_id and y.pickup_hour = h.t
""")
define("naive", f"""
select borough, service_id, pickup_hour, trip_count, yhat, yhat - 2 as yhat_lower, yhat + 2 as yhat_upper, 'ok' as model_status,
  'actual' as forecast_type, epoch(pickup_hour) > epoch(last_hour) - {HORIZON}*3600 as holdout
from (select *, lag(trip_count, 24) over (partition by borough, service_id order by pickup_hour) as yhat from ride_series)
""")
query("sarimax_exog", compose(f"""
select borough, service_id, {time('pickup_hour')} as pickup_hour, cast(strftime(pickup_hour, '%Y%m%d') in ('20240101','20240115') as double) as is_holiday,
  cast(isodow(pickup_hour) >= 6 as double) as is_weekend, cast(hour(pickup_hour) in (7,8,9,16,17,18,19) as double) as is_rush_hour,
  cast(borough in ('EWR','Queens') as double) as is_airport_borough from ride_hours
"""))(lambda t: t.ride_hours.select("borough", "service_id", "pickup_hour", *[
    c.alias(n) for n, c in forecast_flags().items()]))


def forecast_flags():
    from hackstand.functions.clock import calendar_flags
    return calendar_flags(F.col("pickup_hour"), F.col("borough"))


query("forecast_baseline", compose(f"select * replace ({time('pickup_hour')} as pickup_hour) from naive"))(
    lambda t: forecast.seasonal_naive(t.ride_hours, HORIZON))
query("forecast_eval", compose(f"""
select borough, service_id, count(*) as n, {half(f"{xsum('abs(trip_count - yhat)', 6)}/count(*)", 4)} as mae,
  {half(f"{xsum('abs(trip_count - yhat)/greatest(abs(trip_count), 1e0)', 6)}/count(*)*100e0")} as mape
from naive where holdout and yhat is not null group by 1,2
"""))(lambda t: forecast.evaluate(forecast.seasonal_naive(t.ride_hours, HORIZON)))
query("forecast_query", compose(f"""
select 'All' as borough, 'yellow' as service_id, strftime(pickup_hour, '%Y-%m-%d 00:00:00') as pickup_hour, {xsum('trip_count')} as trip_count,
  {xsum('yhat')} as yhat, min(yhat_lower) as yhat_lower, max(yhat_upper) as yhat_upper, 'ok' as model_status, forecast_type
from naive where service_id = 'yellow' and pickup_hour >= timestamp '2024-01-03' and pickup_hour <= timestamp '2024-01-20 23:59:59' group by 3, forecast_type
"""))(lambda t: forecast.query(forecast.seasonal_naive(t.ride_hours, HORIZON), service_id="yellow", start="2024-01-03",
                               end="2024-01-20", grain="daily"))
query("forecast_summary", compose(f"""
select count(distinct (borough, service_id)) as segmentos, count(*) as total_rows, {time('min(pickup_hour)')} as min_dt, {time('max(pickup_hour)')} as max_dt from naive
"""))(lambda t: forecast.summary(forecast.seasonal_naive(t.ride_hours, HORIZON)))


@query("forecast_segment")
def _segments(t):
    settings = replace(DEFAULTS.forecast, min_rows=MIN_ROWS, horizon_hours=HORIZON)
    return forecast.forecast_segments(t.ride_hours, settings)


@query("forecast_year_end", compose(f"""
select borough, service_id, 'actual' as forecast_type, count(*) as horas, {time('min(pickup_hour)')} as desde, {time('max(pickup_hour)')} as hasta, count(*) as con_viajes,
  count(*) >= {MIN_ROWS} as con_modelo, true as ordenado from ride_series group by 1, 2
union all
select borough, service_id, 'forecast', cast((epoch(timestamp '2024-12-31 23:00:00') - epoch(max(pickup_hour)))/3600 as bigint), {time("max(pickup_hour) + interval 1 hour")},
  '2024-12-31 23:00:00', 0, true, true from ride_series group by 1, 2 having count(*) >= {MIN_ROWS}
"""))
def _year_end(t):
    """The hour grid of the forecast to the year's end, and whether every hour has an interval around its value."""
    done = forecast.forecast_segments(t.ride_hours, replace(DEFAULTS.forecast, min_rows=MIN_ROWS, until_year=2024))
    future = F.col("forecast_type") == "forecast"
    return done.groupBy("borough", "service_id", "forecast_type").agg(
        F.count(F.lit(1)).alias("horas"), F.min("pickup_hour").alias("desde"), F.max("pickup_hour").alias("hasta"), F.count("trip_count").alias("con_viajes"),
        F.max(F.col("model_status") == "ok").alias("con_modelo"),
        F.min(F.when(future, (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))).otherwise(True)).alias("ordenado"))


@query("forecast_skipped", compose(f"""
select borough, service_id, count(*) as horas, 'skipped_low_rows' as model_status from ride_series group by 1,2
"""))
def _skipped(t):
    done = forecast.forecast_segments(t.ride_hours)
    return done.groupBy("borough", "service_id").agg(F.count(F.lit(1)).alias("horas"), F.max("model_status").alias("model_status"))
