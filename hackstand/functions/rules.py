"""Business rules on single trips."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.functions.numeric import half_up
from hackstand.settings import GenerositySettings


def passenger_group(count: Column) -> Column:
    return (
        F.when(count == 1, "Solo")
        .when(count == 2, "Pareja")
        .when(count.between(3, 4), "Grupo pequeño")
        .when(count >= 5, "Grupo grande")
        .otherwise("Desconocido")
    )


def categoria_generosidad(percent: Column, settings: GenerositySettings) -> Column:
    """NULL in, NULL out: an unrecorded tip is not a missing tip."""
    return (
        F.when(percent <= 0, "Sin Propina")
        .when(percent < settings.low, "Baja")
        .when(percent <= settings.high, "Estándar")
        .when(percent > settings.high, "Alta")
    )


def is_taxi(service: Column) -> Column:
    return service.isin(*fv.TAXI_SERVICES)


def revenue(service: Column, total_amount: Column, base_fare: Column) -> Column:
    return F.when(is_taxi(service), total_amount).when(service == "fhvhv", base_fare)


def desviacion_tarifa(fare: Column, flat_fare: Column) -> Column:
    return F.abs(fare - flat_fare)


def speed_mph(distance: Column, seconds: Column) -> Column:
    return F.when(
        (seconds > 0) & (distance > 0),
        half_up(distance / (seconds.cast("double") / F.lit(3600.0)), 2),
    )


def cost_per_mile(fare: Column, distance: Column) -> Column:
    return half_up(fare / (distance + F.lit(0.001)), 4)


def toll_ratio(tolls: Column, fare: Column) -> Column:
    return F.when(fare > 0, half_up(tolls / fare, 4))


def is_anomaly_candidate(
    ratecode: Column, fare: Column, flat_fare: Column, mph: Column, cost: Column
) -> Column:
    """Flat fare missed, impossible speed, costly mile, or no fare; SQL three-valued."""
    missed_flat_fare = (
        (ratecode == fv.FLAT_FARE_RATECODE)
        & flat_fare.isNotNull()
        & (desviacion_tarifa(fare, flat_fare) > fv.FLAT_FARE_TOLERANCE)
    )
    too_fast = mph.isNotNull() & (mph > fv.MAX_PLAUSIBLE_MPH)
    costly_mile = (
        (ratecode == fv.STANDARD_RATECODE)
        & mph.isNotNull()
        & (mph > 0)
        & (mph <= fv.MAX_PLAUSIBLE_MPH)
        & (cost > fv.MAX_COST_PER_MILE)
    )
    return missed_flat_fare | too_fast | costly_mile | (fare <= 0)


def tip_is_recorded(service: Column, payment: Column, fare: Column) -> Column:
    """Taxis record tips on card trips only; a percentage also needs a positive fare."""
    return F.when(is_taxi(service), (payment == 1) & (fare > 0)).otherwise(fare > 0)


def fs_safe(value: Column) -> Column:
    return F.regexp_replace(value, r'[<>:"/\\|?*]', "_")


def trip_id(*keys: Column) -> Column:
    """Surrogate key: 64-bit hash of the key values joined by ``||``, NULL as empty text."""
    if not keys:
        return F.lit(None).cast("long")
    texts = [F.coalesce(key.cast("string"), F.lit("")) for key in keys]
    return F.xxhash64(F.concat_ws("||", *texts))
