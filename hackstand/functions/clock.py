"""Hour blocks, weekdays, calendar flags and time buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hackstand import fixed_values as fv

# Last hour of each block and its label.
OPERATING_BLOCKS = (
    (5, "Madrugada"), (9, "Punta Mañana"), (15, "Mediodía"), (19, "Punta Tarde"), (23, "Noche"),
)
DAY_PARTS = ((5, "Madrugada"), (11, "Mañana"), (18, "Tarde"), (23, "Noche"))


def _band(hour: Column, bands) -> Column:
    low, out = 0, None
    for high, label in bands:
        test = hour.between(low, high)
        out = F.when(test, label) if out is None else out.when(test, label)
        low = high + 1
    return out


def bloque_horario(hour: Column) -> Column:
    return _band(hour, OPERATING_BLOCKS)


def franja_horaria(hour: Column) -> Column:
    return _band(hour, DAY_PARTS)


def iso_weekday(moment: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(moment) + F.lit(1)


def is_weekend(weekday: Column) -> Column:
    return weekday >= 6


def dia_categoria(weekday: Column) -> Column:
    """A NULL weekday counts as a working day."""
    return F.when(weekday >= 6, "Fin de Semana").otherwise("Día Laborable")


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def is_holiday(day: Column) -> Column:
    return date_key(day).isin(*fv.HOLIDAYS)


def is_rush_hour(hour: Column) -> Column:
    return hour.isin(*fv.RUSH_HOURS)


def is_airport_borough(borough: Column) -> Column:
    return borough.isin(*fv.AIRPORT_BOROUGHS)


def block_start(moment: Column, step_seconds: int) -> Column:
    """Epoch second at which the block holding ``moment`` starts."""
    step = F.lit(step_seconds)
    return F.floor(F.unix_timestamp(moment) / step).cast("long") * step


def from_block(second: Column) -> Column:
    return F.timestamp_seconds(second)


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_timestamp(end) - F.unix_timestamp(start)).cast("double") / F.lit(60.0)


def calendar_flags(moment: Column, borough: Column) -> dict[str, Column]:
    """Regressors of the forecast job, as 0/1 doubles."""
    return {
        "is_holiday": is_holiday(moment).cast("double"),
        "is_weekend": is_weekend(iso_weekday(moment)).cast("double"),
        "is_rush_hour": is_rush_hour(F.hour(moment)).cast("double"),
        "is_airport_borough": is_airport_borough(borough).cast("double"),
    }
