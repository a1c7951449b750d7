"""Hourly forecasts, one seasonal autoregression per borough and service.

Segments are fitted in parallel by ``applyInPandas``; one segment is at most the hours of
the calendar, so a group stays small however many trips it counts. The model is least
squares in two stages on the first and seasonal difference, with lags of the series and of its innovations
at one hour and one day and the calendar flags; an information criterion chooses among the orders.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hackstand import fixed_values as fv
from hackstand.functions.numeric import exact_avg, exact_sum, half_up
from hackstand.operators.ranking import gap_fill
from hackstand.operators.selection import filter_time_range
from hackstand.settings import DEFAULTS, ForecastSettings

SCHEMA = ("borough string, service_id string, pickup_hour timestamp, trip_count double, yhat double, "
          "yhat_lower double, yhat_upper double, model_status string, forecast_type string, holdout boolean, aic double")
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
_HOLIDAYS = frozenset(fv.HOLIDAYS)


def exog(hours: pd.DatetimeIndex, borough: str) -> np.ndarray:
    """Holiday, weekend, rush hour and airport flags (constant within a segment)."""
    keys = hours.year * 10000 + hours.month * 100 + hours.day
    return np.column_stack([
        keys.isin(_HOLIDAYS), hours.dayofweek >= 5, hours.hour.isin(fv.RUSH_HOURS),
        np.full(len(hours), borough in fv.AIRPORT_BOROUGHS),
    ]).astype(float)


def _polynomial(lags: dict[int, float], season: int, regular: bool) -> np.ndarray:
    """Coefficients of y on its own past once the differences are undone."""
    def times(a, b):
        return np.convolve(a, b)

    ar = np.zeros(max(lags) + 1 if lags else 1)
    ar[0] = 1.0
    for lag, value in lags.items():
        ar[lag] = -value
    seasonal = np.zeros(season + 1)
    seasonal[0], seasonal[season] = 1.0, -1.0
    full = times(ar, seasonal)
    return -(times(full, np.array([1.0, -1.0])) if regular else full)[1:]


#: Candidate lags (autoregressive, moving average), the season in one of them: the pair with the least information criterion is taken.
ORDERS = tuple((ar, ma) for ar in ((1, "season"), (1,), ()) for ma in ((1, "season"), ("season",), (1,), ()) if "season" in (*ar, *ma))
#: Seasons that the first stage reaches back at most, and rounds in which the model's own errors replace its innovations.
LONG_SEASONS, REFITS = 6, 12


class SeasonalModel:
    """Least squares in two stages on the differenced series, with lags, past innovations and differenced regressors.

    A long autoregression estimates the innovations; the second stage regresses on the wanted lags of the series and of these
    innovations. Then the innovations are the model's own one-step errors, from its recursion; one that does not damp past errors is refused.
    """

    def __init__(self, y: np.ndarray, x: np.ndarray, season: int, regular: bool, ar=(1, "season"), ma=()):
        self.season, self.regular = season, regular
        self.ar, self.ma = (tuple(season if v == "season" else v for v in lags) for lags in (ar, ma))
        z, dx = self._difference(y), self._difference(x)
        self.skip = max(self.ar, default=0)
        if len(z) <= max((*self.ar, *self.ma), default=0) + dx.shape[1] + len(self.ar) + len(self.ma) + 2:
            raise ValueError("series too short for the model")
        if not self.ma:
            self._set(z, dx, np.zeros(len(z)), self.skip)
        else:
            seasons = min(LONG_SEASONS, len(z) // (4 * season))
            if not seasons:
                raise ValueError("series too short for innovations")
            lags = [1, 2, 3, *[k * season + d for k in range(1, seasons + 1) for d in (0, 1)]]
            reach = lags[-1]
            innovations = np.zeros(len(z))
            innovations[reach:] = self._regress(z, np.column_stack([*self._lagged(z, lags, reach), dx[reach:]]), reach)[1]
            self._set(z, dx, innovations, reach + max((*self.ar, *self.ma)))
            for _ in range(REFITS):  # as long as the model's own errors explain more than the innovations before
                best = (self.phi, self.theta, self.slopes, self.errors)
                rss = float(self.errors @ self.errors)
                self._set(z, dx, self.errors, max((*self.ar, *self.ma)))
                now = float(self.errors @ self.errors)
                if not now < rss * (1 - 1e-5):
                    if not now < rss:
                        self.phi, self.theta, self.slopes, self.errors = best
                    break
        n, k = len(z) - self.skip, len(self.phi) + len(self.theta) + len(self.slopes)
        rss = float(self.errors @ self.errors)
        if not np.isfinite(rss) or rss > 4.0 * float(z @ z) + 1e-9:
            raise ValueError("past errors grow")
        self.sigma = float(np.sqrt(rss / max(n - k, 1)))
        # on the rows that every candidate has, so that criteria can be compared
        own = self.errors[self.season + 1:] if len(z) > 2 * self.season + 2 else self.errors[self.skip:]
        self.aic = float(len(own) * np.log(max(float(own @ own), 1e-12) / len(own)) + 2 * k)
        self.past = _polynomial(dict(zip(self.ar, self.phi)), season, regular)

    def _set(self, z: np.ndarray, dx: np.ndarray, innovations: np.ndarray, start: int) -> None:
        beta, _ = self._regress(z, np.column_stack([*self._lagged(z, self.ar, start), *self._lagged(innovations, self.ma, start), dx[start:]]), start)
        self.phi, self.theta, self.slopes = np.split(beta, [len(self.ar), len(self.ar) + len(self.ma)])
        with np.errstate(over="ignore", invalid="ignore"):
            self.errors = self._errors(z, dx)

    @staticmethod
    def _lagged(v: np.ndarray, lags, start: int) -> list[np.ndarray]:
        return [v[start - lag:len(v) - lag] for lag in lags]

    @staticmethod
    def _regress(z: np.ndarray, design: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        beta, *_ = np.linalg.lstsq(design, z[start:], rcond=None)
        if not np.isfinite(beta).all():
            raise ValueError("no finite solution")
        return beta, z[start:] - design @ beta

    def _difference(self, values: np.ndarray) -> np.ndarray:
        out = values[self.season:] - values[:-self.season]
        return out[1:] - out[:-1] if self.regular else out

    def _errors(self, z: np.ndarray, dx: np.ndarray) -> np.ndarray:
        """One-step errors on the differenced scale; those before the first are 0."""
        out = z - dx @ self.slopes
        for lag, value in zip(self.ar, self.phi):
            out[lag:] -= value * z[:-lag]
        out[:self.skip] = 0.0
        if self.ma:
            terms = list(zip(self.ma, self.theta.tolist()))
            errors = out.tolist()
            for t in range(self.skip, len(errors)):
                for lag, value in terms:
                    if t >= lag:
                        errors[t] -= value * errors[t - lag]
            out = np.array(errors)
        return out

    def fitted(self, y: np.ndarray) -> np.ndarray:
        """One step ahead for each hour of the fitted series: differences are sums of known hours, so errors are those of the series."""
        lost = len(y) - len(self.errors) + self.skip
        return np.concatenate([np.full(lost, np.nan), y[lost:] - self.errors[self.skip:]])

    def ahead(self, y: np.ndarray, x: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """Forecasts and their standard errors; ``x`` covers history and future."""
        reach, n = len(self.past), len(self.errors)
        path = np.concatenate([y[-reach:], np.zeros(steps)])
        drift = (self._difference(x) @ self.slopes)[-steps:]
        psi, weights = np.zeros(steps), dict(zip(self.ma, self.theta))
        lags = np.flatnonzero(self.past)
        for h in range(steps):
            known = sum(value * self.errors[n + h - lag] for lag, value in weights.items() if h < lag <= n + h)
            path[reach + h] = path[h:reach + h] @ self.past[::-1] + drift[h] + known
            earlier = lags[lags < h]
            psi[h] = 1.0 if h == 0 else float(self.past[earlier] @ psi[h - 1 - earlier]) + weights.get(h, 0.0)
        return path[reach:], self.sigma * np.sqrt(np.cumsum(psi**2))


def _fit(y, x, season):
    """The candidate with the least criterion; where none can be fitted, one without the regular difference."""
    found = []
    for ar, ma in ORDERS:
        try:
            found.append(SeasonalModel(y, x, season, True, ar, ma))
        except (ValueError, np.linalg.LinAlgError):
            continue
    if found:
        return min(found, key=lambda m: m.aic), "ok"
    try:
        return SeasonalModel(y, x, season, False, (1,), ()), "fallback_order"
    except (ValueError, np.linalg.LinAlgError):
        return None, "fit_failed"


def forecast_one(pdf: pd.DataFrame, settings: ForecastSettings) -> pd.DataFrame:
    """Forecast one segment: a holdout of the last hours, or the future up to a year's end."""
    borough, service = str(pdf["borough"].iloc[0]), str(pdf["service_id"].iloc[0])
    counts = pdf.set_index(pd.to_datetime(pdf["pickup_hour"]))["trip_count"].astype(float)
    hours = pd.date_range(counts.index.min(), counts.index.max(), freq="h")
    y = counts.reindex(hours, fill_value=0.0).to_numpy()
    n = len(y)
    future = settings.until_year is not None
    held = 0 if future else (settings.horizon_hours if 0 < settings.horizon_hours < n else 0)
    last = pd.Timestamp(settings.until_year, 12, 31, 23) if future else hours[-1]
    beyond = pd.date_range(hours[-1] + pd.Timedelta(hours=1), last, freq="h")
    all_hours = hours.append(beyond) if len(beyond) else hours
    out = pd.DataFrame({"pickup_hour": all_hours, "trip_count": np.concatenate([y, np.full(len(beyond), np.nan)])})
    out["yhat"] = out["yhat_lower"] = out["yhat_upper"] = out["aic"] = np.nan
    out["forecast_type"] = np.where(np.arange(len(out)) < n, "actual", "forecast")
    out["holdout"] = (np.arange(len(out)) >= n - held) & (np.arange(len(out)) < n)
    out["borough"], out["service_id"] = borough, service
    if n < settings.min_rows:
        return out.iloc[:n].assign(model_status="skipped_low_rows", holdout=False)[COLUMNS]
    x = exog(all_hours, borough)
    known = n - held
    model, status = _fit(y[:known], x[:known], settings.season)
    if model is None:
        return out.iloc[:n].assign(model_status=status, holdout=False)[COLUMNS]
    yhat = np.full(len(out), np.nan)
    error = np.full(len(out), model.sigma)
    yhat[:known] = model.fitted(y[:known])
    steps = len(out) - known
    if steps:
        yhat[known:], error[known:] = model.ahead(y[:known], x, steps)
    return out.assign(
        yhat=yhat, yhat_lower=yhat - settings.z * error, yhat_upper=yhat + settings.z * error,
        model_status=status, aic=model.aic)[COLUMNS]


def forecast_segments(series: DataFrame, settings: ForecastSettings = DEFAULTS.forecast) -> DataFrame:
    rows = series.filter("pickup_hour is not null").select(
        F.coalesce("borough", F.lit("Unknown")).alias("borough"), "service_id", "pickup_hour", "trip_count")
    return rows.groupBy("borough", "service_id").applyInPandas(lambda pdf: forecast_one(pdf, settings), SCHEMA)


def seasonal_naive(series: DataFrame, horizon: int, season: int = 24) -> DataFrame:
    """Baseline forecast table: the value one season ago; the last ``horizon`` hours are held out."""
    w = Window.partitionBy("borough", "service_id").orderBy("pickup_hour")
    filled = gap_fill(series, ["borough", "service_id"], "pickup_hour", "trip_count")
    ends = filled.groupBy("borough", "service_id").agg(F.max("pickup_hour").alias("_end"))
    yhat = F.lag("trip_count", season).over(w)
    return filled.withColumn("yhat", yhat).join(ends, ["borough", "service_id"]).select(
        "borough", "service_id", "pickup_hour", "trip_count", "yhat",
        (F.col("yhat") - 2.0).alias("yhat_lower"), (F.col("yhat") + 2.0).alias("yhat_upper"),
        F.lit("ok").alias("model_status"), F.lit("actual").alias("forecast_type"),
        (F.unix_timestamp("pickup_hour") > F.unix_timestamp("_end") - horizon * 3600).alias("holdout"))


def evaluate(forecast: DataFrame) -> DataFrame:
    """MAE and MAPE over held-out hours; the MAPE denominator is at least 1."""
    gap = F.abs(F.col("trip_count") - F.col("yhat"))
    held = forecast.filter("holdout and yhat is not null")
    return held.groupBy("borough", "service_id").agg(
        F.count(F.lit(1)).alias("n"), half_up(exact_avg(gap, 6), 4).alias("mae"),
        half_up(exact_avg(gap / F.greatest(F.abs("trip_count"), F.lit(1.0)), 6) * 100.0, 2).alias("mape"))


def query(forecast: DataFrame, borough=None, service_id=None, start=None, end=None, grain: str = "hourly") -> DataFrame:
    """Filtered forecast rows, by hour or summed by day."""
    df = forecast
    for column, wanted in (("borough", borough), ("service_id", service_id)):
        if wanted:
            df = df.filter(F.col(column) == wanted)
    df = filter_time_range(df, "pickup_hour", start, end)
    keep = ["borough", "service_id", "pickup_hour", "trip_count", "yhat", "yhat_lower", "yhat_upper",
            "model_status", "forecast_type"]
    if grain != "daily":
        return df.select(*keep)
    daily = df.groupBy(F.to_date("pickup_hour").alias("_day"), "forecast_type").agg(
        exact_sum(F.col("trip_count")).alias("trip_count"), exact_sum(F.col("yhat")).alias("yhat"),
        F.min("yhat_lower").alias("yhat_lower"), F.max("yhat_upper").alias("yhat_upper"),
        F.min("model_status").alias("model_status"))
    return daily.select(
        F.lit(borough or "All").alias("borough"), F.lit(service_id or "All").alias("service_id"),
        F.col("_day").cast("timestamp").alias("pickup_hour"), "trip_count", "yhat", "yhat_lower", "yhat_upper",
        "model_status", "forecast_type")


def summary(forecast: DataFrame) -> DataFrame:
    return forecast.agg(
        F.count_distinct("borough", "service_id").alias("segmentos"), F.count(F.lit(1)).alias("total_rows"),
        F.min("pickup_hour").alias("min_dt"), F.max("pickup_hour").alias("max_dt"))
