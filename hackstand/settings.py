"""Typed settings with defaults; override with ``dataclasses.replace``."""

from __future__ import annotations

from dataclasses import dataclass, field

from hackstand import fixed_values as fv


@dataclass(frozen=True)
class QualityRules:
    nullable: dict = field(default_factory=lambda: dict(fv.NULLABLE))
    ranges: dict = field(default_factory=lambda: dict(fv.RANGES))
    amount_formulas: dict = field(default_factory=lambda: dict(fv.AMOUNT_FORMULAS))
    amount_tolerance: float = 0.02
    max_trip_minutes: int = 1440


@dataclass(frozen=True)
class BalanceSettings:
    block_minutes: int = 15
    deficit_threshold: int = -10


@dataclass(frozen=True)
class AbcXyzSettings:
    a_share: float = 0.80
    # one literal for A+B: 0.80 + 0.15 is not 0.95 in binary floating point
    ab_share: float = 0.95
    x_max: float = 0.2
    y_max: float = 0.5


@dataclass(frozen=True)
class GenerositySettings:
    low: float = 10.0
    high: float = 18.0


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 100
    rows_per_tree: int = 256
    contamination: float = 0.05
    fraud_quantile: float = 0.95
    min_rows: int = 200
    seed: int = 42


@dataclass(frozen=True)
class ClusterSettings:
    max_k: int = 8


@dataclass(frozen=True)
class ForecastSettings:
    min_rows: int = 1000
    horizon_hours: int = 168
    until_year: int | None = None
    season: int = 24
    z: float = 1.959963984540054


@dataclass(frozen=True)
class SpeedSettings:
    state_hours: int = 48
    fraud_threshold: float = -0.1
    block_minutes: int = 15
    lookback_days: int = 30


@dataclass(frozen=True)
class Settings:
    quality: QualityRules = field(default_factory=QualityRules)
    balance: BalanceSettings = field(default_factory=BalanceSettings)
    abc_xyz: AbcXyzSettings = field(default_factory=AbcXyzSettings)
    generosity: GenerositySettings = field(default_factory=GenerositySettings)
    forest: ForestSettings = field(default_factory=ForestSettings)
    clusters: ClusterSettings = field(default_factory=ClusterSettings)
    forecast: ForecastSettings = field(default_factory=ForecastSettings)
    speed: SpeedSettings = field(default_factory=SpeedSettings)


DEFAULTS = Settings()
