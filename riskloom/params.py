"""Parameter records shared by batch and streaming jobs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Model names, weights, thresholds and level bounds.
MODELS = ("xgboost", "catboost", "lightgbm", "random_forest")
WEIGHTS = {"xgboost": 0.30, "catboost": 0.28, "lightgbm": 0.25, "random_forest": 0.17}
FIVE_MODEL_WEIGHTS = {
    "catboost": 0.25,
    "xgboost": 0.25,
    "lightgbm": 0.20,
    "random_forest": 0.15,
    "isolation_forest": 0.15,
}
DEFAULT_WEIGHT = 0.1
THRESHOLDS = {
    "xgboost": 0.61,
    "catboost": 0.57,
    "lightgbm": 0.60,
    "random_forest": 0.33,
    "ensemble": 0.56,
}
PRIMARY_FALLBACK_THRESHOLD = 0.61
ENSEMBLE_FALLBACK_THRESHOLD = 0.56
NEUTRAL_SCORE = 0.5
LEVELS = ("low", "medium", "high", "critical")
HISTORY_CAPS = {"processing": 10_000, "model": 1_000, "agreement": 1_000}


@dataclass(frozen=True)
class RiskBounds:
    """Lower score bound of each level; ``low`` is declared but every other score is low anyway."""

    low: float = 0.3
    medium: float = 0.5
    high: float = 0.7
    critical: float = 0.9


@dataclass(frozen=True)
class ScoringParams:
    """Everything the scoring job needs besides the models themselves."""

    strategy: str = "ensemble"
    primary_model: str = "xgboost"
    weights: Mapping[str, float] = field(default_factory=lambda: dict(WEIGHTS))
    default_weight: float = DEFAULT_WEIGHT
    thresholds: Mapping[str, float] = field(default_factory=lambda: dict(THRESHOLDS))
    alert_threshold: float = 0.56
    bounds: RiskBounds = RiskBounds()

    def __post_init__(self) -> None:
        if self.strategy not in ("primary", "ensemble"):
            raise ValueError(f"unknown strategy: {self.strategy}")

    def strategy_threshold(self) -> float:
        """Threshold of the chosen strategy, with its fallback when the table has no entry."""
        if self.strategy == "primary":
            return self.thresholds.get(self.primary_model, PRIMARY_FALLBACK_THRESHOLD)
        return self.ensemble_threshold()

    def ensemble_threshold(self) -> float:
        return self.thresholds.get("ensemble", ENSEMBLE_FALLBACK_THRESHOLD)


def code_defaults() -> ScoringParams:
    """The built-in defaults, which differ from the configured ones: primary strategy, five weights."""
    return ScoringParams(strategy="primary", weights=dict(FIVE_MODEL_WEIGHTS), alert_threshold=0.61)
