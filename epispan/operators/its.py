"""Interrupted time series: one Poisson regression per (outcome, area) series.

Spark spreads the series over the cluster; each fit sees one aggregated monthly
series, a few hundred rows, so a grouped pandas function is the right size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import SMALL_CELL, Z_975

MAX_LAGS = 12
MAX_STEPS = 100
MIN_MONTHS = 24
TERMS = ["const", "time_index", "pandemic_step", "post_pandemic_time"]
EFFECTS = {
    "baseline_trend_rr_per_month": [("time_index", 1.0)],
    "immediate_level_rr": [("pandemic_step", 1.0)],
    "post_slope_change_rr_per_month": [("post_pandemic_time", 1.0)],
    "post_trend_rr_per_month": [("time_index", 1.0), ("post_pandemic_time", 1.0)],
}
_STATS = ["", "_ci_lower", "_ci_upper", "_p_value"]
SCHEMA = (
    "outcome_id string, outcome_label string, geography string, model_status string, converged boolean, n_obs long, total_events long, covariance string, "
    "pearson_dispersion double, aic double, " + ", ".join(f"{e}{s} double" for e in EFFECTS for s in _STATS)
)


def design_matrix(series: pd.DataFrame) -> np.ndarray:
    """Intercept, trend, step, slope change and a dummy for every month but the first present."""
    months = np.unique(series["month"].to_numpy())[1:]
    dummies = (series["month"].to_numpy()[:, None] == months[None, :]).astype(float)
    return np.column_stack([np.ones(len(series)), series[TERMS[1:]].to_numpy(dtype=float), dummies])


def fit_poisson(x: np.ndarray, y: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Log-link Poisson regression by iteratively reweighted least squares; last, whether it settled."""
    mean = (y + y.mean()) / 2
    beta = np.zeros(x.shape[1])
    deviance = np.inf
    settled = False
    for _ in range(MAX_STEPS):
        eta = np.log(mean)
        root = np.sqrt(mean)
        working = eta - offset + (y - mean) / mean
        beta = np.linalg.lstsq(x * root[:, None], working * root, rcond=None)[0]
        mean = np.exp(x @ beta + offset)
        with np.errstate(divide="ignore", invalid="ignore"):
            new = 2 * np.sum(np.where(y > 0, y * np.log(y / mean), 0.0) - (y - mean))
        if abs(new - deviance) <= 1e-10 * (abs(new) + 1e-10):
            settled = True
            break
        deviance = new
    return beta, mean, settled


def robust_covariance(x: np.ndarray, residual: np.ndarray, mean: np.ndarray, lags: int) -> np.ndarray:
    """Sandwich covariance; ``lags`` above zero adds Bartlett-weighted autocovariances.

    Rows are in time order and lags count rows: excluded years are simply absent.
    """
    scores = x * residual[:, None]
    meat = scores.T @ scores
    for lag in range(1, min(lags, len(x) - 1) + 1):
        cross = scores[lag:].T @ scores[:-lag]
        meat += (1 - lag / (lags + 1)) * (cross + cross.T)
    bread = np.linalg.pinv(x.T @ (x * mean[:, None]))
    return bread @ meat @ bread


def _fit(series: pd.DataFrame, x: np.ndarray, terms: list[str], effects: dict[str, list[tuple[str, float]]]) -> dict[str, object]:
    y = series["count"].to_numpy(dtype=float)
    beta, mean, settled = fit_poisson(x, y, series["offset_log_population"].to_numpy(dtype=float))
    if not settled:
        return {"model_status": "not_converged", "converged": False}
    residual = y - mean
    covariance, kind = robust_covariance(x, residual, mean, MAX_LAGS), f"HAC_{MAX_LAGS}"
    if not np.isfinite(covariance).all():
        covariance, kind = robust_covariance(x, residual, mean, 0), "HC0"
    rank = np.linalg.matrix_rank(x)
    log_likelihood = np.sum(y * np.log(mean) - mean) - sum(math.lgamma(v + 1) for v in y)
    result: dict[str, object] = {
        "model_status": "fitted_descriptive_its",
        "converged": True,
        "covariance": kind,
        "pearson_dispersion": float(np.sum(residual**2 / mean) / (len(y) - rank)),
        "aic": float(-2 * log_likelihood + 2 * rank),
    }
    for name, weights in effects.items():
        contrast = np.zeros(x.shape[1])
        for term, weight in weights:
            contrast[terms.index(term)] = weight
        estimate = float(contrast @ beta)
        error = math.sqrt(max(float(contrast @ covariance @ contrast), 0.0))
        result[name] = math.exp(estimate)
        result[f"{name}_ci_lower"] = math.exp(estimate - Z_975 * error)
        result[f"{name}_ci_upper"] = math.exp(estimate + Z_975 * error)
        result[f"{name}_p_value"] = 1.0 if error == 0 else math.erfc(abs(estimate / error) / math.sqrt(2))
    return result


def _fit_series(key: tuple, series: pd.DataFrame) -> pd.DataFrame:
    series = series.sort_values("period")
    events = int(series["count"].sum())
    row: dict[str, object] = {
        "outcome_id": key[0], "outcome_label": series["outcome_label"].iloc[0], "geography": key[1], "n_obs": len(series), "total_events": events,
        "model_status": "suppressed_insufficient_events",
    }
    if len(series) >= MIN_MONTHS and events >= SMALL_CELL:
        row.update(_fit(series, design_matrix(series), TERMS, EFFECTS))
    return _row(row, SCHEMA)


def _row(values: dict[str, object], schema: str) -> pd.DataFrame:
    return pd.DataFrame([{name: values.get(name) for name in (field.split()[0] for field in schema.split(", "))}])


def _slim(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "outcome_id", "outcome_label", "geography", "period", "month", *TERMS[1:],
        F.col("count").cast("long").alias("count"), F.col("offset_log_population").cast("double"),
    )


LEVEL_SCHEMA = "outcome_id string, geography string, converged boolean, " + ", ".join(f"immediate_level_rr{s} double" for s in _STATS)


def _fit_level(key: tuple, series: pd.DataFrame) -> pd.DataFrame:
    series = series.sort_values("period")
    row: dict[str, object] = {"outcome_id": key[0], "geography": key[1]}
    step = series["pandemic_step"].to_numpy(dtype=float)
    if len(series) >= MIN_MONTHS and 0 < step.sum() < len(step) and all(series["count"][step == s].sum() > 0 for s in (0, 1)):
        x = np.column_stack([np.ones(len(series)), step])
        row.update(_fit(series, x, ["const", "pandemic_step"], {"immediate_level_rr": [("pandemic_step", 1.0)]}))
    return _row(row, LEVEL_SCHEMA)


def fit_level_change(monthly: DataFrame) -> DataFrame:
    """Rate ratio after against before the interruption, without trend or season, with the same robust limits.

    Series that are too short, or have no events on one side, come back without an estimate.
    """
    return _slim(monthly).groupBy("outcome_id", "geography").applyInPandas(_fit_level, LEVEL_SCHEMA)


MOMENTS_SCHEMA = "outcome_id string, geography string, moment string, fitted double"


def _fit_moments(key: tuple, series: pd.DataFrame) -> pd.DataFrame:
    series = series.sort_values("period")
    out: dict[str, float] = {}
    if len(series) >= MIN_MONTHS and series["count"].sum() >= SMALL_CELL:
        offset = series["offset_log_population"].to_numpy(dtype=float)
        _, mean, settled = fit_poisson(design_matrix(series), series["count"].to_numpy(dtype=float), offset)
        if settled:
            out = {term: float(mean @ series[term].to_numpy(dtype=float)) for term in TERMS[1:]}
            out |= {f"month_{m}": float(mean[series["month"] == m].sum()) for m in sorted(series["month"].unique())}
    return pd.DataFrame([(*key, name, value) for name, value in out.items()], columns=["outcome_id", "geography", "moment", "fitted"])


def fitted_moments(monthly: DataFrame) -> DataFrame:
    """Fitted events of each model summed as its score equations sum them.

    A Poisson fit is the one whose sums per calendar month, over the step, and weighted by time
    and slope equal the observed sums, so these rows can be checked without fitting anything.
    """
    return _slim(monthly).groupBy("outcome_id", "geography").applyInPandas(_fit_moments, MOMENTS_SCHEMA)


def fit_interrupted_series(monthly: DataFrame) -> DataFrame:
    """Fit every (outcome, area) series of a table with interruption variables.

    Series under 24 months or five events, and fits that did not settle, come back marked and
    without estimates.
    """
    return _slim(monthly).groupBy("outcome_id", "geography").applyInPandas(_fit_series, SCHEMA)
