"""Exponential smoothing with an additive trend and season, fitted to each series.

A series is one group, fitted in one task from its points alone; series are spread over
the tasks. Parameters are those of the least sum of squared one-step errors, sought on a
grid that is drawn closer around the best, all of a grid at once.
"""

from __future__ import annotations

import itertools
import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltgrid.functions.numbers import number

#: Points of each parameter's grid, times that the grid is drawn closer, and by how much.
GRID, CLOSER, FACTOR = 7, 5, 0.4
#: Autocorrelation from which a lag counts as a season.
SEASONAL = 0.3


def filled(y: np.ndarray) -> np.ndarray:
    """Missing points on the line between their neighbours; at the ends the nearest point."""
    known = np.flatnonzero(~np.isnan(y))
    return np.interp(np.arange(len(y)), known, y[known]) if len(known) else y[:0]


def season_of(y: np.ndarray) -> int:
    """The lag of the highest peak of the autocorrelation of what a straight line leaves, 1 if none is high."""
    n = len(y)
    if n < 6:
        return 1
    t = np.arange(n)
    rest = y - np.polyval(np.polyfit(t, y, 1), t)
    total = float(rest @ rest)
    if total <= 1e-12 * max(1.0, float(y @ y)):
        return 1
    size = 1 << (2 * n - 1).bit_length()
    wave = np.fft.rfft(rest, size)
    # Of each lag, over the pairs that it has.
    r = np.fft.irfft(wave * wave.conj(), size)[: n // 2 + 1] / total * n / (n - np.arange(n // 2 + 1))
    peaks = [k for k in range(2, len(r)) if r[k] >= SEASONAL and r[k] > r[k - 1] and (k + 1 == len(r) or r[k] >= r[k + 1])]
    return max(peaks, key=lambda k: (round(float(r[k]), 6), -k), default=1)


def smooth(y: np.ndarray, m: int, alpha, beta, gamma) -> dict:
    """States after the last point and one-step errors of each of the parameters, which are arrays of one length."""
    alpha, beta, gamma = (np.atleast_1d(np.asarray(p, float)) for p in (alpha, beta, gamma))
    if m > 1:
        level, trend = np.full(len(alpha), y[:m].mean()), np.full(len(alpha), (y[m : 2 * m].mean() - y[:m].mean()) / m)
        season, start = np.repeat((y[:m] - y[:m].mean() - (np.arange(m) - (m - 1) / 2) * trend[0])[:, None], len(alpha), 1), m
        level = level + trend * (m - 1) / 2
    else:
        level, trend, season, start = np.full(len(alpha), y[1]), np.full(len(alpha), y[1] - y[0]), np.zeros((1, len(alpha))), 2
    errors = []
    for t in range(start, len(y)):
        s = season[t % m]
        error = y[t] - (level + trend + s)
        errors.append(error)
        level, trend = level + trend + alpha * error, trend + alpha * beta * error
        if m > 1:
            season[t % m] = s + gamma * (1 - alpha) * error
    return {"level": level, "trend": trend, "season": season, "errors": np.array(errors).reshape(-1, len(alpha)), "start": start}


def fit(y: np.ndarray, m: int) -> tuple[float, float, float]:
    """(alpha, beta, gamma) of the least sum of squared errors."""
    middle, reach = np.full(3 if m > 1 else 2, 0.5), 0.5
    best = middle
    for _ in range(CLOSER + 1):
        axes = [np.clip(np.linspace(c - reach, c + reach, GRID), 0.0001, 0.9999) for c in best]
        grid = np.array(list(itertools.product(*axes)))
        squared = (smooth(y, m, grid[:, 0], grid[:, 1], grid[:, 2] if m > 1 else np.zeros(len(grid)))["errors"] ** 2).sum(0)
        best, reach = grid[int(np.argmin(squared))], reach * FACTOR
    return float(best[0]), float(best[1]), float(best[2]) if m > 1 else 0.0


def forecast(y: np.ndarray, season: int | None, steps: int, confidence: float) -> tuple[list[tuple], dict] | None:
    """((step, forecast, half width of its interval), ...) and the fit's statistics; None for fewer than three points."""
    y = filled(y)
    if len(y) < 3:
        return None
    m = season_of(y) if season is None else season
    if m < 1 or 2 * m > len(y) - 1:
        m = 1
    alpha, beta, gamma = fit(y, m)
    last = smooth(y, m, alpha, beta, gamma)
    errors = last["errors"][:, 0]
    mae, rmse = float(np.abs(errors).mean()), math.sqrt(float((errors**2).mean()))
    seen = y[last["start"] :]
    naive = float(np.abs(y[m:] - y[:-m]).mean())
    sizes = np.abs(seen) + np.abs(seen - errors)
    smape = float(np.where(sizes > 0, 2 * np.abs(errors) / np.where(sizes > 0, sizes, 1), 0).mean())
    stats = {"alpha": alpha, "beta": beta, "gamma": gamma, "mase": mae / naive if naive else None, "smape": smape, "mae": mae, "rmse": rmse, "season": m, "points": len(y)}
    z, spread, rows = NormalDist().inv_cdf((1 + confidence) / 2), 1.0, []
    for h in range(1, steps + 1):
        value = float(last["level"][0] + h * last["trend"][0] + (last["season"][(len(y) + h - 1) % m][0] if m > 1 else 0.0))
        rows.append((h, value, z * rmse * math.sqrt(spread)))
        spread += (alpha + alpha * beta * h + (gamma * (1 - alpha) if m > 1 and h % m == 0 else 0.0)) ** 2
    return rows, stats


STATS = ("alpha", "beta", "gamma", "mase", "smape", "mae", "rmse", "season", "points")


def _series(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    return df.select(*keys, F.col(order).alias("_at"), number(value).alias("_y"))


def _schema(df: DataFrame, keys: list[str], more: str) -> str:
    return ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys), more])


def ets_forecasts(df: DataFrame, keys: list[str], order: str, value: str, steps: int = 1, season: int | None = None, confidence: float = 0.95) -> DataFrame:
    """The next ``steps`` values of each series and half the width of their confidence interval.

    ``season`` is its length, 1 for none, found if None. What is no number is put on the
    line between its neighbours; series of fewer than three points give no rows.
    """

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        found = forecast(pdf.sort_values("_at")["_y"].to_numpy(float), season, steps, confidence)
        own = list(pdf[keys].iloc[0])
        return pd.DataFrame([[*own, *row] for row in found[0]] if found else [], columns=[*keys, "step", "forecast", "confint"])

    return _series(df, keys, order, value).groupBy(*keys).applyInPandas(solve, _schema(df, keys, "step int, forecast double, confint double"))


def ets_stats(df: DataFrame, keys: list[str], order: str, value: str, season: int | None = None) -> DataFrame:
    """Parameters, errors and season of each series' fit: alpha, beta, gamma, mase, smape, mae, rmse, season, points."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        found = forecast(pdf.sort_values("_at")["_y"].to_numpy(float), season, 1, 0.95)
        return pd.DataFrame([[*pdf[keys].iloc[0], *(found[1][s] for s in STATS)]] if found else [], columns=[*keys, *STATS])

    kinds = ", ".join(f"{s} {'int' if s in ('season', 'points') else 'double'}" for s in STATS)
    return _series(df, keys, order, value).groupBy(*keys).applyInPandas(solve, _schema(df, keys, kinds))
