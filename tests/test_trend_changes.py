"""Change points of trends, against planted ones and a plain solver."""

from datetime import date, timedelta

import numpy as np
import pytest

from lakeops.plans import demand as DM
from lakeops.plans import trend_changes as TC


def course(n, slopes, seed=0, noise=0.1, level=4.0):
    """Log-linear trend whose slope per day changes at given days, with a week."""
    rng = np.random.default_rng(seed)
    days = np.arange(n, dtype=float) + 15_000
    trend = level + sum(s * np.maximum(days - days[0] - at, 0) for at, s in slopes)
    return days, np.expm1(trend + 0.2 * np.sin(2 * np.pi * days / 7) + rng.normal(0, noise, n))


def plain_solver(gram, products, penalty, steps=60_000):
    """Proximal gradient steps."""
    size = 1 / np.linalg.eigvalsh(gram).max()
    w = v = np.zeros(len(products))
    for k in range(steps):
        free = v - size * (gram @ v - products)
        new = np.sign(free) * np.maximum(np.abs(free) - size * penalty, 0)
        v = new + k / (k + 3) * (new - w)
        w = new
    return w


def test_coordinate_descent_against_a_plain_solver():
    rng = np.random.default_rng(5)
    knots = np.arange(7, 270, 7.0)
    x = TC.columns(np.arange(300.0), np.stack([knots, np.zeros(len(knots))], axis=1), 300.0)
    line = np.stack([np.ones(300), np.arange(300.0)], axis=1)
    x -= line @ np.linalg.lstsq(line, x, rcond=None)[0]  # as the search does with the other terms
    x /= np.sqrt((x * x).sum(axis=0))
    y = 3 * x[:, 12] - 2 * x[:, 25] + rng.normal(0, 0.05, 300)
    gram, products = x.T @ x, x.T @ y

    def value(w, penalty):
        return w @ gram @ w / 2 - products @ w + penalty * np.abs(w).sum()

    for penalty in (0.02, 0.1, 0.5):
        w = TC.lasso(gram, products, penalty, np.zeros(len(products)))
        assert value(w, penalty) == pytest.approx(value(plain_solver(gram, products, penalty), penalty), abs=1e-3)


@pytest.mark.parametrize("slopes", [[(0, 0.001), (400, 0.006), (800, -0.008)], [(500, -0.004)], [(0, 0.002), (300, -0.004)]])
@pytest.mark.parametrize("seed", range(3))
def test_planted_changes_within_a_week(slopes, seed):
    days, y = course(1200, slopes, seed)
    found = DM.fit_series(days, y, 30, 0.95)["changes"]
    want = [at for at, _ in slopes if at]
    assert len(found) == len(want) and np.abs(found[:, 0] - days[0] - want).max() <= 7 and not found[:, 1].any()


@pytest.mark.parametrize("seed", range(10))
def test_steady_trends_have_none(seed):
    days, y = course(700, [(0, 0.001)], seed)
    assert not len(DM.fit_series(days, y, 30, 0.95)["changes"])


def test_jump_of_the_level_is_followed():
    days, y = course(1000, [], 3)
    y[600:] *= 3
    out = DM.fit_series(days, y, 60, 0.95)
    assert out["changes"].tolist() == [[days[0] + 600, TC.LEVEL]]
    assert np.abs(np.log(out["yhat"][-60:] / np.expm1(4.0 + np.log(3.0)))).max() < 0.35  # a week of 0.2 included


def test_horizon_follows_the_last_slope():
    days, y = course(1000, [(0, 0.003), (600, -0.006)], 1)
    out = DM.fit_series(days[:910], y[:910], 90, 0.95)
    straight = np.polyfit(days[:910], np.log1p(y[:910]), 1)
    error = np.abs(np.log1p(out["yhat"][-90:]) - np.log1p(y[910:])).mean()
    assert error < 0.15 < 0.5 < np.abs(np.polyval(straight, days[910:]) - np.log1p(y[910:])).mean()


def test_band_covers_held_out_days():
    inside = total = 0
    for seed in range(40):
        slopes = [[], [(0, 0.001)], [(400, 0.003)], [(300, 0.003), (700, -0.004)]][seed % 4]
        days, y = course(1090, slopes, seed, noise=0.2)
        out = DM.fit_series(days[:1000], y[:1000], 90, 0.95)
        inside += int(((out["yhat_lower"][-90:] <= y[1000:]) & (y[1000:] <= out["yhat_upper"][-90:])).sum())
        total += 90
    assert 0.90 <= inside / total <= 0.98


def test_change_points_of_many_series(spark):
    rows = []
    for k in range(6):
        days, y = course(900, [(500, 0.006 if k % 2 else 0.0)], k)
        rows += [(k, None if i == 7 else date(1970, 1, 1) + timedelta(days=int(d)), float(v)) for i, (d, v) in enumerate(zip(days, y))]
    rows.append((99, date(2020, 1, 1), None))
    out = DM.trend_change_points(spark.createDataFrame(rows, "k int, ds date, y double"), ["k"]).collect()
    assert not any(r["level_days"] for r in out)
    found = {r["k"]: r["slope_days"] for r in out}
    assert found[99] == [] and all(not found[k] for k in (0, 2, 4))
    for k in (1, 3, 5):
        assert [abs((d - date(1970, 1, 1)).days - 15_500) <= 7 for d in found[k]] == [True]


def test_sums_of_squares_from_shared_products():
    """Refits without each change, and the best change to add, as from refits one by one."""
    days, y = course(300, [(150, 0.01)], 2)
    base, at = np.stack([np.ones(300), (days - days[0]) / 300], axis=1), TC.candidates(days)
    tried = np.concatenate([np.stack([at, np.full(len(at), kind)], axis=1) for kind in (TC.SLOPE, TC.LEVEL)])
    fits = TC._Fits(days, np.log1p(y), base, np.full(2, 1e-3), 300.0, tried)
    some = tried[[3, 20, 40]]
    one_by_one = [fits.left(np.delete(some, i, axis=0)) for i in range(3)]
    assert fits.left_without_each(some) == pytest.approx(one_by_one, rel=1e-9)
    best = fits.best(some, tried)
    least = min(fits.left(np.concatenate([some, c[None, :]])) for c in tried)
    assert fits.left(np.concatenate([some, best[None, :]])) == pytest.approx(least, rel=1e-4)


def test_fit_of_a_forecast_is_computed_once(spark):
    days, y = course(60, [])
    rows = [(1, date(1970, 1, 1) + timedelta(days=int(d)), float(v)) for d, v in zip(days, y)]
    out = DM.forecast_fit(DM.forecast(spark.createDataFrame(rows, "k int, ds date, y double"), ["k"]), ["k"])
    assert "MapInArrow" not in out._jdf.queryExecution().executedPlan().toString() and out.first()["n_rows"] == 150
