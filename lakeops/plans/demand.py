"""Demand series, per-series forecasts, forecast errors and the stock mart."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.columns import safe_div
from lakeops.functions.dates import holiday_flag, quarter_label, weekday_number
from lakeops.operators.joins import denormalise
from lakeops.operators.windows import rolling
from lakeops.plans import trend_changes
from lakeops.session import work_dir
from lakeops.sources.writers import write_table


def daily_series(sales: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y") -> DataFrame:
    """Daily total per series; rows without a date or key are dropped."""
    return sales.dropna(subset=[ds, *keys]).groupBy(ds, *keys).agg(F.sum(y).cast("bigint").alias(y))


def sales_analysis(sales: DataFrame, items: DataFrame, locations: DataFrame, calendar_dim: DataFrame) -> DataFrame:
    """Daily sales with item, location and calendar attributes."""
    wide = denormalise(sales, [(items, "item_id", "item_id"), (locations, "machine_id", "machine_id"),
                               (calendar_dim, "order_date", "date")])
    return wide.withColumn("actual_sales", (F.col("actual_sales_quantity") * F.col("unit_price")).cast("bigint"))


def calendar(bounds_df: DataFrame, start: str, end: str, holidays: Sequence[str] = ()) -> DataFrame:
    """Calendar dimension from a one-row frame holding the first and last date."""
    days = bounds_df.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("date"))
    return days.select(
        "date", F.date_format("date", "EEEE").alias("day_of_week"), F.date_format("date", "MMMM").alias("month"),
        F.year("date").alias("year"), quarter_label("date").alias("quarter"),
        holiday_flag("date", holidays).alias("is_holiday"))


def future_frame(series: DataFrame, keys: Sequence[str], ds: str, y: str, horizon: int = 90) -> DataFrame:
    """History plus the next ``horizon`` days of each series with empty ``y``."""
    last = series.groupBy(*keys).agg(F.max(ds).alias("_last"))
    ahead = last.select(
        F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon))).alias(ds), *keys,
        F.lit(None).cast(series.schema[y].dataType).alias(y))
    return series.select(ds, *keys, y).unionByName(ahead)


# --- forecast --------------------------------------------------------------


def _quantile(level: float) -> float:
    """Half width of the central band of a standard normal that holds ``level``."""
    if not 0 < level < 1:
        raise ValueError("level must be between 0 and 1")
    return NormalDist().inv_cdf((1 + level) / 2)


def _design(days: np.ndarray, origin: float, span: float, weekly: bool, yearly: bool) -> np.ndarray:
    """Intercept, linear trend and Fourier terms for week and year."""
    cols = [np.ones_like(days), (days - origin) / span]
    terms = ([(7.0, k) for k in range(1, 4)] if weekly else []) + (
        [(365.25, k) for k in range(1, 7)] if yearly else [])
    for period, k in terms:
        angle = 2 * np.pi * k * days / period
        cols += [np.sin(angle), np.cos(angle)]
    return np.column_stack(cols)


def fit_series(days: np.ndarray, y: np.ndarray, horizon: int, level: float, paths: int = 300,
               seed: int = 0) -> dict[str, np.ndarray]:
    """Fit one series and predict its history and the days ahead.

    ``days`` are day numbers in ascending order. log(1 + y) is regressed on a
    piecewise-linear trend with steps and on seasonality with a small ridge penalty, which makes
    the seasonality multiplicative. The days at which slope or level change are found
    with a penalty on the changes, see ``trend_changes``. The band of the history
    has the spread of the residuals; ahead, ``paths`` simulated courses add changes of the trend, as frequent
    and as large as those of the history, and the error of the estimate.
    Seasonal terms need at least two full periods. A series without any value
    has no forecast: its days come back with empty figures.
    """
    half_width = _quantile(level)
    known = ~np.isnan(y)
    if not known.any():
        ahead = np.concatenate([days, days[-1] + 1 + np.arange(horizon)])
        none = np.full(len(ahead), np.nan)
        return {"days": ahead, "y": none, "yhat": none, "yhat_lower": none, "yhat_upper": none, "changes": trend_changes.NONE}
    origin, last = days[known][0], days[known][-1]
    span = max(last - origin, 1.0)
    weekly, yearly = span >= 14, span >= 730
    ahead = np.concatenate([days, last + 1 + np.arange(horizon)])
    design = _design(ahead, origin, span, weekly, yearly)
    target = np.log1p(np.clip(y[known], 0, None))
    penalty = np.full(design.shape[1], 0.1)
    penalty[0] = 0.0
    base = design[: len(days)][known]
    changes = trend_changes.change_days(days[known], target, base, penalty / 100, span)
    design = np.hstack([design, trend_changes.columns(ahead, changes, span)])
    penalty = np.append(penalty, np.full(len(changes), 1e-3))
    x = design[: len(days)][known]
    inverse = np.linalg.inv(x.T @ x + np.diag(penalty))
    beta = inverse @ (x.T @ target)
    rest = target - x @ beta
    free = max(len(target) - x.shape[1], 1)
    sigma = np.sqrt(np.sum(rest ** 2) / free)
    low, high = -half_width * sigma, half_width * sigma
    if len(rest) * (1 - level) >= 2:  # the residuals themselves show the tails
        wider = np.sqrt(len(rest) / free)
        low, high = (min(wider * q, 0.0) if s < 0 else max(wider * q, 0.0)
                     for s, q in zip((-1, 1), np.quantile(rest, [(1 - level) / 2, (1 + level) / 2])))
    fitted = design @ beta
    # The error of the estimate widens the band ahead, as do changes to come.
    lever = np.sqrt(1.0 + np.maximum(np.einsum("ij,jk,ik->i", design[len(days):], inverse, design[len(days):]), 0.0))
    lower = fitted + np.append(np.full(len(days), low), low * lever)
    upper = fitted + np.append(np.full(len(days), high), high * lever)
    if len(changes):
        rng = np.random.default_rng(seed)
        sizes = beta[-len(changes):] / np.where(changes[:, 1] == trend_changes.SLOPE, span, 1.0)
        to_come = trend_changes.simulated_changes(rng, changes, sizes, span, horizon, paths)
        errors = rng.choice(rest, (paths, horizon)) * np.sqrt(len(rest) / free) * lever
        sums = np.sort(to_come + errors, axis=0)
        ranks = np.clip(np.round(np.array([(1 - level) / 2, (1 + level) / 2]) * (paths - 1)).astype(int), 0, paths - 1)
        lower[len(days):] = np.minimum(lower[len(days):], fitted[len(days):] + sums[ranks[0]])
        upper[len(days):] = np.maximum(upper[len(days):], fitted[len(days):] + sums[ranks[1]])

    def back(v: np.ndarray) -> np.ndarray:
        return np.clip(np.expm1(np.clip(v, -50, 50)), 0, None)

    return {"days": ahead, "y": np.concatenate([y, np.full(horizon, np.nan)]), "yhat": back(fitted),
            "yhat_lower": back(lower), "yhat_upper": back(upper), "changes": changes}


def _fitted(series: DataFrame, keys: Sequence[str], ds: str, y: str, horizon: int, level: float, schema: str,
            rows: Callable[[pa.Table, list[int], list[dict[str, np.ndarray]]], pa.Table]) -> DataFrame:
    """Fit every series; ``rows`` makes the result of the series in a batch.

    Input is summed to one row per series and day by Spark, so a series is as
    long as its history in days. Partitions hold whole series in order; a task
    fits them one after the other as the Arrow batches pass.
    """
    keys = list(keys)
    daily = series.dropna(subset=[ds]).groupBy(*keys, F.unix_date(ds).cast("double").alias("days")).agg(
        F.sum(y).cast("double").alias("y"))
    key_ddl = ", ".join(f"{k} {daily.schema[k].dataType.simpleString()}" for k in keys)

    def fit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_series(batches, keys):
            actual = table["y"].to_numpy(zero_copy_only=False)
            days = table["days"].to_numpy()
            starts = _series_starts(table, keys)
            fits = [fit_series(days[lo:hi], actual[lo:hi], horizon, level) for lo, hi in zip(starts, [*starts[1:], len(table)])]
            yield from rows(table, starts, fits).to_batches()

    return daily.repartition(*keys).sortWithinPartitions(*keys, "days").mapInArrow(fit_all, f"{key_ddl}, {schema}")


def forecast(series: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y", horizon: int = 90,
             level: float = 0.95) -> DataFrame:
    """One model per series: trend with change points, weekly and yearly seasonality, interval."""
    keys = list(keys)

    def rows(table: pa.Table, starts: list[int], fits: list[dict[str, np.ndarray]]) -> pa.Table:
        owner = pa.array(np.repeat(starts, [len(f["days"]) for f in fits]))
        col = {n: np.concatenate([f[n] for f in fits]) for n in ("days", "y", "yhat", "yhat_lower", "yhat_upper")}
        out = {k: table[k].take(owner) for k in keys}
        out["ds"] = pa.array(col["days"].astype("int32")).cast(pa.date32())
        out |= {n: pa.array(col[n], mask=np.isnan(col[n])) for n in ("y", "yhat", "yhat_lower", "yhat_upper")}
        return pa.table(out)

    return _fitted(series, keys, ds, y, horizon, level, "ds date, y double, yhat double, yhat_lower double, yhat_upper double", rows)


def trend_change_points(series: DataFrame, keys: Sequence[str], ds: str = "ds", y: str = "y") -> DataFrame:
    """The days at which the trend of each series changes its slope or its level, as lists; empty for a steady trend."""
    keys = list(keys)

    def rows(table: pa.Table, starts: list[int], fits: list[dict[str, np.ndarray]]) -> pa.Table:
        out = {k: table[k].take(pa.array(starts)) for k in keys}
        for name, kind in (("slope_days", trend_changes.SLOPE), ("level_days", trend_changes.LEVEL)):
            days = [f["changes"][f["changes"][:, 1] == kind, 0].astype("int32") for f in fits]
            out[name] = pa.array(days, pa.list_(pa.int32())).cast(pa.list_(pa.date32()))
        return pa.table(out)

    return _fitted(series, keys, ds, y, 1, 0.95, "slope_days array<date>, level_days array<date>", rows)


def _series_starts(table: pa.Table, keys: Sequence[str]) -> list[int]:
    """Row numbers at which a new series begins (rows are sorted by key)."""
    codes = [pc.dictionary_encode(table[k].combine_chunks(), null_encoding="encode").indices.to_numpy() for k in keys]
    changed = np.zeros(len(table), dtype=bool)
    for code in codes:
        changed[1:] |= code[1:] != code[:-1]
    return [0, *np.flatnonzero(changed)]


def _whole_series(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Regroup batches so that no series is cut in two."""
    pending = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*pending, batch])
        cut = _series_starts(table, keys)[-1]
        if cut:
            yield table.slice(0, cut)
        pending = table.slice(cut).to_batches()
    if pending:
        yield pa.Table.from_batches(pending)


def forecast_metrics(df: DataFrame, keys: Sequence[str], y: str, yhat: str) -> DataFrame:
    """MAE, MSE, RMSE, MAPE and MdAPE (percent) per series.

    Percentages skip rows with ``y = 0``. Null actuals do not count.
    """
    known = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    err = F.col(y) - F.col(yhat)
    pct = F.when(F.col(y) != 0, F.abs(err / F.col(y)))
    return (
        known.groupBy(*keys).agg(
            F.avg(F.abs(err)).alias("mae"), F.avg(err * err).alias("mse"), (F.avg(pct) * 100).alias("mape"),
            (F.median(pct) * 100).alias("mdape"))
        .withColumn("rmse", F.sqrt("mse"))
    )


def forecast_fit(out: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How a forecast fits its own history, per series.

    ``spread`` is the sum of squares of log(1 + y) around its mean, ``fits``
    whether the forecast leaves no more than that (a regression with a constant
    cannot leave more) and, over all series, clearly less. ``ordered``: every
    figure lies in its band and is not negative. The figures of the series are stored, so that the forecast
    is computed once.
    """
    known = F.col("y").isNotNull()
    rest = F.log1p("y") - F.log1p("yhat")
    per = out.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~known).alias("n_future"),
        F.every((F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper")) & (F.col("yhat") >= 0)).alias("ordered"),
        F.round(F.var_pop(F.when(known, F.log1p("y"))) * F.count_if(known), 6).alias("spread"),
        F.sum(F.when(known, rest * rest)).alias("_left"))
    per = write_table(per, work_dir(per.sparkSession, "forecast-fit"))
    total = per.agg((F.sum("_left") < F.sum("spread") * 0.999)).first()[0]
    return per.withColumn("fits", (F.col("_left") <= F.col("spread") + 1e-5) & F.lit(bool(total))).drop("_left")


def attach_actuals(forecasts: DataFrame, history: DataFrame, on: Sequence[str], actual: str) -> DataFrame:
    """Forecast rows with the actual of the same series and date, where known."""
    return forecasts.join(history.select(*on, actual), list(on), "left")


# --- stock mart ------------------------------------------------------------


def stock_mart(forecasts: DataFrame, actuals: DataFrame, keys: Sequence[str] = ("machine_id", "item_id"),
               date: str = "order_date") -> DataFrame:
    """Restock, safety stock, excess stock, lost sales and fulfilment per day.

    ``forecasts`` holds the keys, the date and ``forecast_quantity``;
    ``actuals`` the keys, the date, ``actual_quantity``, ``stock_quantity`` and
    ``unit_price``. Days without actuals stay, with null actuals.
    """
    wide = forecasts.join(actuals, [date, *keys], "left")
    wide = rolling(wide, keys, date, {"avg_daily_demand": F.avg("actual_quantity"),
                                      "max_daily_demand": F.max("actual_quantity")}, 7)
    plan, sold, stock, price = (F.col(c) for c in (
        "forecast_quantity", "actual_quantity", "stock_quantity", "unit_price"))
    safety = F.col("max_daily_demand") * 2.2 - F.col("avg_daily_demand") * 1.5
    wide = wide.withColumn("safety_stock", F.round(safety.cast("decimal(24,6)"), 2).cast("double"))
    need = plan + F.col("safety_stock")
    short = stock < plan
    lost = short & (sold < plan)
    return wide.withColumns({
        "restock_flag": F.when(short, 1).otherwise(0),
        "recommended_restock_quantity": F.when(short, plan - stock).otherwise(0.0),
        "stock_warn": F.when(safe_div(sold, plan) < 1, 1).otherwise(0),
        "excess_inventory": F.when(stock > need, stock - need).otherwise(0.0),
        "excess_inventory_value": F.when(stock > need, (stock - need) * price).otherwise(0.0),
        "lost_sales_quantity": F.when(lost, plan - sold).otherwise(0.0),
        "lost_sales_value": F.when(lost, (plan - sold) * price).otherwise(0.0),
        "demand_fulfillment_rate": F.when(
            plan > 0, F.round((sold / plan * 100).cast("decimal(24,6)"), 1).cast("double")).otherwise(100.0),
    })


def trend(series: DataFrame, grain: str, ds: str = "ds", y: str = "y") -> DataFrame:
    """Total by year or by month (first day)."""
    key = F.year(ds).cast("string") if grain == "year" else F.trunc(ds, "MM")
    return series.groupBy(key.alias(grain)).agg(F.sum(y).alias("sales"))


def weekday_profile(series: DataFrame, ds: str = "ds", y: str = "y") -> DataFrame:
    """Mean daily total per year and weekday (Sunday = 0)."""
    daily = series.groupBy(ds).agg(F.sum(y).alias("_sales"))
    return daily.groupBy(F.year(ds).alias("year"), weekday_number(ds).alias("weekday")).agg(
        F.avg("_sales").alias("sales"))


def date_bounds(df: DataFrame, col: str) -> DataFrame:
    """First and last date as a one-row frame, for :func:`calendar`."""
    return df.agg(F.min(col).alias("start"), F.max(col).alias("end"))


def literal_calendar(spark: SparkSession, start: str, end: str, holidays: Sequence[str] = ()) -> DataFrame:
    """Calendar between two given dates."""
    one = spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    return calendar(one, "start", "end", holidays)
