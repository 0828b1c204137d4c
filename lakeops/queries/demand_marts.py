"""2.13 demand, stock and forecasting. A series is a store's daily quantity of a
category; the forecast used in the mart checks is the value of a year before."""

from pyspark.sql import functions as F

from lakeops.operators.upsert import upsert
from lakeops.plans import demand as DM
from lakeops.queries.registry import query
from lakeops.session import work_dir
from lakeops.sources.writers import append_table, write_table

# Daily sales per store and item with a stock figure derived from the sales.
_DAILY = """SELECT ds AS order_date, machine_id, item AS item_id, CAST(y AS DOUBLE) AS actual_quantity,
    CAST(y AS DOUBLE) * (1 + machine_id % 3) / 2 AS stock_quantity, CAST(100 + machine_id AS DOUBLE) AS unit_price FROM {demand}"""
_PLAN = """SELECT CAST(ds + INTERVAL 364 DAY AS DATE) AS order_date, machine_id, item AS item_id, CAST(y AS DOUBLE) AS forecast_quantity FROM {demand}"""


def _daily(t):
    y = F.col("y").cast("double")
    return t.demand.select(
        F.col("ds").alias("order_date"), "machine_id", F.col("item").alias("item_id"), y.alias("actual_quantity"),
        (y * (F.col("machine_id") % 3 + 1) / 2).alias("stock_quantity"), (F.col("machine_id") + 100).cast("double").alias("unit_price"))


def _plan(t):
    return t.demand.select(F.date_add("ds", 364).alias("order_date"), "machine_id", F.col("item").alias("item_id"),
                           F.col("y").cast("double").alias("forecast_quantity"))


@query("fc1_daily_series", "SELECT ds, machine_id, item, y FROM {demand}")
def fc1(t):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.to_date("l_shipdate").alias("ds"), F.col("l_suppkey").alias("machine_id"), F.col("p_type").alias("item"),
        F.col("l_quantity").alias("y"))
    return DM.daily_series(lines, ["machine_id", "item"])


_CALENDAR = """SELECT d AS date, strftime(d, '%A') AS day_of_week, strftime(d, '%B') AS month, CAST(year(d) AS INTEGER) AS year,
    'Q' || CAST(quarter(d) AS VARCHAR) AS quarter, CAST(CASE WHEN strftime(d, '%m-%d') = '01-01' AND year(d) IN (1996, 1997) THEN 1 ELSE 0 END AS INTEGER) AS is_holiday
    FROM (SELECT unnest(generate_series((SELECT min(l_shipdate) FROM lineitem), (SELECT max(l_shipdate) FROM lineitem), INTERVAL 1 DAY))::DATE AS d)"""


def _calendar(t):
    dates = t.lineitem.select(F.to_date("l_shipdate").alias("d"))
    return DM.calendar(DM.date_bounds(dates, "d"), "start", "end", ["1996-01-01", "1997-01-01"])


@query("fc2_sales_analysis", f"""
    SELECT s.ds AS order_date, s.machine_id, s.item_id, s.q AS actual_quantity, s.q AS actual_sales_quantity, item_name, category_name, unit_price,
           store_name, store_area, prefecture, day_of_week, month, quarter, year, is_holiday, CAST(s.q * unit_price AS BIGINT) AS actual_sales
    FROM (SELECT CAST(l_shipdate AS DATE) AS ds, l_suppkey AS machine_id, l_partkey AS item_id, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY ALL) s
    LEFT JOIN (SELECT item_id, item_name, category_name, CAST(floor(price) AS INTEGER) AS unit_price FROM {{items}}) i ON s.item_id = i.item_id
    LEFT JOIN {{stores}} st ON s.machine_id = st.store_id LEFT JOIN ({_CALENDAR}) c ON s.ds = c.date""")
def fc2(t):
    sales = t.lineitem.groupBy(F.to_date("l_shipdate").alias("order_date"), F.col("l_suppkey").alias("machine_id"),
                               F.col("l_partkey").alias("item_id")).agg(F.sum("l_quantity").cast("bigint").alias("actual_quantity"))
    sales = sales.withColumn("actual_sales_quantity", F.col("actual_quantity"))
    items = t.items.select("item_id", "item_name", "category_name", F.floor("price").cast("int").alias("unit_price"))
    return DM.sales_analysis(sales, items, t.stores.withColumnRenamed("store_id", "machine_id"), _calendar(t))


@query("fc3_forecast", """
    SELECT machine_id, item, count(*) + 90 AS n_rows, CAST(90 AS BIGINT) AS n_future, TRUE AS ordered,
           round(CAST(var_pop(ln(1 + y)) * count(*) AS DOUBLE), 6) AS spread, TRUE AS fits FROM {demand} GROUP BY ALL""")
def fc3(t):
    return DM.forecast_fit(DM.forecast(t.demand, ["machine_id", "item"]), ["machine_id", "item"])


# Demand of a category, ten times as high from a day on: the change that the model has to find.
_RAISED = "1998-07-01"


@query("fc3_change_points", """
    SELECT item, CAST(count(DISTINCT ds) AS BIGINT) AS n_days, TRUE AS found_within_a_week FROM {demand} GROUP BY item""")
def fc3_changes(t):
    times = F.when(F.col("ds") >= F.lit(_RAISED).cast("date"), 10).otherwise(1)
    series = t.demand.groupBy("item", "ds").agg((F.sum("y") * times).alias("y"))
    changes = DM.trend_change_points(series, ["item"])
    near = F.exists("level_days", lambda d: F.abs(F.date_diff(d, F.lit(_RAISED).cast("date"))) <= 7)
    return changes.join(series.groupBy("item").agg(F.count(F.lit(1)).alias("n_days")), "item").select(
        "item", "n_days", near.alias("found_within_a_week"))


@query("fc3_backtest", """
    SELECT item, CAST(count(DISTINCT ds) AS BIGINT) AS n_held_out, TRUE AS band_holds FROM {demand}
    WHERE ds BETWEEN DATE '2000-01-01' AND DATE '2000-03-30' GROUP BY item""")
def fc3_backtest(t):
    # Trained on the days before; the band of 95 % must hold 90 to 98 % of the days up to March.
    series = t.demand.groupBy("item", "ds").agg(F.sum("y").alias("y"))
    before = F.col("ds") < F.lit("2000-01-01").cast("date")
    ahead = DM.forecast(series.filter(before), ["item"], horizon=120).filter(~before & (F.col("ds") <= F.lit("2000-03-30").cast("date")))
    held = ahead.drop("y").join(series, ["item", "ds"])
    per = held.groupBy("item").agg(F.count(F.lit(1)).alias("n_held_out"), F.count_if(
        (F.col("yhat_lower") <= F.col("y")) & (F.col("y") <= F.col("yhat_upper"))).alias("_inside"))
    per = write_table(per, work_dir(t.spark, "backtest"))
    share = per.agg(F.sum("_inside") / F.sum("n_held_out")).first()[0]
    return per.select("item", "n_held_out", F.lit(share is not None and 0.9 <= share <= 0.98).alias("band_holds"))


@query("fc4_future_frame", """
    SELECT ds, machine_id, item, y FROM {demand}
    UNION ALL SELECT CAST(m + CAST(k AS INTEGER) AS DATE), machine_id, item, NULL
    FROM (SELECT machine_id, item, max(ds) AS m FROM {demand} GROUP BY ALL), (SELECT unnest(generate_series(1, 90)) AS k)""")
def fc4(t):
    return DM.future_frame(t.demand, ["machine_id", "item"], "ds", "y")


_PAIRS = f"""SELECT d.machine_id, d.item_id, d.order_date, actual_quantity, forecast_quantity FROM ({_DAILY}) d JOIN ({_PLAN}) p
    ON d.order_date = p.order_date AND d.machine_id = p.machine_id AND d.item_id = p.item_id"""


@query("fc5_forecast_errors", f"""
    SELECT machine_id, item_id, mae, mse, sqrt(mse) AS rmse, round(mape, 6) AS mape, round(mdape, 6) AS mdape FROM (
      SELECT machine_id, item_id, CAST(sum(abs(actual_quantity - forecast_quantity)) AS DOUBLE) / count(*) AS mae,
             CAST(sum((actual_quantity - forecast_quantity) * (actual_quantity - forecast_quantity)) AS DOUBLE) / count(*) AS mse,
             avg(CASE WHEN actual_quantity <> 0 THEN abs((actual_quantity - forecast_quantity) / actual_quantity) END) * 100 AS mape,
             median(CASE WHEN actual_quantity <> 0 THEN abs((actual_quantity - forecast_quantity) / actual_quantity) END) * 100 AS mdape
      FROM ({_PAIRS}) GROUP BY ALL)""")
def fc5(t):
    pairs = _daily(t).join(_plan(t), ["order_date", "machine_id", "item_id"])
    m = DM.forecast_metrics(pairs, ["machine_id", "item_id"], "actual_quantity", "forecast_quantity")
    return m.withColumns({"mape": F.round("mape", 6), "mdape": F.round("mdape", 6)})


@query("fc6_attach_actuals", f"""
    SELECT p.order_date, p.machine_id, p.item_id, forecast_quantity, actual_quantity FROM ({_PLAN}) p LEFT JOIN ({_DAILY}) d
    ON d.order_date = p.order_date AND d.machine_id = p.machine_id AND d.item_id = p.item_id""")
def fc6(t):
    return DM.attach_actuals(_plan(t), _daily(t), ["order_date", "machine_id", "item_id"], "actual_quantity")


@query("fc7_forecast_upsert", f"""
    SELECT coalesce(o.order_date, n.order_date) AS order_date, coalesce(o.machine_id, n.machine_id) AS machine_id,
           coalesce(o.item_id, n.item_id) AS item_id, coalesce(n.forecast_quantity, o.forecast_quantity) AS forecast_quantity,
           CASE WHEN n.order_date IS NOT NULL THEN 2 ELSE 1 END AS run
    FROM (SELECT * FROM ({_PLAN}) WHERE order_date < DATE '2000-07-01') o
    FULL JOIN (SELECT order_date, machine_id, item_id, forecast_quantity * 2 AS forecast_quantity FROM ({_PLAN}) WHERE order_date >= DATE '2000-06-01') n
    ON o.order_date = n.order_date AND o.machine_id = n.machine_id AND o.item_id = n.item_id""")
def fc7(t):
    old = _plan(t).filter("order_date < DATE '2000-07-01'").withColumn("run", F.lit(1))
    new = _plan(t).filter("order_date >= DATE '2000-06-01'").withColumn("forecast_quantity", F.col("forecast_quantity") * 2)
    return upsert(old, new, ["order_date", "machine_id", "item_id"],
                  {"forecast_quantity": "forecast_quantity", "run": F.lit(2)})


@query("fc7_evaluation_history", f"""
    SELECT machine_id, count(*) AS n, CAST(1 AS INTEGER) AS run FROM ({_PAIRS}) GROUP BY ALL
    UNION ALL SELECT machine_id, count(*), 2 FROM ({_PAIRS}) GROUP BY ALL""")
def fc7_history(t):
    pairs = _daily(t).join(_plan(t), ["order_date", "machine_id", "item_id"])
    evals = pairs.groupBy("machine_id").agg(F.count(F.lit(1)).alias("n"))
    path = work_dir(t.spark, "fc7")
    append_table(evals.withColumn("run", F.lit(1)), path)
    return append_table(evals.withColumn("run", F.lit(2)), path)


_MART = f"""
    WITH w AS (
      SELECT p.order_date, p.machine_id, p.item_id, forecast_quantity, actual_quantity, stock_quantity, unit_price,
             CAST(sum(actual_quantity) OVER k AS DOUBLE) / count(actual_quantity) OVER k AS avg_daily_demand,
             max(actual_quantity) OVER k AS max_daily_demand
      FROM ({_PLAN}) p LEFT JOIN ({_DAILY}) d ON d.order_date = p.order_date AND d.machine_id = p.machine_id AND d.item_id = p.item_id
      WINDOW k AS (PARTITION BY p.machine_id, p.item_id ORDER BY p.order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
    s AS (SELECT *, CAST(round(CAST(max_daily_demand * 2.2::DOUBLE - avg_daily_demand * 1.5::DOUBLE AS DECIMAL(24,6)), 2) AS DOUBLE) AS safety_stock FROM w)
    SELECT *, coalesce((stock_quantity < forecast_quantity)::INTEGER, 0) AS restock_flag,
           greatest(forecast_quantity - stock_quantity, 0) AS recommended_restock_quantity,
           coalesce((actual_quantity / nullif(forecast_quantity, 0) < 1)::INTEGER, 0) AS stock_warn,
           greatest(stock_quantity - (forecast_quantity + safety_stock), 0) AS excess_inventory,
           coalesce(greatest(stock_quantity - (forecast_quantity + safety_stock), 0) * unit_price, 0) AS excess_inventory_value,
           coalesce((stock_quantity < forecast_quantity)::INTEGER * greatest(forecast_quantity - actual_quantity, 0), 0) AS lost_sales_quantity,
           coalesce((stock_quantity < forecast_quantity)::INTEGER * greatest(forecast_quantity - actual_quantity, 0) * unit_price, 0) AS lost_sales_value,
           if(forecast_quantity > 0, CAST(round(CAST(actual_quantity / forecast_quantity * 100 AS DECIMAL(24,6)), 1) AS DOUBLE), 100) AS demand_fulfillment_rate
    FROM s"""


@query("fc8_stock_mart", _MART)
def fc8(t):
    return DM.stock_mart(_plan(t), _daily(t))


@query("fc9_stock_mart_upsert", f"""
    SELECT 'shop.example' AS host, order_date, machine_id, item_id, safety_stock, restock_flag FROM ({_MART})""")
def fc9(t):
    cols = ["host", "order_date", "machine_id", "item_id", "safety_stock", "restock_flag"]
    mart = DM.stock_mart(_plan(t), _daily(t)).withColumn("host", F.lit("shop.example")).select(*cols)
    yesterday = _plan(t).select(F.lit("old.example").alias("host"), "order_date", "machine_id", "item_id",
                                F.lit(0.0).alias("safety_stock"), F.lit(9).alias("restock_flag"))
    return upsert(yesterday, mart, ["order_date", "machine_id", "item_id"])


@query("fc10_trend_by_year", "SELECT CAST(year(ds) AS VARCHAR) AS year, CAST(sum(y) AS BIGINT) AS sales FROM {demand} GROUP BY ALL")
def fc10_year(t):
    return DM.trend(t.demand, "year")


@query("fc10_trend_by_month", "SELECT CAST(date_trunc('month', ds) AS DATE) AS month, CAST(sum(y) AS BIGINT) AS sales FROM {demand} GROUP BY ALL")
def fc10_month(t):
    return DM.trend(t.demand, "month")


@query("fc10_trend_by_weekday", """
    SELECT CAST(year(ds) AS INTEGER) AS year, CAST(dayofweek(ds) AS INTEGER) AS weekday, CAST(sum(s) AS DOUBLE) / count(*) AS sales
    FROM (SELECT ds, sum(y) AS s FROM {demand} GROUP BY ds) GROUP BY ALL""")
def fc10_weekday(t):
    return DM.weekday_profile(t.demand)


@query("fc11_forecast_slice", f"""
    SELECT order_date, machine_id, item_id, forecast_quantity FROM ({_PLAN})
    WHERE machine_id = 1 AND item_id = 'SMALL' AND order_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'""")
def fc11(t):
    return _plan(t).filter("machine_id = 1 AND item_id = 'SMALL' AND order_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'")


@query("fc12_calendar", _CALENDAR)
def fc12(t):
    return _calendar(t)
