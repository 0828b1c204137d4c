"""Silver and gold order tables and rule scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import cents, flag
from lakeops.operators.aggregates import collect_parts
from lakeops.operators.clean import active_only
from lakeops.operators.joins import asof_join, denormalise, latest_stock_join, same_day_join
from lakeops.operators.sets import union_all
from lakeops.operators.windows import latest_per_key, repeat_purchase


def silver_order_items(lines: DataFrame, users: DataFrame, orders: DataFrame, stores: DataFrame) -> DataFrame:
    """Active order lines with user, order and store attributes."""
    facts = active_only(lines, "cancel_flg").withColumn("cancel_flg", flag("cancel_flg"))
    return denormalise(facts, [(orders, "order_id", "order_id"), (users, "user_id", "user_id"),
                               (stores, "store_id", "store_id")])


def silver_orders(orders: DataFrame, users: DataFrame, stores: DataFrame) -> DataFrame:
    """Active order headers with user and store attributes."""
    facts = active_only(orders, "cancel_flg").withColumn("cancel_flg", flag("cancel_flg"))
    return denormalise(facts, [(users, "user_id", "user_id"), (stores, "store_id", "store_id")])


def rollup_header(lines: DataFrame, keys: Sequence[str] = ("order_id", "user_id")) -> DataFrame:
    """Order header from its lines: total, first and last time."""
    return lines.groupBy(*keys).agg(
        (F.sum(cents("subtotal")) / 100.0).alias("total_amount"),
        F.min("order_datetime").alias("order_datetime"), F.max("order_datetime").alias("updated_at"))


def rollup_cart(items: DataFrame) -> DataFrame:
    """Cart header from its items."""
    return items.groupBy("cart_id").agg(
        (F.sum(cents("subtotal")) / 100.0).alias("total_amount"), F.count("item_id").alias("item_count"),
        F.min("user_id").alias("user_id"), F.min("added_at").alias("created_at"),
        F.max("added_at").alias("updated_at"))


def gold_order_items(pos_items: DataFrame, ec_items: DataFrame, loyalty: DataFrame, inventory: DataFrame,
                     logs: DataFrame, survey: DataFrame, users: DataFrame, true_asof: bool = False) -> DataFrame:
    """Gold order lines in six steps: channel union, loyalty, stock, same-day web
    activity of online orders, repeat purchase, newest survey answer and the
    customer's gold attributes.

    Stock is the newest row overall, kept only if not later than the order;
    ``true_asof`` looks up the newest row on or before the order date instead.
    """
    lines = union_all([pos_items.withColumn("purchase_channel", F.lit("POS")),
                       ec_items.withColumn("purchase_channel", F.lit("EC"))])
    lines = repeat_purchase(lines, ["user_id", "item_id"], "order_date", ["order_item_id", "subtotal"])
    stock_args = (["item_id", "store_id"], "order_date", "inventory_date", ["stock_quantity"],
                  ["stock_quantity"])
    if true_asof:
        lines = asof_join(lines, inventory, *stock_args).drop("inventory_date")
    else:
        lines = latest_stock_join(lines, inventory, *stock_args)
    points = latest_per_key(loyalty, ["user_id"], ["updated_date"], ["point_id"]).select(
        "user_id", F.col("point_balance").alias("points_earned"), "member_rank")
    answer = latest_per_key(survey, ["user_id"], ["response_date"], ["response_id"]).select(
        "user_id", F.col("survey_category").alias("last_survey_category"))
    # What belongs to a user is joined by itself first, so the lines, which are many and wide, are shuffled by user once.
    per_user = points.join(answer, "user_id", "full").join(users, "user_id", "full")
    out = same_day_join(lines, logs, "user_id", "order_date", "log_user", "event_date",
                        ["event_ts", "log_id"], ["event_type", "session_id"],
                        F.col("purchase_channel") == "EC", per_user)
    base = [c for c in lines.columns if c not in ("user_id", "stock_quantity")]
    return out.select("user_id", *base, "points_earned", "member_rank", "stock_quantity", "event_type", "session_id", "n_logs",
                      "last_survey_category", *[c for c in users.columns if c != "user_id"])


def gold_orders(items: DataFrame, header_cols: Sequence[str]) -> DataFrame:
    """Gold orders: one row per order with its header attributes and totals.

    Header attributes are equal on all lines of an order. The lines are in
    :func:`gold_order_details`.
    """
    return items.groupBy("order_id").agg(
        F.sum("quantity").alias("order_quantity"), (F.sum(cents("subtotal")) / 100.0).alias("order_amount"),
        *[F.min(c).alias(c) for c in header_cols])


def gold_order_details(items: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """The lines of an order as an array of structs, per order and part."""
    detail = F.struct("category_name", "item_id", "quantity", "unit_price", "order_item_id")
    return collect_parts(items, ["order_id"], detail, ["order_item_id", "subtotal"], max_bytes, "order_details")


def apply_rules(df: DataFrame, col: str, rules: Sequence[tuple[Column | str, float]],
                low: float | None = 0, high: float | None = None) -> DataFrame:
    """Add each rule's amount where its predicate holds, then clamp."""
    score = F.col(col)
    for predicate, amount in rules:
        test = F.expr(predicate) if isinstance(predicate, str) else predicate
        score = score + F.when(test, F.lit(amount)).otherwise(F.lit(0))
    if low is not None:
        score = F.greatest(F.lit(low), score)
    if high is not None:
        score = F.least(F.lit(high), score)
    return df.withColumn(col, score)


def stock_profile(history: DataFrame, dim: DataFrame | None, key: str, label: str) -> DataFrame:
    """Total stock by a label of the history or of a joined dimension."""
    joined = history if dim is None else history.join(dim, key)
    return joined.groupBy(label).agg(F.sum("quantity").alias("total_quantity"))
