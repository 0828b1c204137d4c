"""Distribution reports used to judge loaded order data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions import labels as L
from lakeops.functions.columns import cents, ranges_label
from lakeops.functions.dates import day
from lakeops.operators.aggregates import distribution
from lakeops.operators.windows import cumulative_share


def recency_profile(orders: DataFrame, as_of: str) -> DataFrame:
    """Users by days since their last order, with shares."""
    last = orders.groupBy("user_id").agg(F.max("order_date").alias("_last"))
    days = F.datediff(day(as_of), "_last").alias("days_since_last_purchase")
    return distribution(last.select(days), "days_since_last_purchase")


def frequency_profile(orders: DataFrame) -> DataFrame:
    """Users by purchase count group, with share and running share."""
    counts = orders.groupBy("user_id").agg(F.count_distinct("order_id").alias("_n"))
    group = ranges_label("_n", L.FREQUENCY_GROUPS, L.FREQUENCY_GROUP_DEFAULT).alias("frequency_group")
    shares = distribution(counts.select(group), "frequency_group", "member_count", "composition_ratio")
    return cumulative_share(shares, "frequency_group", "composition_ratio", "cumulative_ratio")


def monetary_profile(items: DataFrame) -> DataFrame:
    """Orders by price range of their total, with shares."""
    per_order = items.groupBy("order_id").agg((F.sum(cents("subtotal")) / 100.0).alias("_total"))
    label = ranges_label("_total", L.PRICE_RANGES, L.PRICE_DEFAULT, half_open=True).alias("price_range")
    return distribution(per_order.select(label), "price_range", "count", "percentage")
