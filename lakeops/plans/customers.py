"""Customer-360: lifetime value, RFM, segments and the gold users table.

Inputs are silver tables with these columns: orders (user_id, order_id,
channel 'POS'/'EC', total_amount, order_date, store_id), items (user_id,
channel, category_name), users (user_id, line_member_id, …).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions import labels as L
from lakeops.functions.columns import bucketize, cents, money_sum, ranges_label, safe_div
from lakeops.functions.dates import day
from lakeops.operators.aggregates import collect_parts
from lakeops.operators.null_safe import null_safe_join
from lakeops.operators.sets import union_all
from lakeops.operators.windows import latest_per_key

SCOPES = {"all": None, "pos": "POS", "ec": "EC"}


def channel_orders(pos: DataFrame, ec: DataFrame) -> DataFrame:
    """POS and EC orders as one table; EC orders have no store."""
    return union_all([pos.withColumn("channel", F.lit("POS")), ec.withColumn("channel", F.lit("EC"))])


def _in(scope: str | None) -> Column:
    return F.lit(True) if scope is None else F.col("channel") == scope


def _ltv_aggs(as_of: str) -> list[Column]:
    amount, since = "total_amount", lambda n: F.col("order_date") >= F.date_sub(day(as_of), n)
    return [
        money_sum(amount, _in("POS")).alias("ltv_pos"),
        money_sum(amount, _in("EC")).alias("ltv_ec"),
        money_sum(amount).alias("ltv_all_time"),
        money_sum(amount, since(365)).alias("ltv_last_year"),
        money_sum(amount, since(730)).alias("ltv_last_two_years"),
    ]


def _one_order(orders: DataFrame) -> DataFrame:
    """One row per user, channel and order, so that order counts are plain sums.

    A distinct count per channel would expand every row once per scope; this
    first step is an ordinary partial aggregate instead.
    """
    return orders.groupBy("user_id", "channel", "order_id").agg(
        F.sum(cents("total_amount")).alias("_cents"), F.max("order_date").alias("_last"),
        F.min("order_date").alias("_first"))


def ltv(orders: DataFrame, as_of: str) -> DataFrame:
    """Lifetime value per user: in total, per channel, last one and two years."""
    return orders.groupBy("user_id").agg(*_ltv_aggs(as_of))


def _rfm_aggs(first: str = "order_date", last: str = "order_date", amount: Column | None = None) -> list[Column]:
    """Aggregates over one row per order."""
    amount = cents("total_amount") if amount is None else amount
    aggs = []
    for name, channel in SCOPES.items():
        hit = _in(channel)
        aggs += [
            F.max(F.when(hit, F.col(last))).alias(f"last_purchase_date_{name}"),
            F.min(F.when(hit, F.col(first))).alias(f"first_purchase_date_{name}"),
            F.count(F.when(hit & F.col("order_id").isNotNull(), 1)).alias(f"f_purchase_count_{name}"),
            F.sum(F.when(hit, amount).otherwise(0)).alias(f"_m_{name}"),
        ]
    return aggs


def _with_rfm(per_user: DataFrame, as_of: str) -> DataFrame:
    derived = {}
    for name in SCOPES:
        derived[f"r_days_since_last_purchase_{name}"] = F.datediff(day(as_of), f"last_purchase_date_{name}")
        derived[f"m_average_order_value_{name}"] = safe_div(
            F.col(f"_m_{name}") / 100.0, f"f_purchase_count_{name}", 0.0)
    return per_user.withColumns(derived).drop(*[f"_m_{n}" for n in SCOPES])


def rfm_measures(orders: DataFrame, as_of: str, unique_orders: bool = False) -> DataFrame:
    """Recency, frequency and average order value, overall and per channel.

    ``unique_orders`` states that an order id occurs once, which saves the
    distinct count its shuffle.
    """
    if unique_orders:
        return _with_rfm(orders.groupBy("user_id").agg(*_rfm_aggs()), as_of)
    per_order = _one_order(orders)
    return _with_rfm(per_order.groupBy("user_id").agg(*_rfm_aggs("_first", "_last", F.col("_cents"))), as_of)


def first_last_store(orders: DataFrame, by: str = "id") -> DataFrame:
    """First and last store of a user's POS orders.

    ``by="id"`` takes the smallest and largest store id, ``by="date"`` the
    stores of the earliest and latest order.
    """
    pos = orders.filter(_in("POS"))
    if by == "id":
        first, last = F.min("store_id"), F.max("store_id")
    else:
        at = F.struct("order_date", "order_id")
        first, last = F.min_by("store_id", at), F.max_by("store_id", at)
    return pos.groupBy("user_id").agg(first.alias("first_purchase_store_pos"),
                                      last.alias("last_purchase_store_pos"))


def customer_profile(users: DataFrame, line_members: DataFrame, orders: DataFrame,
                     loyalty: DataFrame, as_of: str, unique_orders: bool = False) -> DataFrame:
    """Users with lifetime value, RFM, first and last store, the newest messenger
    row and the newest loyalty row. With unique order ids all order figures come
    from one aggregation."""
    line = latest_per_key(line_members, ["line_member_id"], ["updated_date"], ["line_system_id"]).select(
        "line_member_id", "notification_allowed_flg", "is_blocked_flg", "is_friend_flg")
    points = latest_per_key(loyalty, ["user_id"], ["updated_date"], ["point_id"]).select(
        "user_id", "member_rank", "point_balance")
    if unique_orders:
        pos_store = F.when(_in("POS"), F.col("store_id"))
        figures = _with_rfm(orders.groupBy("user_id").agg(
            *_ltv_aggs(as_of), *_rfm_aggs(), F.min(pos_store).alias("first_purchase_store_pos"),
            F.max(pos_store).alias("last_purchase_store_pos")), as_of)
    else:
        figures = ltv(orders, as_of).join(rfm_measures(orders, as_of), "user_id").join(
            first_last_store(orders), "user_id", "left")
    return (
        users.join(figures, "user_id", "left").join(line, "line_member_id", "left")
        .join(points, "user_id", "left")
    )


def _lost_items(carts: DataFrame, items: DataFrame) -> DataFrame:
    return carts.filter(F.col("status") == 0).select("cart_id", "user_id").join(items, "cart_id")


def abandoned_carts(carts: DataFrame, items: DataFrame) -> DataFrame:
    """Per user: last cart, last abandoned date, and how many available and how
    many items in all are left in abandoned carts. Only abandoned carts meet
    their items."""
    per_user = carts.groupBy("user_id").agg(
        F.max("cart_id").alias("last_cart_id"),
        F.max(F.when(F.col("status") == 0, F.col("updated_date"))).alias("last_cart_abandoned_date"))
    counts = {"abandoned_cart_available_item_count": F.count_distinct(
                  F.when(F.col("item_status") == 1, F.col("cart_item_id"))),
              "abandoned_cart_item_count": F.count("cart_item_id")}
    left = _lost_items(carts, items).groupBy("user_id").agg(*[c.alias(n) for n, c in counts.items()])
    return per_user.join(left, "user_id", "left").na.fill(0, list(counts))


def abandoned_cart_lists(carts: DataFrame, items: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """The items of a user's abandoned carts as JSON, sorted by item, per user and part.

    Every user with a cart has a part 0, an empty list if nothing was left in it.
    """
    entry = F.struct(F.col("cart_item_id").alias("item_id"), "quantity", F.col("unit_price").alias("price"))
    parts = collect_parts(_lost_items(carts, items), ["user_id"], entry, ["cart_item_id"], max_bytes, "_items")
    everyone = carts.select("user_id").distinct()
    return null_safe_join(everyone, parts, ["user_id"], "left").select(
        "user_id", F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce(F.to_json("_items"), F.lit("[]")).alias("abandoned_cart_item_list"))


def latest_survey(survey: DataFrame) -> DataFrame:
    """Each user's newest answer."""
    newest = latest_per_key(survey, ["user_id"], ["response_date"], ["response_id"])
    return newest.select(
        "user_id", F.col("survey_category").alias("last_survey_category"),
        F.col("response_content").alias("last_survey_response"),
        F.col("response_date").alias("last_survey_date"),
        F.col("positive_score").alias("last_survey_positive_score"))


def recency_segment(c: Column | str) -> Column:
    return bucketize(c, L.RECENCY_EDGES, L.RECENCY_LABELS, right_closed=True)


def frequency_segment(c: Column | str) -> Column:
    return ranges_label(c, L.FREQUENCY_RANGES, L.FREQUENCY_DEFAULT)


def monetary_segment(c: Column | str) -> Column:
    return bucketize(c, L.MONETARY_EDGES, L.MONETARY_LABELS)


def rfm_segments(measures: DataFrame) -> DataFrame:
    """The nine segment labels: R, F and M for all, POS and EC."""
    out = {}
    for name in SCOPES:
        out[f"r_recency_segment_{name}"] = recency_segment(f"r_days_since_last_purchase_{name}")
        out[f"f_frequency_segment_{name}"] = frequency_segment(f"f_purchase_count_{name}")
        out[f"m_monetary_segment_{name}"] = monetary_segment(f"m_average_order_value_{name}")
    return measures.withColumns(out)


def favourite(items: DataFrame, how: str = "max") -> DataFrame:
    """Favourite category per user and channel scope.

    ``how="max"`` is the alphabetically last category, ``how="mode"`` the most
    frequent one (ties by name).
    """
    per_cat = items.groupBy("user_id", "channel", "category_name").agg(F.count(F.lit(1)).alias("n"))
    aggs = []
    if how == "max":
        aggs = [F.max(F.when(_in(ch), F.col("category_name"))).alias(f"frequent_item_category_{n}")
                for n, ch in SCOPES.items()]
        return per_cat.groupBy("user_id").agg(*aggs)
    both = per_cat.groupBy("user_id", "category_name").agg(*[
        F.sum(F.when(_in(ch), F.col("n"))).alias(f"_{n}") for n, ch in SCOPES.items()])
    return both.groupBy("user_id").agg(*[
        F.max(F.when(F.col(f"_{n}").isNotNull(), F.struct(f"_{n}", "category_name")))["category_name"].alias(
            f"frequent_item_category_{n}") for n in SCOPES])


def channel_of(df: DataFrame) -> DataFrame:
    """First and last purchase channel from the channel dates.

    A user with no EC date counts as POS, also when the POS date is missing.
    """
    no_ec_first = F.col("first_purchase_date_ec").isNull()
    no_ec_last = F.col("last_purchase_date_ec").isNull()
    first_pos = F.coalesce(F.col("first_purchase_date_pos") <= F.col("first_purchase_date_ec"), F.lit(False))
    last_pos = F.coalesce(F.col("last_purchase_date_pos") >= F.col("last_purchase_date_ec"), F.lit(False))
    return df.withColumns({
        "first_purchase_channel": F.when(first_pos | no_ec_first, "POS").otherwise("EC"),
        "last_purchase_channel": F.when(last_pos | no_ec_last, "POS").otherwise("EC"),
    })


def gold_users(users: DataFrame, line_members: DataFrame, orders: DataFrame, items: DataFrame,
               loyalty: DataFrame, carts: DataFrame, cart_items: DataFrame, survey: DataFrame,
               as_of: str, unique_orders: bool = False) -> DataFrame:
    """The complete customer-360 row per user.

    The items left in carts are counted here; their lists are the child table
    :func:`abandoned_cart_lists`.
    """
    base = customer_profile(users, line_members, orders, loyalty, as_of, unique_orders)
    base = rfm_segments(channel_of(base))
    return (
        base.join(abandoned_carts(carts, cart_items), "user_id", "left")
        .join(latest_survey(survey), "user_id", "left")
        .join(favourite(items), "user_id", "left")
        .withColumn("last_survey_positive_score",
                    F.round(F.col("last_survey_positive_score").cast("decimal(20,6)"), 2).cast("decimal(10,2)"))
    )


def user_category_metrics(users: DataFrame, tx: DataFrame, feedback: DataFrame,
                          groups: dict[str, list[str]], other: str = "other",
                          fanout_safe: bool = True) -> DataFrame:
    """Quantity and mean rating per user and category group, with the age group.

    ``groups`` maps a group name to its categories; every further category
    belongs to ``other``. Transactions and feedback are summed per user before
    they meet. ``fanout_safe=False`` gives the figures of a plain join of both
    (each quantity counted once per feedback row), by arithmetic.
    """
    named = [c for cats in groups.values() for c in cats]
    tests = {g: F.col("category").isin(*cats) for g, cats in groups.items()}
    tests[other] = ~F.col("category").isin(*named)
    bought = tx.groupBy("user_id").agg(
        *[F.sum(F.when(t, F.col("quantity")).otherwise(0)).alias(f"{g}_quantity") for g, t in tests.items()],
        *[F.count(F.when(t, 1)).alias(f"_{g}_tx") for g, t in tests.items()])
    out = users.join(bought, "user_id", "left")
    if fanout_safe:
        rated = feedback.groupBy("user_id").agg(*[
            F.avg(F.when(t, F.col("rating"))).alias(f"{g}_rating") for g, t in tests.items()])
        out = out.join(rated, "user_id", "left")
        out = out.withColumns({f"{g}_quantity": F.coalesce(f"{g}_quantity", F.lit(0)) for g in tests})
    else:
        rated = feedback.groupBy("user_id").agg(F.avg("rating").alias("_rating"),
                                                F.count(F.lit(1)).alias("_n_fb"))
        out = out.join(rated, "user_id", "left")
        times = F.greatest(F.coalesce("_n_fb", F.lit(1)), F.lit(1))
        out = out.withColumns({f"{g}_quantity": F.coalesce(f"{g}_quantity", F.lit(0)) * times for g in tests})
        out = out.withColumns({f"{g}_rating": F.when(F.col(f"_{g}_tx") > 0, F.col("_rating")) for g in tests})
    keep = [c for c in out.columns if not c.startswith("_")]
    return out.select(*keep, bucketize("age", L.AGE_EDGES, L.AGE_LABELS).alias("age_group"))


def reach_rates(users: DataFrame, line_members: DataFrame) -> DataFrame:
    """Share of users linked to the messenger, having blocked it, being friends."""
    seen = users.join(line_members.select("line_member_id", "is_blocked_flg", "is_friend_flg"),
                      "line_member_id", "left")

    def share(test: Column) -> Column:
        n = F.sum(F.coalesce(test, F.lit(False)).cast("int"))
        return F.round((n / F.count(F.lit(1))).cast("decimal(20,10)"), 2).cast("double")

    return seen.agg(
        share(F.col("line_member_id").isNotNull()).alias("line_member_id_ratio"),
        share(F.col("is_blocked_flg") == 1).alias("line_is_blocked_ratio"),
        share(F.col("is_friend_flg") == 1).alias("line_is_friend_ratio"))

