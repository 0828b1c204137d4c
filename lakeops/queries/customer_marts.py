"""2.12 customer-360, RFM and order marts."""

from pyspark.sql import functions as F

from lakeops.functions.columns import flag, status_code
from lakeops.operators.aggregates import distribution, duplicates
from lakeops.operators.joins import ratio_within_group
from lakeops.operators.numbering import following_pairs
from lakeops.plans import customers as CU
from lakeops.plans import orders as OR
from lakeops.queries.registry import AS_OF, query
from lakeops.queries.sql import frequency, money, money_if, order_value, recency

_POS, _EC = "channel = 'POS'", "channel = 'EC'"
_SCOPES = {"all": "TRUE", "pos": _POS, "ec": _EC}

_LTV = f"""SELECT user_id, {money_if(_POS, 'total_amount')} AS ltv_pos, {money_if(_EC, 'total_amount')} AS ltv_ec,
    {money('total_amount')} AS ltv_all_time,
    {money_if(f"order_date >= DATE '{AS_OF}' - 365", 'total_amount')} AS ltv_last_year,
    {money_if(f"order_date >= DATE '{AS_OF}' - 730", 'total_amount')} AS ltv_last_two_years FROM {{sales}} GROUP BY user_id"""

_RFM = "SELECT user_id, " + ", ".join(f"""
    max(order_date) FILTER ({c}) AS last_purchase_date_{s}, min(order_date) FILTER ({c}) AS first_purchase_date_{s},
    count(DISTINCT order_id) FILTER ({c}) AS f_purchase_count_{s},
    CAST(date_diff('day', max(order_date) FILTER ({c}), DATE '{AS_OF}') AS INTEGER) AS r_days_since_last_purchase_{s},
    coalesce({money_if(c, 'total_amount')} / nullif(count(DISTINCT order_id) FILTER ({c}), 0), 0) AS m_average_order_value_{s}"""
    for s, c in _SCOPES.items()) + " FROM {sales} GROUP BY user_id"

_SEGMENTS = ", ".join(
    f"{recency(f'r_days_since_last_purchase_{s}')} AS r_recency_segment_{s}, "
    f"{frequency(f'f_purchase_count_{s}')} AS f_frequency_segment_{s}, "
    f"{order_value(f'm_average_order_value_{s}')} AS m_monetary_segment_{s}" for s in _SCOPES)

_CHANNEL = ", ".join(
    f"if(coalesce({w}_purchase_date_pos {op} {w}_purchase_date_ec, {w}_purchase_date_ec IS NULL), 'POS', 'EC') AS {w}_purchase_channel"
    for w, op in (("first", "<="), ("last", ">=")))

# The store of a POS order is the store of its lines with the smallest id.
_STORE_ORDERS = """SELECT s.*, CASE WHEN channel = 'POS' THEN store_id END AS store_id FROM {sales} s
    LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS store_id FROM lineitem GROUP BY ALL) ON l_orderkey = order_id"""
_STORES_BY_ID = f"""SELECT user_id, min(store_id) AS first_purchase_store_pos, max(store_id) AS last_purchase_store_pos
    FROM ({_STORE_ORDERS}) WHERE channel = 'POS' GROUP BY user_id"""

# Stand-ins for the messenger accounts and the loyalty history: customers and their events.
_LINE = """SELECT event_id AS line_system_id, user_id AS line_member_id, CAST(event_type = 'click' AS INTEGER) AS notification_allowed_flg,
    CAST(event_type = 'error' AS INTEGER) AS is_blocked_flg, CAST(event_type = 'signup' AS INTEGER) AS is_friend_flg,
    CAST(ts AS DATE) AS updated_date FROM events"""
_LOYALTY = """SELECT event_id AS point_id, user_id, value AS point_balance, event_type AS member_rank, CAST(ts AS DATE) AS updated_date FROM events"""
_LATEST_LINE = f"""SELECT line_member_id, notification_allowed_flg, is_blocked_flg, is_friend_flg FROM ({_LINE})
    QUALIFY row_number() OVER (PARTITION BY line_member_id ORDER BY updated_date DESC, line_system_id DESC) = 1"""
_LATEST_LOYALTY = f"""SELECT user_id, member_rank, point_balance FROM ({_LOYALTY})
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY updated_date DESC, point_id DESC) = 1"""
_USERS = "SELECT *, user_id AS line_member_id FROM {users}"

_PROFILE = f"""SELECT u.*, l.* EXCLUDE (user_id), r.* EXCLUDE (user_id), st.* EXCLUDE (user_id), m.* EXCLUDE (line_member_id), p.* EXCLUDE (user_id)
    FROM ({_USERS}) u LEFT JOIN ({_LTV}) l ON u.user_id = l.user_id LEFT JOIN ({_RFM}) r ON u.user_id = r.user_id
    LEFT JOIN ({_STORES_BY_ID}) st ON u.user_id = st.user_id LEFT JOIN ({_LATEST_LINE}) m ON u.line_member_id = m.line_member_id
    LEFT JOIN ({_LATEST_LOYALTY}) p ON u.user_id = p.user_id"""

# Carts are orders; an open order is an abandoned cart, an item is available unless returned.
_CARTS = "SELECT order_id AS cart_id, user_id, CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS status, order_date AS updated_date FROM {sales}"
_CART_ITEMS = """SELECT order_id AS cart_id, order_item_id AS cart_item_id, quantity, subtotal AS unit_price,
    CASE WHEN cancel_flg THEN 0 ELSE 1 END AS item_status FROM {lines}"""
_ABANDONED = f"""SELECT user_id, max(c.cart_id) AS last_cart_id, max(updated_date) FILTER (status = 0) AS last_cart_abandoned_date,
    count(DISTINCT cart_item_id) FILTER (status = 0 AND item_status = 1) AS abandoned_cart_available_item_count,
    count(cart_item_id) FILTER (status = 0) AS abandoned_cart_item_count
    FROM ({_CARTS}) c LEFT JOIN ({_CART_ITEMS}) i ON c.cart_id = i.cart_id GROUP BY user_id"""
_SURVEY = """SELECT user_id, survey_category AS last_survey_category, response_content AS last_survey_response,
    response_date AS last_survey_date, positive_score AS last_survey_positive_score FROM {survey}
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY response_date DESC, response_id DESC) = 1"""
_CATEGORY_LINES = "SELECT l.*, category_name FROM {lines} l JOIN {items} i ON l.item_id = i.item_id"
_FAVOURITE = f"""SELECT user_id, max(category_name) AS frequent_item_category_all,
    max(category_name) FILTER (channel = 'POS') AS frequent_item_category_pos,
    max(category_name) FILTER (channel = 'EC') AS frequent_item_category_ec FROM ({_CATEGORY_LINES}) GROUP BY user_id"""


def _store_orders(t):
    first = t.lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("_store"))
    return t.sales.join(first, F.col("order_id") == F.col("l_orderkey"), "left").withColumn(
        "store_id", F.when(F.col("channel") == "POS", F.col("_store"))).drop("l_orderkey", "_store")


def _line(t):
    return t.events.select(
        F.col("event_id").alias("line_system_id"), F.col("user_id").alias("line_member_id"),
        flag(F.col("event_type") == "click").alias("notification_allowed_flg"),
        flag(F.col("event_type") == "error").alias("is_blocked_flg"),
        flag(F.col("event_type") == "signup").alias("is_friend_flg"), F.to_date("ts").alias("updated_date"))


def _loyalty(t):
    return t.events.select(F.col("event_id").alias("point_id"), "user_id", F.col("value").alias("point_balance"),
                           F.col("event_type").alias("member_rank"), F.to_date("ts").alias("updated_date"))


def _users(t):
    return t.users.withColumn("line_member_id", F.col("user_id"))


def _carts(t):
    return t.sales.select(F.col("order_id").alias("cart_id"), "user_id",
                          status_code("o_orderstatus", {"O": 0}, 1).alias("status"),
                          F.col("order_date").alias("updated_date"))


def _cart_items(t):
    return t.lines.select(F.col("order_id").alias("cart_id"), F.col("order_item_id").alias("cart_item_id"), "quantity",
                          F.col("subtotal").alias("unit_price"), (1 - flag("cancel_flg")).alias("item_status"))


def _category_lines(t):
    return t.lines.join(t.items.select("item_id", "category_name"), "item_id")


@query("c1_lifetime_value", _LTV)
def c1(t):
    return CU.ltv(t.sales, AS_OF)


@query("c2_rfm_measures", _RFM)
def c2(t):
    return CU.rfm_measures(t.sales, AS_OF, unique_orders=True)


@query("c2_rfm_measures_repeated_ids", _RFM)
def c2_repeated(t):
    return CU.rfm_measures(t.sales, AS_OF)


@query("c3_store_by_id", _STORES_BY_ID)
def c3(t):
    return CU.first_last_store(_store_orders(t))


@query("c3_store_by_date", f"""
    SELECT user_id, arg_min_null(store_id, (order_date, order_id)) AS first_purchase_store_pos,
           arg_max_null(store_id, (order_date, order_id)) AS last_purchase_store_pos FROM ({_STORE_ORDERS})
    WHERE channel = 'POS' GROUP BY user_id""")
def c3_date(t):
    return CU.first_last_store(_store_orders(t), by="date")


@query("c4_customer_profile", _PROFILE)
def c4(t):
    return CU.customer_profile(_users(t), _line(t), _store_orders(t), _loyalty(t), AS_OF, unique_orders=True)


@query("c5_abandoned_carts", _ABANDONED)
def c5(t):
    return CU.abandoned_carts(_carts(t), _cart_items(t))


@query("c5_abandoned_cart_lists", f"""
    SELECT c.user_id, CAST(0 AS BIGINT) AS part, count(i.cart_item_id) AS n_items, coalesce(sum(quantity), 0) AS quantity
    FROM ({_CARTS}) c LEFT JOIN ({_CART_ITEMS}) i ON c.cart_id = i.cart_id AND status = 0 GROUP BY c.user_id""")
def c5_lists(t):
    lists = CU.abandoned_cart_lists(_carts(t), _cart_items(t))
    back = F.from_json("abandoned_cart_item_list", "array<struct<item_id:bigint,quantity:double,price:double>>")
    return lists.select("user_id", "part", back.alias("l")).select(
        "user_id", "part", F.size("l").cast("bigint").alias("n_items"),
        F.aggregate("l.quantity", F.lit(0.0), lambda a, x: a + x).alias("quantity"))


@query("c6_latest_survey", _SURVEY)
def c6(t):
    return CU.latest_survey(t.survey)


@query("c7_rfm_segments", f"SELECT *, {_SEGMENTS} FROM ({_RFM})")
def c7(t):
    return CU.rfm_segments(CU.rfm_measures(t.sales, AS_OF, unique_orders=True))


@query("c8_favourite_by_name", _FAVOURITE)
def c8(t):
    return CU.favourite(_category_lines(t))


@query("c8_favourite_by_count", f"""
    WITH l AS ({_CATEGORY_LINES}), n AS (
      SELECT user_id, category_name, count(*) AS a, count(*) FILTER (channel = 'POS') AS p, count(*) FILTER (channel = 'EC') AS e
      FROM l GROUP BY ALL)
    SELECT user_id, arg_max(category_name, (a, category_name)) AS frequent_item_category_all,
           arg_max(category_name, (p, category_name)) FILTER (p > 0) AS frequent_item_category_pos,
           arg_max(category_name, (e, category_name)) FILTER (e > 0) AS frequent_item_category_ec FROM n GROUP BY user_id""")
def c8_mode(t):
    return CU.favourite(_category_lines(t), how="mode")


@query("c9_first_last_channel", f"SELECT user_id, {_CHANNEL} FROM ({_RFM})")
def c9(t):
    return CU.channel_of(CU.rfm_measures(t.sales, AS_OF, unique_orders=True)).select(
        "user_id", "first_purchase_channel", "last_purchase_channel")


@query("c10_gold_users", f"""
    SELECT b.*, {_CHANNEL}, {_SEGMENTS}, a.* EXCLUDE (user_id), f.* EXCLUDE (user_id), s.last_survey_category,
           s.last_survey_response, s.last_survey_date, CAST(round(CAST(s.last_survey_positive_score AS DECIMAL(20,6)), 2) AS DOUBLE)
             AS last_survey_positive_score
    FROM ({_PROFILE}) b LEFT JOIN ({_ABANDONED}) a ON b.user_id = a.user_id LEFT JOIN ({_SURVEY}) s ON b.user_id = s.user_id
    LEFT JOIN ({_FAVOURITE}) f ON b.user_id = f.user_id""")
def c10(t):
    gold = CU.gold_users(_users(t), _line(t), _store_orders(t), _category_lines(t), _loyalty(t), _carts(t), _cart_items(t),
                         t.survey, AS_OF, unique_orders=True)
    return gold.withColumn(
        "last_survey_positive_score", F.col("last_survey_positive_score").cast("double"))


@query("c10_gold_users_duplicates", f"SELECT user_id, count(*) AS n FROM {{users}} GROUP BY user_id")
def c10_dup(t):
    gold = CU.gold_users(_users(t), _line(t), _store_orders(t), _category_lines(t), _loyalty(t), _carts(t), _cart_items(t),
                         t.survey, AS_OF, unique_orders=True)
    return gold.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("c11_silver_order_lines", """
    SELECT order_item_id, l.order_id, l.user_id, l.store_id, item_id, quantity, subtotal, CAST(0 AS INTEGER) AS cancel_flg, l.order_date,
           o_orderstatus, name, pref, store_name, store_area
    FROM {lines} l LEFT JOIN {sales} o ON l.order_id = o.order_id LEFT JOIN {users} u ON l.user_id = u.user_id
    LEFT JOIN {stores} s ON l.store_id = s.store_id WHERE NOT cancel_flg""")
def c11(t):
    lines = t.lines.drop("ship_date", "channel")
    return OR.silver_order_items(lines, t.users.select("user_id", "name", "pref"), t.sales.select("order_id", "o_orderstatus"),
                                 t.store_dim.drop("prefecture"))


@query("c12_silver_orders", f"""
    SELECT o.order_id, o.user_id, channel, total_amount, order_date, o_orderstatus, o_orderpriority, o.store_id,
           CAST(0 AS INTEGER) AS cancel_flg, name, pref, store_name, store_area
    FROM ({_STORE_ORDERS}) o LEFT JOIN {{users}} u ON o.user_id = u.user_id LEFT JOIN {{stores}} s ON o.store_id = s.store_id
    WHERE o_orderstatus <> 'P'""")
def c12(t):
    orders = _store_orders(t).withColumn("cancel_flg", F.col("o_orderstatus") == "P")
    return OR.silver_orders(orders, t.users.select("user_id", "name", "pref"), t.store_dim.drop("prefecture"))


@query("c13_silver_members", f"SELECT DISTINCT * FROM ({_LINE})")
def c13_members(t):
    return _line(t).distinct()


@query("c13_silver_carts", _CARTS)
def c13_carts(t):
    return _carts(t)


# Online rows have no store; their stock lookup matches nothing, as store-less stock does not exist.
_GOLD_LINES = f"""
    WITH base AS (SELECT order_item_id, order_id, user_id, item_id, category_name, quantity, subtotal, order_date,
                         CASE WHEN channel = 'POS' THEN store_id END AS store_id, channel AS purchase_channel
                  FROM ({_CATEGORY_LINES}) WHERE NOT cancel_flg),
    stock AS (SELECT * FROM {{inventory}}
              QUALIFY row_number() OVER (PARTITION BY store_id, item_id ORDER BY inventory_date DESC, stock_quantity DESC) = 1),
    logs AS (SELECT user_id AS log_user, date_add(DATE '1998-01-01', CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER))::DATE AS event_date,
                    arg_max(event_type, (ts, event_id)) AS event_type,
                    arg_max(CAST(event_id AS VARCHAR), (ts, event_id)) AS session_id, count(*) AS n FROM events GROUP BY ALL)
    SELECT base.*, p.point_balance AS points_earned, p.member_rank, CASE WHEN stock.inventory_date <= order_date THEN stock.stock_quantity END
             AS stock_quantity, logs.event_type, logs.session_id, coalesce(logs.n, 0) AS n_logs,
           lag(order_date) OVER w IS NOT NULL AS is_repeat_purchase,
           CAST(date_diff('day', lag(order_date) OVER w, order_date) AS INTEGER) AS days_since_last_purchase,
           sv.last_survey_category, u.name, u.pref
    FROM base LEFT JOIN ({_LATEST_LOYALTY}) p ON base.user_id = p.user_id
    LEFT JOIN stock ON base.item_id = stock.item_id AND base.store_id = stock.store_id
    LEFT JOIN logs ON base.user_id = log_user AND order_date = event_date AND purchase_channel = 'EC'
    LEFT JOIN ({_SURVEY}) sv ON base.user_id = sv.user_id LEFT JOIN {{users}} u ON base.user_id = u.user_id
    WINDOW w AS (PARTITION BY base.user_id, base.item_id ORDER BY order_date, order_item_id, subtotal)"""


def _gold_lines(t, true_asof=False):
    # Both channels read the same columns of the lines, so that Spark shuffles the lines once for the two.
    lines = _category_lines(t).filter("NOT cancel_flg").select(
        "order_item_id", "order_id", "user_id", "item_id", "category_name", "quantity", "subtotal", "order_date",
        F.when(F.col("channel") == "POS", F.col("store_id")).alias("store_id"), "channel")
    pos = lines.filter("channel = 'POS'").drop("channel")
    ec = lines.filter("channel = 'EC'").drop("channel")
    # The event log is moved to the years of the orders, so that days can meet.
    shift = F.date_add(F.lit("1998-01-01").cast("date"), F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")))
    logs = t.events.select(F.col("user_id").alias("log_user"), shift.alias("event_date"), F.col("ts").alias("event_ts"),
                           F.col("event_id").alias("log_id"), "event_type", F.col("event_id").cast("string").alias("session_id"))
    return OR.gold_order_items(pos, ec, _loyalty(t), t.inventory, logs, t.survey, t.users.select("user_id", "name", "pref"), true_asof)


@query("c14_gold_order_lines", _GOLD_LINES)
def c14(t):
    return _gold_lines(t)


@query("c15_gold_orders", f"""
    SELECT order_id, sum(quantity) AS order_quantity, {money('subtotal')} AS order_amount,
           min(user_id) AS user_id, min(order_date) AS order_date, count(*) AS n_details, sum(quantity) AS details_quantity
    FROM {{lines}} WHERE NOT cancel_flg GROUP BY order_id""")
def c15(t):
    items = _gold_items(t)
    lines = OR.gold_order_details(items).groupBy("order_id").agg(
        F.sum(F.size("order_details")).alias("n_details"),
        F.sum(F.aggregate("order_details.quantity", F.lit(0.0), lambda a, x: a + x)).alias("details_quantity"))
    return OR.gold_orders(items, ["user_id", "order_date"]).join(lines, "order_id")


def _gold_items(t):
    return _category_lines(t).filter("NOT cancel_flg").withColumn("unit_price", F.col("subtotal") / F.col("quantity"))


@query("c15_gold_order_details", f"""
    SELECT order_id, CAST(0 AS BIGINT) AS part, order_item_id, item_id, category_name, quantity, subtotal / quantity AS unit_price
    FROM ({_CATEGORY_LINES}) WHERE NOT cancel_flg""")
def c15_details(t):
    lines = OR.gold_order_details(_gold_items(t)).select("order_id", "part", F.explode("order_details").alias("d"))
    return lines.select("order_id", "part", "d.order_item_id", "d.item_id", "d.category_name", "d.quantity", "d.unit_price")


_FEEDBACK = """SELECT user_id, CASE event_type WHEN 'view' THEN 'SMALL' WHEN 'click' THEN 'LARGE' ELSE 'PROMO' END AS category,
    CAST(event_id % 5 + 1 AS DOUBLE) AS rating FROM events"""
_AGED = "SELECT user_id, CAST(18 + user_id % 60 AS BIGINT) AS age FROM {users}"


def _feedback(t):
    cat = F.when(F.col("event_type") == "view", "SMALL").when(F.col("event_type") == "click", "LARGE").otherwise("PROMO")
    return t.events.select("user_id", cat.alias("category"), (F.col("event_id") % 5 + 1).cast("double").alias("rating"))


def _aged(t):
    return t.users.select("user_id", (F.col("user_id") % 60 + 18).alias("age"))


def _tx(t):
    return _category_lines(t).select("user_id", F.col("category_name").alias("category"), "quantity")


_GROUPS = {"small": ["SMALL"], "large": ["LARGE"]}
_AGE_GROUP = "CASE WHEN age < 35 THEN '若年層' WHEN age < 55 THEN '中年層' ELSE 'シニア層' END AS age_group"


@query("c16_user_category_metrics", f"""
    SELECT u.user_id, age, {_AGE_GROUP}, coalesce(small_quantity, 0) AS small_quantity, coalesce(large_quantity, 0) AS large_quantity,
           coalesce(other_quantity, 0) AS other_quantity, small_rating, large_rating, other_rating
    FROM ({_AGED}) u LEFT JOIN (
      SELECT user_id, coalesce(sum(quantity) FILTER (category_name = 'SMALL'), 0) AS small_quantity,
             coalesce(sum(quantity) FILTER (category_name = 'LARGE'), 0) AS large_quantity,
             coalesce(sum(quantity) FILTER (category_name NOT IN ('SMALL', 'LARGE')), 0) AS other_quantity
      FROM ({_CATEGORY_LINES}) GROUP BY user_id) q ON u.user_id = q.user_id LEFT JOIN (
      SELECT user_id, avg(rating) FILTER (category = 'SMALL') AS small_rating,
             avg(rating) FILTER (category = 'LARGE') AS large_rating,
             avg(rating) FILTER (category NOT IN ('SMALL', 'LARGE')) AS other_rating
      FROM ({_FEEDBACK}) GROUP BY user_id) f ON u.user_id = f.user_id""")
def c16(t):
    return CU.user_category_metrics(_aged(t), _tx(t), _feedback(t), _GROUPS)


@query("c16_user_category_metrics_fanout", f"""
    SELECT u.user_id, age, {_AGE_GROUP}, coalesce(sum(quantity) FILTER (category_name = 'SMALL'), 0) AS small_quantity,
           coalesce(sum(quantity) FILTER (category_name = 'LARGE'), 0) AS large_quantity,
           coalesce(sum(quantity) FILTER (category_name NOT IN ('SMALL', 'LARGE')), 0) AS other_quantity,
           avg(rating) FILTER (category_name = 'SMALL') AS small_rating,
           avg(rating) FILTER (category_name = 'LARGE') AS large_rating,
           avg(rating) FILTER (category_name NOT IN ('SMALL', 'LARGE')) AS other_rating
    FROM ({_AGED}) u LEFT JOIN ({_CATEGORY_LINES}) l ON u.user_id = l.user_id LEFT JOIN ({_FEEDBACK}) f ON u.user_id = f.user_id
    GROUP BY u.user_id, age""")
def c16_fanout(t):
    return CU.user_category_metrics(_aged(t), _tx(t), _feedback(t), _GROUPS, fanout_safe=False)


@query("c17_category_ratio_by_region", f"""
    SELECT area, category_name, total_sales, total_sales * 100 / CAST(sum(CAST(total_sales AS DECIMAL(18,2)))
             OVER (PARTITION BY area) AS DOUBLE) AS sales_ratio
    FROM (SELECT area, category_name, {money('subtotal')} AS total_sales
          FROM ({_CATEGORY_LINES}) l JOIN {{users}} u ON l.user_id = u.user_id GROUP BY ALL)""")
def c17(t):
    return ratio_within_group(_category_lines(t).join(t.users, "user_id"), "area", "category_name", "subtotal")


@query("c18_reach_rates", f"""
    SELECT CAST(round(CAST(count(u.line_member_id) / count(*) AS DECIMAL(20,10)), 2) AS DOUBLE) AS line_member_id_ratio,
           CAST(round(CAST(count(*) FILTER (is_blocked_flg = 1) / count(*) AS DECIMAL(20,10)), 2) AS DOUBLE) AS line_is_blocked_ratio,
           CAST(round(CAST(count(*) FILTER (is_friend_flg = 1) / count(*) AS DECIMAL(20,10)), 2) AS DOUBLE) AS line_is_friend_ratio
    FROM ({_USERS}) u LEFT JOIN ({_LINE}) l ON u.line_member_id = l.line_member_id""")
def c18(t):
    return CU.reach_rates(_users(t), _line(t))


@query("c19_priority_mix", """
    SELECT o_orderpriority, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS share FROM orders GROUP BY ALL""")
def c19(t):
    return distribution(t.orders, "o_orderpriority")


@query("c21_rule_scores", """
    SELECT order_item_id, greatest(0, least(45, quantity + CASE WHEN category_name = 'SMALL' THEN 2 ELSE 0 END
             + CASE WHEN area = 'ASIA' AND category_name = 'LARGE' THEN 5 ELSE 0 END
             + CASE WHEN segment = 'MACHINERY' THEN -10 ELSE 0 END)) AS quantity
    FROM {lines} l JOIN {items} i ON l.item_id = i.item_id JOIN {users} u ON l.user_id = u.user_id""")
def c21(t):
    lines = t.lines.join(t.items, "item_id").join(t.users, "user_id")
    rules = [("category_name = 'SMALL'", 2), ("area = 'ASIA' AND category_name = 'LARGE'", 5), ("segment = 'MACHINERY'", -10)]
    return OR.apply_rules(lines, "quantity", rules, 0, 45).select("order_item_id", "quantity")


@query("c22_funnel", """
    SELECT source, target, count(*) AS weight FROM (
      SELECT CAST(o_orderpriority AS VARCHAR) AS source, lead(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS target
      FROM orders) WHERE target IS NOT NULL GROUP BY ALL""")
def c22(t):
    return following_pairs(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderpriority")


@query("c4_profile_duplicates", "SELECT user_id, count(*) AS count FROM events GROUP BY user_id HAVING count(*) > 1")
def c4_dup(t):
    return duplicates(t.events, ["user_id"])
