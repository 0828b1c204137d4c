"""2.14 recommendation. Users take items by ordering them; a store's nation
number serves as its section, a customer's nation number as the seat."""

from pyspark.sql import functions as F

from lakeops.operators.sets import top_k
from lakeops.plans import recommend as RC
from lakeops.plans.inner_products import items_above
from lakeops.queries.registry import query
from lakeops.session import work_dir
from lakeops.sources.writers import with_known_size, write_table

_RATINGS = "SELECT user_id, item_id, count(*) AS rating FROM {lines} GROUP BY ALL"
# A fixed score table in place of a trained model.
_SCORES = """SELECT user_id, item_id, CAST(sum(quantity) AS DOUBLE) AS rating FROM {lines} GROUP BY ALL"""


def _ratings(t):
    return RC.ratings_from_counts(t.lines, "user_id", "item_id")


def _scores(t):
    return t.lines.groupBy("user_id", "item_id").agg(F.sum("quantity").alias("rating"))


def _typed_ratings(t):
    return _ratings(t).select(F.col("user_id").cast("int").alias("user_id"), F.col("item_id").cast("int").alias("item_id"),
                              F.col("rating").cast("float").alias("rating"))


def _trained(ratings):
    return RC.train_als(ratings, "user_id", "item_id", seed=0)


def _model_only(t):
    # Training plans its ratings twice; nothing reads them after it, so they are kept in memory until then and not written.
    ratings = _typed_ratings(t).persist()
    model = _trained(ratings)
    ratings.unpersist()
    return model


def _model(t):
    # Training and the checks after it read the ratings several times; the lines are joined and counted once.
    ratings = write_table(_typed_ratings(t), work_dir(t.spark, "ratings"))
    return ratings, _trained(ratings)


@query("rc1_ratings_from_counts", _RATINGS)
def rc1(t):
    return _ratings(t)


@query("rc2_ratings_from_ratio", """
    SELECT user_id, item_id, CAST(sum(CAST(round(least(quantity / 25, 1) * 1000000) AS BIGINT)) AS DOUBLE) / 1000000 AS rating
    FROM {lines} GROUP BY ALL HAVING sum(quantity) > 0""")
def rc2(t):
    return RC.ratings_from_ratio(t.lines.withColumn("full", F.lit(25.0)), "user_id", "item_id", "quantity", "full")


def _dot(model, pairs):
    """Scores of (user_id, item_id) pairs, computed anew from the factors.

    The pairs end up by user, so what is summed or joined per user after it needs no further shuffle.
    """
    users = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("item_id"), F.col("features").alias("i"))
    product = F.aggregate(F.zip_with("u", "i", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda a, x: a + x)
    return pairs.join(items, "item_id").join(users, "user_id").withColumn("score", product).drop("u", "i")


def _norm(features):
    return F.sqrt(F.aggregate(features, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def _reaching(model, pairs, last):
    """The (user_id, item_id) pairs that may score above the last entry of the user's list.

    A score is at most the product of the norms. An item below the least norm that any user needs is out at once;
    the others meet what their user needs. Only norms are shuffled with the pairs, no factors.
    """
    needs = with_known_size(last.join(model.userFactors.select(F.col("id").alias("user_id"), "features"), "user_id").select(
        "user_id", F.coalesce(F.try_divide(_limit(), _norm("features") * (1 + 1e-9)), F.lit(0.0)).alias("need")))
    lowest = needs.agg(F.min("need")).first()[0]
    strong = with_known_size(model.itemFactors.select(F.col("id").alias("item_id"), _norm("features").alias("norm")).filter(F.col("norm") >= F.lit(lowest)))
    return pairs.join(strong, "item_id").join(needs, "user_id").filter(F.col("norm") >= F.col("need")).select("user_id", "item_id")


def _same(a, b):
    return F.abs(F.col(a) - F.col(b)) < 1e-4


@query("rc3_als_factors", """
    SELECT DISTINCT CAST(user_id AS INTEGER) AS id, CAST(8 AS INTEGER) AS rank, TRUE AS likes_bought_items FROM {lines}""")
def rc3(t):
    ratings, model = _model(t)
    # Over all users, bought items must score above the same items scored for another user.
    bought = _dot(model, ratings.select("user_id", "item_id"))
    other = ratings.select("user_id").distinct().withColumn("next", F.col("user_id") + 1)
    swapped = _dot(model, ratings.select("user_id", "item_id").join(other, "user_id").select(F.col("next").alias("user_id"), "item_id"))
    fits = bought.agg(F.avg("score")).first()[0] > swapped.agg(F.avg("score")).first()[0]
    return model.userFactors.select("id", F.size("features").alias("rank"), F.lit(fits).alias("likes_bought_items"))


@query("rc4_top_items", """
    SELECT DISTINCT CAST(user_id AS INTEGER) AS user_id, CAST(5 AS INTEGER) AS n_items, CAST(0 AS BIGINT) AS n_better_left_out
    FROM {lines}""")
def rc4(t):
    # Of the items a user has bought, none outside the list may score above its last entry.
    ratings, model = _model(t)
    last = _last_entries(RC.recommend(model, 5))
    scored = _dot(model, _reaching(model, ratings.select("user_id", "item_id"), last)).join(last, "user_id")
    left_out = ~F.array_contains("listed", F.col("item_id")) & (F.col("score") > _limit())
    counts = scored.groupBy("user_id").agg(F.count_if(left_out).alias("n_better_left_out"))
    return last.select("user_id", "n_items").join(counts, "user_id", "left").fillna(0, ["n_better_left_out"])


@query("rc4_top_items_of_all_users", """
    SELECT DISTINCT CAST(user_id AS INTEGER) AS user_id, CAST(5 AS INTEGER) AS n_items, CAST(0 AS BIGINT) AS n_better_left_out
    FROM {lines}""")
def rc4_all(t):
    # Of all items, bought or not, none outside the list may score above its last entry.
    model = _model_only(t)
    return _better_left_out(model, RC.recommend(model, 5))


@query("rc4_scored_share", """
    SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, TRUE AS skips_pairs FROM {lines}""")
def rc4_share(t):
    # Pairs of users and items that the search has scored, of all pairs there are.
    model = _model_only(t)
    scored = RC.recommend(model, 5, with_counts=True).agg(F.count(F.lit(1)).alias("n_users"), F.sum("n_scored").alias("n_scored"))
    n_items = model.itemFactors.count()
    return scored.select("n_users", F.lit(n_items).cast("bigint").alias("n_items"),
                         (F.col("n_scored") < n_items * F.col("n_users")).alias("skips_pairs"))


def _last_entries(recs):
    return recs.select("user_id", F.size("recommendations").alias("n_items"),
                       F.array_min("recommendations.rating").alias("least"), F.col("recommendations.item_id").alias("listed"))


def _limit():
    return F.col("least") + 1e-4  # scores of lists are floats


def _better_left_out(model, recs):
    """Per user: the length of the list, and how many items of the model score above its last entry without being in it.

    Such an item has at least a norm of that score over the user's norm; all items of such norms are scored.
    """
    last = _last_entries(recs)
    users = last.join(model.userFactors.select(F.col("id").alias("user_id"), "features"), "user_id").select(
        F.col("user_id").alias("id"), "features", _limit().alias("limit"), "listed")
    n = items_above(users, model.itemFactors).select(F.col("id").cast("int").alias("user_id"), F.col("n_above").alias("n_better_left_out"))
    return last.select("user_id", "n_items").join(n, "user_id", "left").fillna(0, ["n_better_left_out"])


@query("rc5_flat_recommendations", """
    SELECT DISTINCT CAST(user_id AS INTEGER) AS user_id, CAST(5 AS BIGINT) AS n_rows, CAST(5 AS BIGINT) AS n_right_ratings FROM {lines}""")
def rc5(t):
    model = _model_only(t)
    flat = _dot(model, RC.flatten_recs(RC.recommend(model, 5), "user_id"))
    return flat.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(_same("rating", "score")).alias("n_right_ratings"))


@query("rc5_flat_shape", """
    SELECT DISTINCT CAST(user_id AS INTEGER) AS user_id, CAST(5 AS BIGINT) AS n_rows, CAST(5 AS BIGINT) AS n_known_items FROM {lines}""")
def rc5_shape(t):
    ratings, model = _model(t)
    flat = RC.flatten_recs(RC.recommend(model, 5), "user_id")
    known = ratings.select("item_id").distinct()
    return flat.join(known, "item_id").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("item_id").alias("n_known_items"))


_LATEST = """SELECT user_id, order_id AS booking_id, order_date AS flight_date FROM {sales}
    WHERE order_date = (SELECT max(order_date) FROM {sales}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY order_id) = 1"""


def _bookings(t):
    return t.sales.select("user_id", F.col("order_id").alias("booking_id"), F.col("order_date").alias("flight_date"))


@query("rc6_latest_bookings", _LATEST)
def rc6(t):
    return RC.latest_bookings(_bookings(t), "user_id", "flight_date", "booking_id")


# Every ordering customer is booked here (newest order each), so the re-ranking covers all users.
_BOOKED = """SELECT user_id, order_id AS booking_id FROM {sales}
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY order_date DESC, order_id DESC) = 1"""
_PREFS = """SELECT c_custkey AS user_id, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'SMALL' ELSE 'any' END AS preference FROM customer"""
_RERANKED = f"""SELECT s.user_id, s.item_id, s.rating, b.booking_id, i.category_name
    FROM ({_SCORES}) s JOIN ({_BOOKED}) b ON s.user_id = b.user_id JOIN ({_PREFS}) p ON s.user_id = p.user_id
    JOIN {{items}} i ON s.item_id = i.item_id WHERE (preference = 'SMALL') = (category_name = 'SMALL')
    QUALIFY row_number() OVER (PARTITION BY s.user_id ORDER BY rating DESC, s.item_id) <= 6"""


def _reranked(t):
    from lakeops.operators.windows import latest_per_key

    booked = latest_per_key(t.sales.select("user_id", "order_id", "order_date"), ["user_id"], ["order_date"], ["order_id"]).select(
        "user_id", F.col("order_id").alias("booking_id"))
    prefs = t.customer.select(F.col("c_custkey").alias("user_id"),
                              F.when(F.col("c_mktsegment") == "MACHINERY", "SMALL").otherwise("any").alias("preference"))
    return RC.rerank(_scores(t), booked, prefs, t.items, "user_id", "item_id", "category_name", "SMALL")


@query("rc7_preference_rerank", _RERANKED)
def rc7(t):
    return _reranked(t)


@query("rc8_nearest_offer", f"""
    WITH r AS (SELECT user_id, l.store_id, s_nationkey AS section FROM {{lines}} l JOIN supplier ON l.store_id = s_suppkey GROUP BY ALL)
    SELECT user_id, store_id, section, c_nationkey AS seat, abs(section - c_nationkey) AS distance, CAST(1 AS INTEGER) AS rnk
    FROM r JOIN customer ON user_id = c_custkey QUALIFY rank() OVER (PARTITION BY user_id ORDER BY abs(section - c_nationkey)) = 1""")
def rc8(t):
    recs = t.lines.join(t.supplier, F.col("store_id") == F.col("s_suppkey")).select(
        "user_id", "store_id", F.col("s_nationkey").alias("section")).distinct()
    seats = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("seat"))
    return RC.nearest_offer(recs, seats, "user_id", "section", "seat")


@query("rc9_packed_lists", f"""
    SELECT user_id, booking_id, array_to_string(list(item_id ORDER BY rating DESC, item_id), ',') AS items,
           array_to_string(list(category_name ORDER BY rating DESC, item_id), ',') AS categories FROM ({_RERANKED}) GROUP BY ALL""")
def rc9(t):
    top = _reranked(t).withColumn("_order", F.struct(-F.col("rating"), "item_id"))
    packed = RC.pack(top, ["user_id", "booking_id"], ["item_id", "category_name"], F.col("_order"))
    return packed.select("user_id", "booking_id",
                         F.array_join(F.col("contents_list.item_id").cast("array<string>"), ",").alias("items"),
                         F.array_join("contents_list.category_name", ",").alias("categories"))


@query("rc10_lookup_user", f"""
    SELECT user_id, arg_max(item_id, (rating, -item_id)) AS first_item, CAST(count(*) AS INTEGER) AS n_items
    FROM ({_RERANKED}) WHERE user_id = 11 GROUP BY user_id""")
def rc10(t):
    top = _reranked(t).withColumn("_order", F.struct(-F.col("rating"), "item_id"))
    packed = RC.pack(top, ["user_id"], ["item_id"], F.col("_order")).select("user_id", F.col("contents_list.item_id").alias("items"))
    return RC.lookup(packed, "user_id", 11, "items")


@query("rc11_best_sellers", """
    SELECT item_id, count(*) AS item_purchases FROM {lines} GROUP BY item_id ORDER BY item_purchases DESC, item_id LIMIT 10""")
def rc11(t):
    counts = t.lineitem.groupBy(F.col("l_partkey").alias("item_id")).agg(F.count(F.lit(1)).alias("item_purchases"))
    return top_k(counts, [F.col("item_purchases").desc(), F.col("item_id")], 10)


@query("rc12_scored_pairs", """
    SELECT DISTINCT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id, TRUE AS right_score FROM {lines}""")
def rc12(t):
    ratings, model = _model(t)
    scored = _dot(model, RC.score_pairs(model, ratings.select("user_id", "item_id")))
    return scored.select("user_id", "item_id", _same("prediction", "score").alias("right_score"))
