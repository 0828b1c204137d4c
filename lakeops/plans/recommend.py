"""Implicit-feedback recommendation and re-ranking."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import safe_div
from lakeops.operators.clean import latest_partition
from lakeops.operators.numbering import surrogate_key
from lakeops.operators.windows import latest_per_key, rank_best, top_n
from lakeops.plans.inner_products import top_items
from lakeops.session import shared_root

LEAST_BLOCKS = 10  # of users and of items; Spark's own number
RATINGS_PER_BLOCK = 8_000_000  # held by a task of the training, with the factors they need: up to 90 bytes each


def ratings_from_counts(df: DataFrame, user: str, item: str) -> DataFrame:
    """How often each user took each item."""
    return df.groupBy(user, item).agg(F.count(F.lit(1)).alias("rating"))


def ratings_from_ratio(df: DataFrame, user: str, item: str, num: str, den: str) -> DataFrame:
    """Watched share per view, at most 1, summed per user and item; zero goes.

    Shares are summed as millionths, so the total does not depend on row order.
    """
    share = F.least(safe_div(num, den), F.lit(1.0))
    micro = F.rint(share * 1_000_000).cast("bigint")
    return df.groupBy(user, item).agg((F.sum(micro) / 1_000_000.0).alias("rating")).filter("rating > 0")


def dense_ids(ratings: DataFrame, col: str, name: str) -> DataFrame:
    """Ratings with ``col`` replaced by dense integers ``name``; the mapping is
    the frame's distinct (col, name). ALS takes integer ids only, so ids that
    are text or exceed 32 bits go through this first."""
    ids = surrogate_key(ratings.select(col).distinct(), [col], name)
    return ratings.join(ids.withColumn(name, F.col(name).cast("int")), col)


def als_blocks(n_ratings: int, per_block: int = RATINGS_PER_BLOCK) -> int:
    """How many blocks training takes, so that none holds many more ratings than ``per_block``.

    A row of factors is sent once to each block that needs it, so there are no more blocks than that takes.
    Ids are dealt to blocks by their remainder: the number is prime, so that ids in steps fill all blocks.
    """
    n = -(-n_ratings // per_block)
    if n <= LEAST_BLOCKS:
        return LEAST_BLOCKS
    while any(n % d == 0 for d in range(2, math.isqrt(n) + 1)):
        n += 1
    return n


def train_als(ratings: DataFrame, user: str, item: str, rating: str = "rating", rank: int = 8, reg: float = 0.1,
              max_iter: int = 10, seed: int = 42, blocks: int | None = None, per_block: int = RATINGS_PER_BLOCK) -> ALSModel:
    """Implicit-feedback ALS; unknown users and items are dropped on scoring.

    A task holds the ratings of a block and the factors they need. Without ``blocks`` the ratings are counted and
    the number follows them, see ``als_blocks``, so ratings that are costly to compute should be stored. Between
    iterations blocks are on disk, so that tasks have the memory; each iteration ends in a reliable
    checkpoint, which cuts the lineage and lets Spark remove the shuffle files behind it.
    """
    shared_root(ratings.sparkSession)
    blocks = blocks or als_blocks(ratings.count(), per_block)
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, userCol=user, itemCol=item, ratingCol=rating, implicitPrefs=True,
              coldStartStrategy="drop", seed=seed, checkpointInterval=1, intermediateStorageLevel="DISK_ONLY")
    return als.setNumUserBlocks(blocks).setNumItemBlocks(blocks).fit(ratings)


def recommend(model: ALSModel, k: int = 30, users: DataFrame | None = None, with_counts: bool = False) -> DataFrame:
    """Top ``k`` items as arrays, for the given users or for all.

    The result is exact, but items that cannot reach a user's list are not
    scored, see ``inner_products``. ``with_counts`` adds ``n_scored``.
    """
    user, item = model.getUserCol(), model.getItemCol()
    wanted = model.userFactors
    if users is not None:
        wanted = wanted.join(users.select(F.col(user).alias("id")).distinct(), "id", "left_semi")
    found = top_items(wanted, model.itemFactors, k)
    recs = F.transform("found", lambda x: F.struct(x["item"].cast("int").alias(item), x["score"].cast("float").alias("rating")))
    return found.select(F.col("id").cast("int").alias(user), recs.alias("recommendations"), *(["n_scored"] if with_counts else []))


def flatten_recs(recs: DataFrame, user: str) -> DataFrame:
    """Recommendation arrays to one row per user and item."""
    return recs.select(user, F.explode("recommendations").alias("items")).select(user, "items.*")


def score_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    return model.transform(pairs)


def latest_bookings(bookings: DataFrame, user: str, date: str, booking: str) -> DataFrame:
    """Passengers of the newest date, one booking each (smallest booking id)."""
    return top_n(latest_partition(bookings, date), [user], [F.col(booking).asc()], 1)


def rerank(recs: DataFrame, bookings: DataFrame, prefs: DataFrame, items: DataFrame, user: str, item: str,
           category: str, special: str, n: int = 6) -> DataFrame:
    """Best ``n`` items per booked user, in line with the stated preference.

    A user who prefers the special category gets only that category, everyone
    else gets only the other categories. Users without a stated preference or
    without recommendations are left out.
    """
    pool = (
        recs.join(bookings, user).join(prefs.select(user, F.col("preference")), user)
        .join(items.select(item, category), item)
        .filter((F.col("preference") == special) == (F.col(category) == special))
    )
    return top_n(pool, [user], [F.col("rating").desc(), F.col(item).asc()], n).drop("preference")


def nearest_offer(recs: DataFrame, seats: DataFrame, user: str, section: str, seat: str) -> DataFrame:
    """Recommended offers nearest to the user's seat; ties are all kept."""
    near = recs.join(seats, user).withColumn("distance", F.abs(F.col(section) - F.col(seat)))
    return rank_best(near, [user], "distance")


def pack(top: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Column | str) -> DataFrame:
    """A user's short list as parallel arrays in rank order.

    For input of :func:`rerank`, which holds at most ``n`` rows per user.
    """
    entry = F.struct(order, *cols)
    rows = F.sort_array(F.collect_list(entry))
    packed = top.groupBy(*keys).agg(rows.alias("_rows"))
    return packed.select(*keys, F.struct(*[F.col(f"_rows.{c}").alias(c) for c in cols]).alias("contents_list"))


def lookup(packed: DataFrame, user_col: str, user, array_col: str) -> DataFrame:
    """One user's first entry and the length of the list."""
    return packed.filter(F.col(user_col) == user).select(
        user_col, F.get(F.col(array_col), F.lit(0)).alias("first_item"), F.size(array_col).alias("n_items"))


def survey_preference(survey: DataFrame, user: str, answer: str, when: str, tiebreak: str) -> DataFrame:
    """Each user's newest stated preference."""
    return latest_per_key(survey, [user], [when], [tiebreak]).select(user, F.col(answer).alias("preference"))
