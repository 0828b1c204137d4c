"""Join operators. No broadcast hints: Spark broadcasts a side only where its
measured size is below the configured limit, and AQE splits skewed partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions.columns import cents
from lakeops.operators.null_safe import null_safe_join
from lakeops.operators.numbering import MAX_GROUP_ROWS, fits_one_task, number_rows, surrogate_key
from lakeops.operators.windows import latest_per_key


def denormalise(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Left-join dimensions given as ``(dim, fact key, dim key)``.

    The dimension key column is dropped when it has another name than the fact's.
    """
    out = fact
    for i, (dim, fact_key, dim_key) in enumerate(dims):
        d = dim.withColumnRenamed(dim_key, f"_dim{i}")
        out = out.join(d, out[fact_key] == d[f"_dim{i}"], "left").drop(f"_dim{i}")
    return out


def role_join(fact: DataFrame, dim: DataFrame, dim_key: str,
              roles: Mapping[str, str]) -> DataFrame:
    """Join one dimension several times: ``{role prefix: fact key}``."""
    out = fact
    for role, key in roles.items():
        d = dim.select(F.col(dim_key).alias(f"_{role}_key"),
                       *[F.col(c).alias(f"{role}_{c}") for c in dim.columns if c != dim_key])
        out = out.join(d, out[key] == d[f"_{role}_key"], "left").drop(f"_{role}_key")
    return out


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_date: str,
              right_date: str, values: Sequence[str], tiebreak: Sequence[str] = (),
              max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Attach the newest right row on or before the left row's date.

    Both sides are stacked and the last right row is carried forward, in one
    shuffle and without a join. Where a key has more rows than one task should
    sort, only one row per key and date goes through the window, and left rows
    find their date's answer by an equi-join, which AQE can split.
    """
    carried = F.struct(*dict.fromkeys([right_date, *tiebreak, *values]))
    facts = right.filter(F.col(right_date).isNotNull()).select(*keys, F.col(right_date).alias("_date"),
                                                               carried.alias("_right"))
    dtype = facts.schema["_right"].dataType
    names = [(c, c if c not in left.columns else f"asof_{c}") for c in dict.fromkeys([right_date, *values])]
    taken = [F.col(f"_known.{c}").alias(alias) for c, alias in names]
    asked = left.select(*keys, F.col(left_date).alias("_date"), F.lit(None).cast(dtype).alias("_right"))
    by_key = Window.partitionBy(*keys)
    if fits_one_task(facts.select(*keys).unionAll(asked.select(*keys)), keys, max_group_rows):
        stacked = facts.withColumn("_left", F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType)).unionByName(
            left.select(*keys, F.col(left_date).alias("_date"), F.lit(None).cast(dtype).alias("_right"),
                        F.struct("*").alias("_left")))
        # Right rows of a date come before the left rows of that date.
        w = by_key.orderBy("_date", F.col("_left").isNotNull(), "_right").rowsBetween(Window.unboundedPreceding, 0)
        known = stacked.withColumn("_known", F.last("_right", ignorenulls=True).over(w))
        return known.filter(F.col("_left").isNotNull()).select("_left.*", *taken)
    dates = facts.unionByName(asked).groupBy(*keys, "_date").agg(F.max("_right").alias("_right"))
    w = by_key.orderBy("_date").rowsBetween(Window.unboundedPreceding, 0)
    known = dates.withColumn("_known", F.last("_right", ignorenulls=True).over(w))
    k = known.select(*[F.col(c).alias(f"_k_{c}") for c in keys], F.col("_date").alias("_k_date"), "_known")
    on = left[left_date] == k["_k_date"]
    for c in keys:
        on = on & left[c].eqNullSafe(k[f"_k_{c}"])
    return left.join(k, on, "left").select(*left.columns, *taken)


def latest_stock_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_date: str,
                      right_date: str, values: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest right row overall, used only where it is not later than the left date.

    Null keys match null keys. The newest rows are found by the same columns as the join
    compares (value and null flag of each key), so the right side is shuffled once.
    """
    names, plain = [], []
    for i, k in enumerate(keys):
        names += [f"_r_key{i}", f"_r_null{i}"]
        plain += [_without_null(right, k).alias(f"_r_key{i}"), F.col(k).isNull().alias(f"_r_null{i}")]
    rows = right.select(*plain, *[F.col(c) for c in dict.fromkeys([right_date, *tiebreak, *values])])
    r = latest_per_key(rows, names, [right_date], tiebreak).select(
        *names, F.col(right_date).alias("_r_date"), *[F.col(v).alias(f"_r_{v}") for v in values])
    on = r["_r_date"] <= left[left_date]
    for i, k in enumerate(keys):
        on = (_without_null(left, k) == r[f"_r_key{i}"]) & (left[k].isNull() == r[f"_r_null{i}"]) & on
    return left.join(r, on, "left").select(*left.columns, *[F.col(f"_r_{v}").alias(v) for v in values])


def _without_null(df: DataFrame, key: str) -> Column:
    """A key with a value of its type in place of NULL; its null flag goes beside it."""
    kind = df.schema[key].dataType.typeName()
    value = {"string": "", "date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01", "boolean": "false"}.get(kind, "0")
    return F.coalesce(df[key], F.lit(value).cast(df.schema[key].dataType))


def same_day_join(orders: DataFrame, logs: DataFrame, user: str, order_date: str, log_user: str,
                  log_date: str, log_order: Sequence[str], values: Sequence[str],
                  condition: Column | None = None, per_user: DataFrame | None = None) -> DataFrame:
    """Attach the last log entry of the order's day, and how many there were.

    One log row per user and day is kept before the join, so order rows do not
    multiply with the log. ``per_user`` (``user`` and other columns) is attached in the
    same join: the days of a user are then one map, with an entry per day however long the
    log, and the orders are shuffled once, by user, instead of once by day and once by user.
    """
    last = F.max_by(F.struct(*[F.col(v) for v in values]), F.struct(*[F.col(c) for c in log_order]))
    per_day = logs.groupBy(F.col(log_user).alias("_user"), F.col(log_date).alias("_date")).agg(
        last.alias("_last"), F.count(F.lit(1)).alias("_n"))
    if per_user is not None:
        days = per_day.filter("_user IS NOT NULL AND _date IS NOT NULL").groupBy("_user").agg(
            F.map_from_entries(F.collect_list(F.struct("_date", F.struct("_last", "_n")))).alias("_days"))
        more = [c for c in per_user.columns if c != user]
        known = per_user.select(F.col(user).alias("_user"), *more).join(days, "_user", "full")
        day = F.try_element_at("_days", order_date)
        if condition is not None:
            day = F.when(condition, day)
        joined = orders.join(known, orders[user] == known["_user"], "left").withColumn("_day", day)
        return joined.select(*orders.columns, *[F.col(f"_day._last.{v}").alias(v) for v in values],
                             F.coalesce("_day._n", F.lit(0)).alias("n_logs"), *more)
    on = (orders[user] == per_day["_user"]) & (orders[order_date] == per_day["_date"])
    if condition is not None:
        on = on & condition
    return orders.join(per_day, on, "left").select(
        *orders.columns, *[F.col(f"_last.{v}").alias(v) for v in values],
        F.coalesce("_n", F.lit(0)).alias("n_logs"))


def ratio_within_group(df: DataFrame, group: str, item: str, amount: str,
                       total_name: str = "total_sales") -> DataFrame:
    """Money total per group and item, with its percentage of the group's total."""
    per_item = df.groupBy(group, item).agg(F.sum(cents(amount)).alias("_cents"))
    totals = per_item.groupBy(group).agg(F.sum("_cents").alias("_total"))
    out = per_item.join(totals, group).withColumn(total_name, F.col("_cents") / 100.0)
    return out.withColumn("sales_ratio", F.col(total_name) * 100 / (F.col("_total") / 100.0)).drop("_cents", "_total")


def zip_join(left: DataFrame, right: DataFrame, left_order: Sequence[Column | str],
             right_order: Sequence[Column | str]) -> DataFrame:
    """Pair the n-th row of one list with the n-th row of the other."""
    a = surrogate_key(left, left_order, "pair_no")
    b = surrogate_key(right, right_order, "pair_no")
    return a.join(b, "pair_no")


def attach_members(df: DataFrame, members: DataFrame, group: str, member: str,
                   pick: Column, name: str = "picked") -> DataFrame:
    """Give each row the member number ``pmod(pick, n) + 1`` of its group.

    Members are numbered inside their group; no member list is built.
    """
    numbered = number_rows(members.select(group, member), [group], [member], "_no")
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    asked = (
        df.join(sizes, group, "left")
        .withColumn("_no", F.pmod(pick, F.col("_n")).cast("bigint") + 1)
    )
    return (
        asked.join(numbered.withColumnRenamed(member, name), [group, "_no"], "left")
        .select(*df.columns, name)
    )


def assign_round_robin(left: DataFrame, right: DataFrame, group: str,
                       left_order: Sequence[Column | str], right_order: Sequence[Column | str],
                       value: str) -> DataFrame:
    """Row i of a group gets text ``i mod n`` of the same group; NULL if it has none."""
    sizes = right.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    texts = number_rows(right, [group], right_order, "_no").select(group, "_no", value)
    asked = (
        number_rows(left, [group], left_order, "_rn").join(sizes, group, "left")
        .withColumn("_no", F.pmod(F.col("_rn") - 1, F.col("_n")) + 1)
    )
    return asked.join(texts, [group, "_no"], "left").select(*left.columns, value)


def hashed_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                salt: str = "") -> DataFrame:
    """Join two parties' tables on salted SHA-256 of the key; the key itself goes."""
    def digest(c):
        return F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256)
    a = left.withColumn("key_sha256", digest(left_key)).drop(left_key)
    b = right.withColumn("key_sha256", digest(right_key)).drop(right_key)
    return a.join(b, "key_sha256")


def min_group(df: DataFrame, count_col: str, k: int) -> DataFrame:
    """Hide result groups that stand for fewer than ``k`` rows."""
    return df.filter(F.col(count_col) >= k)
