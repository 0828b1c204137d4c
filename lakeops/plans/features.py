"""Feature tables, labels, class balance and classifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import cents, unit_hash
from lakeops.functions.dates import day, local_time
from lakeops.operators.sampling import exact_sample
from lakeops.operators.sets import hash_sample, union_all
from lakeops.plans.search import draw, halving_search
from lakeops.session import checkpointed


def window_features(tx: DataFrame, key: str, other: str, ts: str, amount: str, as_of: str,
                    months: Sequence[int] = (12, 6, 3), prefix: str = "sent",
                    count_other: bool = True) -> DataFrame:
    """Transfers per customer over several trailing windows, in one pass.

    Per window: distinct counterparties, count, sum and mean amount. The rows
    are first reduced to one per customer and counterparty, so distinct
    counterparties become plain counts. ``count_other=False`` counts the
    customer itself, which is always 1.
    """
    longest = max(months)

    def since(m: int) -> Column:
        return F.col(ts).cast("date") >= F.add_months(day(as_of), -m)

    recent = tx.filter(since(longest) & F.col(key).isNotNull())
    pair = recent.groupBy(F.col(key).alias("cust_id"), F.col(other).alias("_other")).agg(*[
        a for m in months for a in (
            F.count(F.when(since(m), 1)).alias(f"_n{m}"),
            F.sum(F.when(since(m), cents(amount)).otherwise(0)).alias(f"_c{m}"))])
    aggs = []
    for m in months:
        n, c = F.sum(f"_n{m}"), F.sum(f"_c{m}") / 100.0
        hit = F.col(f"_n{m}") > 0
        parties = F.count(F.when(hit & F.col("_other").isNotNull(), 1)) if count_other else (
            F.max(F.when(hit, 1)).cast("bigint"))
        aggs += [F.when(n > 0, parties).alias(f"{prefix}_party_cnt_{m}m"),
                 F.when(n > 0, n).alias(f"{prefix}_txn_cnt_{m}m"),
                 F.when(n > 0, c).alias(f"{prefix}_txn_amt_{m}m"),
                 F.when(n > 0, c / n).alias(f"{prefix}_amt_avg_{m}m")]
    return pair.groupBy("cust_id").agg(*aggs)


def account_features(accounts: DataFrame, currency: str = "USD") -> DataFrame:
    """Account count and mean balance, with the balance held in one currency."""
    per_cust = accounts.groupBy("cust_id").agg(
        F.count(F.lit(1)).alias("num_accs"), (F.sum(cents("balance")) / 100.0 / F.count("balance")).alias("avg_balance"))
    held = accounts.filter(F.col("currency") == currency).groupBy("cust_id").agg(
        (F.sum(cents("balance")) / 100.0).alias(f"balance_{currency.lower()}"))
    return per_cust.join(held, "cust_id", "left")


def ratio_features(df: DataFrame, months: Sequence[int] = (12, 6, 3), fill: bool = True) -> DataFrame:
    """Totals over both directions and shares of the longest window."""
    longest = max(months)
    totals = {}
    for m in months:
        totals[f"tot_txn_cnt_{m}m"] = F.col(f"sent_txn_cnt_{m}m") + F.col(f"rcvd_txn_cnt_{m}m")
        totals[f"tot_txn_amt_{m}m"] = F.col(f"sent_txn_amt_{m}m") + F.col(f"rcvd_txn_amt_{m}m")
    df = df.withColumns(totals)
    base = F.col(f"tot_txn_amt_{longest}m")
    df = df.withColumns({
        f"ratio_txn_amt_{m}m_{longest}m": F.when(base == 0, 0.0).otherwise(F.col(f"tot_txn_amt_{m}m") / base)
        for m in months if m != longest})
    return df.na.fill(0) if fill else df


def feature_table(base: DataFrame, others: Sequence[DataFrame], key: str) -> DataFrame:
    return reduce(lambda a, b: a.join(b, key, "left"), others, base)


def label(df: DataFrame, condition: Column | str, name: str = "label") -> DataFrame:
    test = F.expr(condition) if isinstance(condition, str) else condition
    return df.withColumn(name, F.when(test, 1).otherwise(0))


def oversample(df: DataFrame, label_col: str, times: int = 2) -> DataFrame:
    """The minority class, each row ``times`` times."""
    return union_all([df.filter(F.col(label_col) == 1)] * times)


def rebalance(df: DataFrame, label_col: str, key: str, over: int = 2, ratio: float = 3.0, seed: int = 42) -> DataFrame:
    """Minority rows repeated, majority rows sampled to ``ratio`` times as many.

    The fraction is clamped to 1. Only two counts come to the driver.
    """
    n = df.agg(F.count_if(F.col(label_col) == 1).alias("minor"),
               F.count_if(F.col(label_col) == 0).alias("major")).first()
    fraction = min(1.0, n["minor"] * over * ratio / max(n["major"], 1))
    major = hash_sample(df.filter(F.col(label_col) == 0), key, fraction, seed)
    return union_all([major, oversample(df, label_col, over)])


def rebalance_exactly(df: DataFrame, label_col: str, keys: Sequence[str], over: int = 2, ratio: float = 3.0,
                      seed: int = 42) -> DataFrame:
    """Minority rows repeated, and exactly ``ratio`` times as many majority rows, or all of them."""
    n = df.filter(F.col(label_col) == 1).count() * over
    major = exact_sample(df.filter(F.col(label_col) == 0), keys, int(n * ratio), seed=seed)
    return union_all([major, oversample(df, label_col, over)])


def one_hot(df: DataFrame, values: Mapping[str, Sequence[str]], keep: bool = False) -> DataFrame:
    """0/1 columns named ``<column>_<value>`` for the given values."""
    dummies = {f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for c, vs in values.items() for v in vs}
    out = df.withColumns(dummies)
    return out if keep else out.drop(*values)


def distinct_values(df: DataFrame, cols: Sequence[str], limit: int = 1000) -> dict[str, list[str]]:
    """Sorted distinct values of low-cardinality columns; refuses more than ``limit``."""
    out = {}
    for c in cols:
        found = [r[0] for r in df.select(c).distinct().limit(limit + 1).collect() if r[0] is not None]
        if len(found) > limit:
            raise ValueError(f"{c} has more than {limit} values; one column per value is not meant for it")
        out[c] = sorted(found)
    return out


def one_hot_long(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """The ones of a one-hot encoding as rows (key, column, value), for columns with any number of values.

    Every value of every row is kept; a null has no row, as it has no column in
    the wide form. No value comes to the driver, and nothing is shuffled.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(key, F.inline(pairs)).filter(F.col("value").isNotNull())


def yes_no(c: Column | str) -> Column:
    value = F.col(c) if isinstance(c, str) else c
    return F.when(value == "Yes", 1).when(value == "No", 0)


def scale_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean-imputed, standardised copies ``<col>_scaled`` (population deviation)."""
    stats = df.agg(*[s for c in cols for s in (F.avg(c).alias(f"m_{c}"), F.count(c).alias(f"k_{c}"),
                                               F.var_pop(c).alias(f"v_{c}"))], F.count(F.lit(1)).alias("n")).first()
    out = {}
    for c in cols:
        mean = stats[f"m_{c}"]
        # Imputing the mean leaves the mean and shrinks the variance.
        sd = (stats[f"v_{c}"] * stats[f"k_{c}"] / stats["n"]) ** 0.5 or 1.0
        out[f"{c}_scaled"] = (F.coalesce(F.col(c).cast("double"), F.lit(mean)) - F.lit(mean)) / F.lit(sd)
    return df.withColumns(out)


def prepare(numeric: Sequence[str], features: str = "features") -> Pipeline:
    """Spark ML stages: impute the mean, assemble, standardise."""
    imputed = [f"{c}_imp" for c in numeric]
    return Pipeline(stages=[
        Imputer(inputCols=list(numeric), outputCols=imputed, strategy="mean"),
        VectorAssembler(inputCols=imputed, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol=features, withMean=True, withStd=True)])


def split(df: DataFrame, key: str, fractions: Mapping[str, float], seed: int = 0, name: str = "split") -> DataFrame:
    """Repeatable split by key hash; every class gets the same fractions."""
    u, low, out = unit_hash(key, seed), 0.0, None
    parts = list(fractions.items())
    for part, share in parts[:-1]:
        low += share
        out = F.when(u < low, part) if out is None else out.when(u < low, part)
    last = parts[-1][0]
    return df.withColumn(name, F.lit(last) if out is None else out.otherwise(last))


def train_classifier(df: DataFrame, label_col: str, numeric: Sequence[str], depths: Sequence[int] = (3, 5),
                     max_iter: int = 10, seed: int = 42) -> PipelineModel:
    """Gradient-boosted trees, depth chosen on a validation split.

    Boosting passes over its input many times, so label and features are
    checkpointed first: they are computed once, in as many partitions as their
    size asks for.
    """
    df = checkpointed(df.select(label_col, *numeric))
    gbt = GBTClassifier(labelCol=label_col, featuresCol="features", maxIter=max_iter, seed=seed)
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).build()
    search = TrainValidationSplit(estimator=Pipeline(stages=[prepare(numeric), gbt]), estimatorParamMaps=grid,
                                  evaluator=BinaryClassificationEvaluator(labelCol=label_col), trainRatio=0.75,
                                  seed=seed)
    return search.fit(df).bestModel


def search_classifier(train: DataFrame, validation: DataFrame, keys: Sequence[str], label_col: str, numeric: Sequence[str],
                      space: Mapping[str, object], n_trials: int = 9, least_rows: int = 1000, factor: int = 3,
                      parallelism: int = 4, seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Gradient-boosted trees with the best parameters of ``space``, by successive halving; and all trials.

    ``space`` names parameters of ``GBTClassifier`` (``maxDepth``, ``maxIter``, ``stepSize``, ``subsamplingRate``, ...).
    """
    roc = BinaryClassificationEvaluator(labelCol=label_col, metricName="areaUnderROC")

    def fit(rows: DataFrame, params: dict[str, object]) -> PipelineModel:
        gbt = GBTClassifier(labelCol=label_col, featuresCol="features", seed=seed, **params)
        return Pipeline(stages=[prepare(numeric), gbt]).fit(rows)

    cols = list(dict.fromkeys([*keys, label_col, *numeric]))
    return halving_search(train.select(*cols), validation.select(*cols), keys, label_col, draw(space, n_trials, seed), fit,
                          lambda model, rows: roc.evaluate(model.transform(rows)), least_rows, factor, parallelism, seed)


def evaluate(scored: DataFrame, label_col: str) -> dict[str, float]:
    """F1, area under ROC and under the precision-recall curve."""
    f1 = MulticlassClassificationEvaluator(labelCol=label_col, metricName="f1")
    roc = BinaryClassificationEvaluator(labelCol=label_col, metricName="areaUnderROC")
    pr = BinaryClassificationEvaluator(labelCol=label_col, metricName="areaUnderPR")
    return {"f1": f1.evaluate(scored), "roc_auc": roc.evaluate(scored), "pr_auc": pr.evaluate(scored)}


def confusion_matrix(scored: DataFrame, label_col: str, pred: str) -> DataFrame:
    return scored.groupBy(label_col, pred).agg(F.count(F.lit(1)).alias("n"))


def score(model: PipelineModel, df: DataFrame, zone: str = "Asia/Tokyo") -> DataFrame:
    """Predictions for a table, stamped with the local time of a zone."""
    return model.transform(df).withColumn("prediction_timestamp", local_time(F.current_timestamp(), zone))
