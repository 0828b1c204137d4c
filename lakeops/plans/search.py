"""Parameter search by successive halving.

Many parameter sets are fitted on few rows, the better ones on more, and the best on all.
The rows of a rung are an exact, nested sample of the training rows with the classes in their shares,
stored once and read by all fits of the rung; fits run side by side. All trials come back as rows.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Mapping, Sequence
from math import exp, log
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.util import inheritable_thread_target

from lakeops.operators.sampling import exact_sample
from lakeops.session import work_dir

Params = dict[str, object]


def draw(space: Mapping[str, object], n: int, seed: int = 0) -> list[Params]:
    """``n`` different parameter sets, or all there are.

    A list gives choices, a tuple (low, high) a number, a whole one if both are, and (low, high, "log") one that is
    even in its logarithm.
    """
    rng, out = random.Random(seed), []
    choices = [v for v in space.values() if isinstance(v, list)]
    if len(choices) == len(space):
        everything: list[Params] = [{}]
        for name, values in space.items():
            everything = [p | {name: v} for p in everything for v in values]
        rng.shuffle(everything)
        return everything[:n]
    for _ in range(50 * n):
        one: Params = {}
        for name, values in space.items():
            if isinstance(values, list):
                one[name] = rng.choice(values)
            elif len(values) == 3:
                one[name] = exp(rng.uniform(log(values[0]), log(values[1])))
            elif all(isinstance(v, int) for v in values):
                one[name] = rng.randint(*values)
            else:
                one[name] = rng.uniform(*values)
        if one not in out:
            out.append(one)
        if len(out) == n:
            break
    return out


def rungs(n_trials: int, n_rows: int, least_rows: int, factor: int) -> list[tuple[int, int]]:
    """(trials, rows) of each rung: the last has all rows, each one before a ``factor``-th of them."""
    sizes = [n_rows]
    while sizes[0] // factor >= least_rows and n_trials // factor ** len(sizes) >= 1:
        sizes.insert(0, sizes[0] // factor)
    return [(max(1, n_trials // factor ** i), size) for i, size in enumerate(sizes)]


def halving_search(train: DataFrame, validation: DataFrame, keys: Sequence[str], label_col: str, trials: Sequence[Params],
                   fit: Callable[[DataFrame, Params], PipelineModel], score: Callable[[PipelineModel, DataFrame], float],
                   least_rows: int = 1000, factor: int = 3, parallelism: int = 4,
                   seed: int = 0) -> tuple[PipelineModel, DataFrame]:
    """The best model, and all trials as rows.

    ``fit`` trains on rows with parameters, ``score`` gives a number on the validation rows, higher is better. Rows:
    ``rung``, ``trial`` (its number), ``params`` (JSON), ``n_rows``, ``score`` and ``kept`` (goes on or, in the last rung, won).
    Ties go to the trial with the smaller number.
    """
    spark = train.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = work_dir(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    train, validation = stored(train, "search-train"), stored(validation, "search-validation")
    counts = {r[label_col]: r["count"] for r in train.groupBy(label_col).count().collect()}
    total = sum(counts.values())
    alive, rows, best = list(enumerate(trials)), [], None
    plan = rungs(len(alive), total, least_rows, factor)
    for rung, (n_alive, n_rows) in enumerate(plan):
        alive = alive[:n_alive] if rung else alive
        part = train
        if n_rows < total:
            sizes = {value: max(1, round(n * n_rows / total)) for value, n in counts.items()}
            part = stored(exact_sample(train, keys, sizes, [label_col], seed), "search-rung")

        def one(trial: tuple[int, Params]) -> tuple[float, int, PipelineModel]:
            model = fit(part, trial[1])
            return score(model, validation), trial[0], model

        with ThreadPool(max(1, min(parallelism, len(alive)))) as pool:
            done = pool.map(inheritable_thread_target(spark)(one), alive)
        order = sorted(done, key=lambda x: (-x[0], x[1]))
        go_on = plan[rung + 1][0] if rung + 1 < len(plan) else 1
        kept = {number for _, number, _ in order[:go_on]}
        rows += [(rung, number, json.dumps(trials[number], sort_keys=True), n_rows, float(s), number in kept)
                 for s, number, _ in sorted(done, key=lambda x: x[1])]
        alive = [(number, trials[number]) for _, number, _ in order]
        best = order[0][2]
    return best, spark.createDataFrame(rows, "rung int, trial int, params string, n_rows bigint, score double, kept boolean")
