"""The join that treats NULL as a value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "left") -> DataFrame:
    """Equi-join in which NULL matches NULL."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    on = None
    for k in keys:
        test = left[k].eqNullSafe(r[f"_r_{k}"])
        on = test if on is None else on & test
    return left.join(r, on, how).drop(*[f"_r_{k}" for k in keys])
