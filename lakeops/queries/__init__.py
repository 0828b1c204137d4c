"""Named queries over the test tables, each with its check SQL where one exists.

Importing this package fills the registry; see :mod:`lakeops.queries.registry`.
"""

from lakeops.queries import (  # noqa: F401
    aggregations,
    cleansing,
    customer_marts,
    demand_marts,
    feature_tables,
    joining,
    quality_checks,
    recommendations,
    review_text,
    scalars,
    silver_masters,
    sketched,
    sinks,
    sources,
    streams,
    table_functions,
    unions,
    windowing,
)
from lakeops.queries.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
