"""Queries of the time-series operators and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fathomline.plans import alignment, attention, base, cleaning, evaluation, graphs, samples, spectra, storage
from fathomline.plans.evaluation import flagship

__all__ = ["alignment", "attention", "cleaning", "evaluation", "flagship", "graphs", "oracle_sql", "queries", "samples", "spectra", "storage"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)
