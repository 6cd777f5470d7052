"""Queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fathomline.llm import queries as q
from fathomline.llm import sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in vars(q).items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
