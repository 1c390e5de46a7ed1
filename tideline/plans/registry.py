"""All registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.plans import queries_read, queries_relate, queries_write  # noqa: F401
from tideline.plans.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["srt_1_top_n_liquid"](spark, sf_dir)
