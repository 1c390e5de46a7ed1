"""Views over the standard tables that stand for market data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str):
    return F.floor(F.col(c) * 100).cast("bigint")


def code(c: str):
    return F.lpad(F.col(c).cast("string"), 6, "0")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of users' events: prices in cents, one row per (code, date)."""
    e = table(spark, sf_dir, "events").select(code("user_id").alias("code"), F.to_date("ts").alias("date"), "event_id", cents("value").alias("px"))
    return e.groupBy("code", "date").agg(
        F.min_by("px", "event_id").alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max_by("px", "event_id").alias("close"),
        F.count("*").alias("volume"),
        F.sum("px").alias("trade_value"),
    )


def long_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of suppliers' lines, a long history."""
    x = table(spark, sf_dir, "lineitem").select(code("l_suppkey").alias("code"), F.to_date("l_shipdate").alias("date"), cents("l_extendedprice").alias("px"), F.col("l_quantity").cast("bigint").alias("q"))
    return x.groupBy("code", "date").agg(F.min("px").alias("low"), F.max("px").alias("high"), F.max_by("px", F.struct("q", "px")).alias("close"), F.sum("q").alias("volume"), F.sum("px").alias("trade_value"))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as versions of a figure: the version of a day is the order with the largest key."""
    o = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    v = o.select(
        F.col("o_custkey").cast("string").alias("code"),
        F.concat(F.year(day), F.lit("Q"), F.quarter(day)).alias("period"),
        day.alias("knowledge_date"),
        "o_orderkey",
        F.col("o_totalprice").alias("value"),
    )
    return v.groupBy("code", "period", "knowledge_date").agg(F.max_by("value", "o_orderkey").alias("value"))


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share counts: orders with even keys."""
    o = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0")
    return o.groupBy(F.col("o_custkey").cast("string").alias("code"), F.to_date("o_orderdate").alias("date")).agg((F.max("o_orderkey") + 1).alias("shares"))


def share_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes to go with the share counts: orders with odd keys."""
    o = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 1")
    return o.groupBy(F.col("o_custkey").cast("string").alias("code"), F.to_date("o_orderdate").alias("date")).agg(F.max(cents("o_totalprice")).alias("close"))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A master: code, name, market."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(code("s_suppkey").alias("code"), F.col("s_name").alias("name"), F.col("n_name").alias("market"))


def feed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of feeds: what the feed said when it was last modified."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("feed"), F.col("event_id").alias("checked"), F.to_date("ts").cast("string").alias("modified"))
