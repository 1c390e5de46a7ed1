"""Profiles, audits and gates.  A gate is a DataFrame of failures: none means that it passes."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.worklists import concat


def latest_date_per_code(df: DataFrame) -> DataFrame:
    return df.groupBy("code").agg(F.max("date").alias("latest"))


def trading_span(df: DataFrame) -> DataFrame:
    return df.groupBy("code").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def table_counts(tables: Mapping[str, DataFrame | None], date_cols: Mapping[str, str] | None = None) -> DataFrame:
    """``(table, rows, newest)``; an absent table (None) has null rows, which isn't 0."""
    dates = date_cols or {}
    out = []
    for name, df in sorted(tables.items()):
        if df is None:
            one = next(t for t in tables.values() if t is not None).sparkSession.range(1).select(F.lit(None).cast("bigint").alias("rows"), F.lit(None).cast("date").alias("newest"))
        else:
            newest = F.max(dates[name]).cast("date") if name in dates else F.lit(None).cast("date")
            one = df.agg(F.count("*").alias("rows"), newest.alias("newest"))
        out.append(one.select(F.lit(name).alias("table"), "rows", "newest"))
    return concat(*out)


def counts_by(df: DataFrame, table: Column, expected: Sequence[str], absent: Sequence[str] = (), date_col: str = "date") -> DataFrame:
    """:func:`table_counts` of tables that lie in one frame, ``table`` naming each row's, by one scan and one
    aggregate.  Expected tables without a row have 0 rows, absent ones null."""
    names = df.sparkSession.createDataFrame([(n, n in absent) for n in sorted({*expected, *absent})], "table string, gone boolean")
    found = df.select(table.alias("table"), F.col(date_col).cast("date").alias("d")).groupBy("table").agg(F.count("*").alias("n"), F.max("d").alias("newest"))
    rows = F.when(~F.col("gone"), F.coalesce("n", F.lit(0)))
    return names.join(found, "table", "left").select("table", rows.alias("rows"), F.when(~F.col("gone"), F.col("newest")).alias("newest"))


def newest_date(df: DataFrame | None, column: str = "date") -> DataFrame | None:
    return None if df is None else df.agg(F.max(column).alias("newest"))


def source_profile(df: DataFrame, nullable: str) -> DataFrame:
    """By source: rows, different codes, rows that know a nullable column."""
    return df.groupBy("source").agg(F.count("*").alias("rows"), F.countDistinct("code").alias("codes"), F.count(nullable).alias("known"))


def duplicate_versions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys are there more than once; 0 is expected."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("duplicates"))


def checked_profile(df: DataFrame, column: str = "checked") -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNotNull()).alias("checked"), F.count_if(F.col(column).isNull()).alias("unchecked"))


def run_summary(outcomes: DataFrame) -> DataFrame:
    """``outcomes(code, outcome, rows)`` to done, skipped, failed and rows."""
    n = lambda x: F.count_if(F.col("outcome") == x)
    return outcomes.agg(n("done").alias("done"), n("skipped").alias("skipped"), n("failed").alias("failed"), F.coalesce(F.sum(F.when(F.col("outcome") == "done", F.col("rows"))), F.lit(0)).alias("rows"))


def failure_rate_gate(outcomes: DataFrame, limit: float = 0.2) -> DataFrame:
    """Fails above the limit of failed among attempted; nothing attempted passes."""
    s = run_summary(outcomes)
    rate = F.try_divide(F.col("failed").cast("double"), (F.col("done") + F.col("failed")).cast("double"))
    return s.select("done", "failed", F.coalesce(rate, F.lit(0.0)).alias("rate")).where(F.col("rate") > limit)


def status_totals(report: DataFrame) -> DataFrame:
    """Feeds and bytes by verdict."""
    return report.groupBy("verdict").agg(F.count("*").alias("feeds"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def market_latest(bars: DataFrame, reference: str, base: Column) -> DataFrame:
    """The newest date of a reference code, or the base date if it has none."""
    return bars.agg(F.coalesce(F.max(F.when(F.col("code") == reference, F.col("date"))), base).alias("latest"))


def exact_quantiles(df: DataFrame, value: Column, shares: Mapping[str, float], accuracy: int = 10_000) -> DataFrame:
    """One row with the interpolated quantiles of ``value``, nulls left out, by column name.

    A sketch, whose rank error is bounded by its accuracy, brackets each quantile; values below the
    brackets are counted and only those within are ranked, so no task gets more than a few parts in
    ``accuracy`` of the values."""
    rows = df.select(value.cast("double").alias("v")).where("v is not null")
    names, n = list(shares), rows.count()
    if not n:
        return rows.agg(*[F.lit(None).cast("double").alias(k) for k in names])
    wide = 3.0 / accuracy + 2.0 / n  # the sketch's error and the places beside a quantile
    ends = [min(1.0, max(0.0, shares[k] + side)) for k in names for side in (-wide, wide)]
    known = rows.agg(F.percentile_approx("v", ends, accuracy).alias("ends")).first()
    spark, found = df.sparkSession, []
    for i, k in enumerate(names):
        place = (n - 1) * shares[k]
        lo = float("-inf") if ends[2 * i] <= 0 else known["ends"][2 * i]
        hi = float("inf") if ends[2 * i + 1] >= 1 else known["ends"][2 * i + 1]
        found.append((k, lo, hi, math.floor(place), math.ceil(place), place - math.floor(place)))
    near = [F.when(F.col("v").between(lo, hi), F.lit(i)) for i, (_, lo, hi, *_) in enumerate(found)]
    counted = rows.groupBy("v", F.array_compact(F.array(*near)).alias("near")).agg(F.count("*").alias("n")).where("size(near) > 0")
    below = rows.agg(*[F.count_if(F.col("v") < lo).alias(f"b{i}") for i, (_, lo, *_) in enumerate(found)])
    brackets = spark.createDataFrame([(i, a, b, part) for i, (_, _, _, a, b, part) in enumerate(found)], "q int, a bigint, b bigint, part double")
    before = F.element_at(F.array(*[below.select(f"b{i}").scalar() for i in range(len(found))]), F.col("q") + 1)
    ranked = counted.select(F.explode("near").alias("q"), "v", "n")
    upto = before + F.sum("n").over(Window.partitionBy("q").orderBy("v"))
    ranked = ranked.withColumn("upto", upto).join(brackets, "q")
    at = lambda rank: F.min(F.when(F.col("upto") > F.col(rank), F.col("v")))
    picked = ranked.groupBy("q").agg(at("a").alias("x"), at("b").alias("y"), F.first("part").alias("part"))
    each = picked.select("q", ((1 - F.col("part")) * F.col("x") + F.col("part") * F.col("y")).alias("v"))
    return each.agg(*[F.max(F.when(F.col("q") == i, F.col("v"))).alias(k) for i, k in enumerate(names)])


def approx_error_profile(df: DataFrame, approx: str, reported: str) -> DataFrame:
    """Quantiles of the relative error of an approximation."""
    e = F.try_divide(F.abs(F.col(approx) - F.col(reported)).cast("double"), F.abs(F.col(reported)).cast("double"))
    return exact_quantiles(df, e, {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def flow_residual(df: DataFrame) -> DataFrame:
    """By source how far individual, foreign, institution and other add up to nothing."""
    r = F.col("individual") + F.col("foreign_") + F.col("institution") + F.col("other_corp")
    return df.groupBy("source").agg(F.count(r).alias("known"), F.count_if(r == 0).alias("balanced"), F.sum(F.abs(r)).alias("residual"))


def gate_presence(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected tables that are missing or empty."""
    rows = expected.join(counts, "table", "left")
    reason = F.when(F.col("rows").isNull(), F.lit("missing")).when(F.col("rows") == 0, F.lit("empty"))
    return rows.select("table", reason.alias("reason")).where("reason is not null")


def compare_to_baseline(now: DataFrame, was: DataFrame) -> DataFrame:
    return now.join(was.select("table", F.col("rows").alias("was_rows"), F.col("newest").alias("was_newest")), "table", "left")


def gate_row_regression(compared: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Tables that shrank by more than the tolerance; without a baseline a table passes."""
    return compared.where(F.col("rows") < F.col("was_rows") * (1 - tolerance)).select("table", "rows", "was_rows")


def without_baseline(compared: DataFrame) -> DataFrame:
    """Tables that nothing is known of from before: the regression gates skip them, which is worth a
    warning."""
    return compared.where(F.col("was_rows").isNull() & F.col("was_newest").isNull()).select("table")


def gate_date_regression(compared: DataFrame) -> DataFrame:
    """Tables whose newest date went back, or is gone."""
    return compared.where(F.col("was_newest").isNotNull() & (F.col("newest").isNull() | (F.col("newest") < F.col("was_newest")))).select("table", "newest", "was_newest")


def bar_consistency(bars: DataFrame) -> DataFrame:
    """Bars whose low or high doesn't hold open and close."""
    return bars.where((F.col("low") > F.least("open", "close")) | (F.col("high") < F.greatest("open", "close")))


def pit_violations(df: DataFrame, known: str, about: str) -> DataFrame:
    """Rows, and those known before what they are about."""
    return df.agg(F.count("*").alias("rows"), F.count_if(F.col(known) < F.col(about)).alias("violations"))


def drop_pit_violations(df: DataFrame, known: str, about: str, most: float = 0.01) -> DataFrame:
    """``df`` without such rows; fails if their share is above ``most``."""
    n = pit_violations(df, known, about).first()
    if n["violations"] > most * max(1, n["rows"]):
        raise ValueError(f"{n['violations']} of {n['rows']} rows are known before what they are about")
    return df.where(~F.coalesce(F.col(known) < F.col(about), F.lit(False)))


def vendor_rules(df: DataFrame) -> DataFrame:
    """Market cap and enterprise value from millions to units, ``isdelisted`` (Y/N) as a boolean
    ``is_delisted``, and ``closeadj`` in place of ``close`` as the adjusted price."""
    out = df.withColumns({c: F.col(c) * 1_000_000 for c in ("mcap", "ev") if c in df.columns})
    if "isdelisted" in out.columns:
        out = out.withColumn("is_delisted", F.upper("isdelisted") == "Y").drop("isdelisted")
    if {"close", "closeadj"} <= set(out.columns):
        out = out.withColumnRenamed("close", "close_split").withColumnRenamed("closeadj", "close")
    return out


def not_empty(df: DataFrame, what: str) -> DataFrame:
    """``df``, failing now if it is empty: a run without rows where some are due has failed."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows, though some are due")
    return df
