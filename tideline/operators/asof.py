"""Reading versions as of a date, and backward as-of joins that don't blow up a key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tideline.operators.clustered import Layout, block

KEYS = ("code", "period")


def newest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row of each key with the latest version, by one partial aggregate."""
    rest = [c for c in df.columns if c not in keys and c != version]
    best = F.max_by(F.struct(*rest), F.struct(version, *[c for c in rest])) if rest else F.lit(None)
    out = df.groupBy(*keys).agg(best.alias("__r"), F.max(version).alias(version))
    return out.select(*[F.col(c) if c in keys or c == version else F.col(f"__r.{c}").alias(c) for c in df.columns])


def latest_version(df: DataFrame, periods: DataFrame | None = None) -> DataFrame:
    """The newest version of each (code, period), of the given periods only."""
    rows = df if periods is None else df.join(periods.select("period"), "period", "left_semi")
    return newest_per_key(rows, KEYS, "knowledge_date")


def asof_earnings(df: DataFrame, asof: Column) -> DataFrame:
    """What was known at ``asof``: the newest version of each key that isn't later."""
    return newest_per_key(df.where(F.col("knowledge_date") <= asof), KEYS, "knowledge_date")


def _scanned(rows: DataFrame, order: Sequence[Column], within: Column, over: Callable[[WindowSpec], Column], summary: Column, days: int, forward: bool = True, layout: Layout | None = None) -> DataFrame:
    """``rows`` with ``__here``, a running value within blocks of ``days`` of a code, and ``__carry``, the same
    over the blocks before (after, if not ``forward``).

    A prefix scan in two levels: ``over`` gives an associative running value by a window, ``summary`` that
    of a whole block by an aggregate.  A code's rows are dealt by block, so that one with most of the rows
    isn't one task; only a row for each block is scanned by code alone.  With a ``layout`` the rows are
    dealt that way already, only the blocks move, and ``__here`` holds the carry too; further rows, of a null ``__o``,
    stand for the blocks."""
    # keys without nulls, so that the join below finds the rows dealt as the window has left them
    key = [*(["__at"] if layout else []), "__k", "__u", "__b"]
    rows = rows.withColumns({"__k": F.coalesce(F.col("code").cast("string"), F.lit("")), "__u": F.col("code").isNull(), "__b": block(within, layout.days if layout else days)})
    blocks = rows.groupBy(*key).agg(summary.alias("__v"))  # under the name that ``over`` reads
    before = Window.partitionBy("__k", "__u").orderBy("__b" if forward else F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*key, over(before).alias("__carry"))
    w = Window.partitionBy(*key).rowsBetween(Window.unboundedPreceding, 0)
    if layout:
        # what a block carries is its first row: a union leaves the rows where they are, a join on all keys would not
        first = layout.place(blocks.withColumnRenamed("__carry", "__v").where("__v is not null"))
        rows = rows.withColumn("__f", F.lit(1)).unionByName(first.withColumn("__f", F.lit(0)), allowMissingColumns=True)
        here = over(w.orderBy("__f", *order))
        return rows.withColumn("__here", here).withColumn("__carry", F.lit(None).cast(rows.schema["__v"].dataType))
    w = w.orderBy(*order)
    return rows.withColumn("__here", over(w)).join(blocks, key, "left")


def asof_shares(bars: DataFrame, shares: DataFrame, value: str = "shares", days: int = 366, layout: Layout | None = None) -> DataFrame:
    """``bars`` with the latest share count dated at or before each bar (null before the first).

    A union and a running last value by code, carried over blocks of ``days``: no row is paired with
    another, and a code runs in as many tasks as it has blocks.  On an equal date the count comes first.
    Bars of a clustered table, given with its ``layout``, stay where they are, and so does the result."""
    columns = bars.columns
    left = bars.select(*columns, F.lit(None).cast(shares.schema[value].dataType).alias("__v"), F.lit(1).alias("__o"))
    right = shares.select("code", "date", F.col(value).alias("__v")).withColumn("__o", F.lit(0))
    right = layout.deal(right) if layout else right
    both = left.unionByName(right, allowMissingColumns=True)
    last = lambda w: F.last("__v", ignorenulls=True).over(w)
    point = F.struct(F.coalesce(F.unix_date("date"), F.lit(-(1 << 30))), "__o")
    newest = F.max_by("__v", F.when(F.col("__v").isNotNull(), point))
    out = _scanned(both, [F.asc("date"), F.asc("__o")], F.col("date"), last, newest, days, layout=layout)
    return out.withColumn(value, F.coalesce("__here", "__carry")).where("__o = 1").select(*columns, value)


def market_cap_asof(bars: DataFrame, shares: DataFrame, layout: Layout | None = None) -> DataFrame:
    return asof_shares(bars, shares, layout=layout).withColumn("market_cap", F.col("close") * F.col("shares"))


def asof_shares_pit(bars: DataFrame, shares: DataFrame, days: int = 366, layout: Layout | None = None) -> DataFrame:
    """As :func:`asof_shares`, but a count matters only from the day it was known.

    Each count enters at the later of its date and its knowledge date; the running maximum of
    (date, count) is the latest count among those that entered."""
    columns = bars.columns
    point = F.struct("date", "shares")
    left = bars.select(*columns, F.col("date").alias("__t"), F.lit(1).alias("__o"))
    right = shares.select("code", F.greatest("date", F.coalesce("knowledge_date", "date")).alias("__t"), point.alias("__v"), F.lit(0).alias("__o"))
    right = layout.deal(right, "__t") if layout else right
    both = left.unionByName(right, allowMissingColumns=True)
    out = _scanned(both, [F.asc("__t"), F.asc("__o")], F.col("__t"), lambda w: F.max("__v").over(w), F.max("__v"), days, layout=layout)
    return out.withColumn("shares", F.greatest("__here", "__carry")["shares"]).where("__o = 1").select(*columns, "shares")


def back_adjust(bars: DataFrame, factors: DataFrame, prices: Sequence[str] = ("open", "high", "low", "close"), days: int = 366, layout: Layout | None = None) -> DataFrame:
    """Prices times the product of the factors of all later events ``(code, date, factor)`` of the
    code, carried over blocks of ``days``.  Volume, traded value and source stay as they are."""
    columns = bars.columns
    left = bars.withColumn("__v", F.lit(None).cast("double")).withColumn("__o", F.lit(0))
    right = factors.select("code", "date", F.col("factor").cast("double").alias("__v"), F.lit(1).alias("__o"))
    right = layout.deal(right) if layout else right
    both = left.unionByName(right, allowMissingColumns=True)
    # by falling date; events of the bar's own day come after it
    out = _scanned(both, [F.desc("date"), F.asc("__o")], F.col("date"), lambda w: F.product("__v").over(w), F.product("__v"), days, forward=False, layout=layout)
    out = out.withColumn("__p", F.coalesce("__here", F.lit(1.0)) * F.coalesce("__carry", F.lit(1.0))).where("__o = 0")
    return out.select(*[(F.col(c).cast("double") * F.col("__p")).alias(c) if c in prices else F.col(c) for c in columns])
