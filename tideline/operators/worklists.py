"""Work lists: what should be there and isn't."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.normalize import universe_predicate


def pending_periods(codes: DataFrame, periods: DataFrame, present: DataFrame, listed_from: str | None = None) -> DataFrame:
    """(code, period) pairs that aren't present.  The periods of all time are a short list (more than
    10,000 are refused), so codes times periods is an explode.  ``listed_from`` names a column of
    ``codes`` with a first period."""
    names = [r["period"] for r in periods.select("period").distinct().orderBy("period").limit(10_001).collect()]
    if len(names) > 10_000:
        raise ValueError("that many periods aren't fiscal periods")
    wanted = codes.withColumn("period", F.explode(F.array(*[F.lit(x) for x in names]).cast("array<string>")))
    if listed_from:
        wanted = wanted.where(F.col("period") >= F.col(listed_from)).drop(listed_from)
    return wanted.join(present.select("code", "period"), ["code", "period"], "left_anti")


def shares_worklist(bars: DataFrame, shares: DataFrame, source: str) -> DataFrame:
    """Codes with bars of a source and no share count, with their first and last bar."""
    own = bars.where(F.col("source") == source).groupBy("code").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    return own.join(shares.select("code"), "code", "left_anti")


def flow_worklist(bars: DataFrame, flow: DataFrame, source: str) -> DataFrame:
    return bars.where(F.col("source") == source).select("code").distinct().join(flow.select("code"), "code", "left_anti")


def delisted_bars_worklist(master: DataFrame, bars: DataFrame, source: str, start: Column, markets: Sequence[str], refetch: bool = False) -> DataFrame:
    """Delisted codes of the universe that were neither fetched nor checked; all of them when they
    are fetched again."""
    rows = master.where(universe_predicate(start, markets))
    if not refetch:
        rows = rows.where("checked is null").join(bars.where(F.col("source") == source).select("code"), "code", "left_anti")
    return rows.select("code", "last_trade_date")


def coverage_missing(master: DataFrame, table: DataFrame, day: Column, days: int = 0) -> DataFrame:
    """Codes of the master without a row on the day (or in the ``days`` up to it)."""
    there = table.where(F.col("date").between(F.date_sub(day, days), day)).select("code")
    return master.select("code").join(there, "code", "left_anti")


def pending_today(universe: DataFrame, snapshots: DataFrame, day: Column) -> DataFrame:
    return universe.join(snapshots.where(F.col("date") == day).select("code"), "code", "left_anti")


def map_identifiers(codes: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Codes with their other identifier, and those that have none."""
    return codes.join(mapping, "code"), codes.join(mapping, "code", "left_anti")


def matched(dated: DataFrame) -> DataFrame:
    """How many codes of :func:`attach_last_trade_date` have bars, and how many don't."""
    return dated.agg(F.count("last_trade_date").alias("matched"), F.count_if(F.col("last_trade_date").isNull()).alias("unmatched"))


def attach_last_trade_date(master: DataFrame, bars: DataFrame) -> DataFrame:
    """The master with each code's last bar, null without any."""
    return master.join(bars.groupBy("code").agg(F.max("date").alias("last_trade_date")), "code", "left")


def plan_vs_listing(subscription: DataFrame, listing: DataFrame) -> DataFrame:
    """Each subscribed feed and whether the listing has it; other listings are ignored."""
    there = listing.select("feed").distinct().withColumn("listed", F.lit(True))
    return subscription.join(there, "feed", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))


def fill_requested(requested: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """A row for everything requested, null where there is no result; other results are dropped."""
    return requested.join(results, key, "left")


def codes_with_rows(codes: DataFrame, table: DataFrame, cutoff: Column | None = None) -> DataFrame:
    rows = table if cutoff is None else table.where(F.col("date") >= cutoff)
    return codes.join(rows.select("code"), "code", "left_semi")


def swept(codes: DataFrame, bars: DataFrame, flow: DataFrame, cutoff: Column) -> DataFrame:
    """Codes a sweep can skip: they have bars and recent flow."""
    return codes_with_rows(codes_with_rows(codes, bars), flow, cutoff)


def top_n_liquid(bars: DataFrame, n: int = 800, days: int = 90) -> DataFrame:
    return liquidity(bars, days).orderBy(F.desc("avg_value"), "code").limit(n)


def liquidity(bars: DataFrame, days: int = 90) -> DataFrame:
    """Average traded value of each code over the days before the newest date of all."""
    newest = bars.agg(F.max("date")).scalar()
    return bars.where(F.col("date") >= F.date_sub(newest, days)).groupBy("code").agg(F.avg("trade_value").alias("avg_value"))


def all_codes(*tables: DataFrame) -> DataFrame:
    """All different codes in order."""
    out = tables[0].select("code")
    for t in tables[1:]:
        out = out.unionByName(t.select("code"))
    return out.distinct().orderBy("code")


def head_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def series(df: DataFrame, code: str) -> DataFrame:
    return df.where(F.col("code") == code).orderBy("date")


def batch_worklist(pending: DataFrame, size: int = 100, groups: int = 64) -> DataFrame:
    """Pending (code, period) pairs dealt into batches of at most ``size`` codes of one period, in the
    order of their codes.

    Numbered in two levels, so that a period isn't one task: within ranges of codes, and over one row for
    each range what stands before it.  The ranges hold about equally many pairs: their bounds are
    quantiles of the seven bytes of a code that follow what all codes begin with, as a number."""
    ends = [os.fsencode(x or "") for x in pending.agg(F.min("code"), F.max("code")).first()]
    same = len(os.path.commonprefix(ends))
    digits = F.rpad(F.hex(F.substring(F.encode("code", "UTF-8"), same + 1, 7)), 14, "0")
    number = F.conv(digits, 16, 10).cast("bigint")
    bounds = pending.agg(F.percentile_approx(number, [(k + 1) / groups for k in range(groups - 1)], 10_000)).first()[0] or []
    held = F.array(*[F.lit(b) for b in sorted(set(bounds))]).cast("array<bigint>")
    rows = pending.withColumn("__n", number).withColumn("__p", F.coalesce(F.size(F.filter(held, lambda b: b <= F.col("__n"))), F.lit(-1))).drop("__n")
    parts = rows.groupBy("period", "__p").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("period").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("period", "__p", F.coalesce(before, F.lit(0)).alias("__before"))
    at = F.row_number().over(Window.partitionBy("period", "__p").orderBy("code")) - 1
    numbered = rows.withColumn("__at", at).join(parts, ["period", "__p"])
    return numbered.withColumn("batch", F.floor((F.col("__before") + F.col("__at")) / size).cast("bigint")).select(*pending.columns, "batch")


def trading_calendar(bars: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """The different dates between the bounds, either of which may be open."""
    rows = bars.select("date")
    if start is not None:
        rows = rows.where(F.col("date") >= start)
    if end is not None:
        rows = rows.where(F.col("date") <= end)
    return rows.distinct()


def concat(*parts: DataFrame) -> DataFrame:
    """Pages, markets or scopes one below the other, by name; missing columns are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def difference(wanted: DataFrame, there: DataFrame, *keys: str) -> DataFrame:
    return wanted.join(there, list(keys), "left_anti")


def dedupe_first(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def dedupe_last(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """The last value of each key."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def legs(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Counts of several work lists as rows ``(leg, missing)``."""
    counted = [df.agg(F.count("*").alias("missing")).select(F.lit(name).alias("leg"), "missing") for name, df in parts.items()]
    return concat(*counted)


def coverage_report(master: DataFrame, tables: Mapping[str, tuple[DataFrame, int]], day: Column) -> DataFrame:
    """Per leg of ``tables`` (a table and how many days back count) ``(leg, codes, missing, share)``:
    how many codes of the master have no row, and what share of them that is."""
    total = master.select("code").distinct().agg(F.count("*").alias("codes"))
    missing = legs({name: coverage_missing(master.select("code").distinct(), table, day, days) for name, (table, days) in tables.items()})
    share = F.try_divide(F.col("missing").cast("double"), F.col("codes").cast("double"))
    return missing.withColumn("codes", total.scalar()).select("leg", "codes", "missing", F.coalesce(share, F.lit(0.0)).alias("share"))
