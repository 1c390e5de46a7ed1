"""Following feeds: what changed, what is stale, what must be fetched again."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions import scalars as fn


def unchanged_streak(checks: DataFrame, span: int = 100_000) -> DataFrame:
    """``checks(feed, checked, modified)`` with the number of checks in a row, before this one, that
    saw the same value: 0 at the first sighting and after a change.  Values are compared for
    equality, not order.

    A prefix scan in two levels, so that a feed with most of the rows isn't one task: streaks within
    blocks of ``span`` units of ``checked``, then over one row for each block what its first rows
    carry on from the blocks before."""
    rows = checks.withColumn("__b", F.floor(F.col("checked") / span))
    w = Window.partitionBy("feed", "__b").orderBy("checked")
    same = F.col("modified").eqNullSafe(F.lag("modified").over(w)) & (F.row_number().over(w) > 1)
    rows = rows.withColumns({"__c": F.when(same, 0).otherwise(1), "__i": F.row_number().over(w)})
    rows = rows.withColumn("__run", F.sum("__c").over(w))
    rows = rows.withColumn("__s", F.row_number().over(Window.partitionBy("feed", "__b", "__run").orderBy("checked")) - 1)
    edge = lambda f: f(F.struct("modified"), F.col("checked"))
    blocks = rows.groupBy("feed", "__b").agg(edge(F.min_by).alias("head"), edge(F.max_by).alias("tail"), F.max("__run").alias("runs"), F.max_by("__s", "checked").alias("end"), F.count("*").alias("n"))
    order = Window.partitionBy("feed").orderBy("__b")
    joins = F.coalesce(F.col("head").eqNullSafe(F.lag("tail").over(order)), F.lit(False)) & (F.row_number().over(order) > 1)
    whole = F.col("joins") & (F.col("runs") == 1)  # the block only carries on what was before
    blocks = blocks.withColumn("joins", joins).withColumn("__g", F.sum(F.when(whole, 0).otherwise(1)).over(order))
    run = Window.partitionBy("feed", "__g").orderBy("__b")
    # checks of the last value seen, up to the end of the block
    length = F.sum(F.when(whole, F.col("n")).otherwise(F.col("end") + 1)).over(run)
    blocks = blocks.withColumn("length", length)
    carried = F.when(F.col("joins"), F.lag("length").over(order)).otherwise(0)
    blocks = blocks.select("feed", "__b", carried.alias("carried"))
    joined = rows.join(blocks, ["feed", "__b"])
    streak = F.col("__s") + F.when(F.col("__run") == 1, F.col("carried")).otherwise(0)
    return joined.select(*checks.columns, streak.cast("bigint").alias("streak"))


def latest_streaks(checks: DataFrame) -> DataFrame:
    """Per feed its last check and streak."""
    s = unchanged_streak(checks)
    return s.groupBy("feed").agg(F.max("checked").alias("checked"), F.max_by("modified", "checked").alias("modified"), F.max_by("streak", "checked").alias("streak"))


def needs_refresh(listing: DataFrame, inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    """Why each listed file ``(file, modified, size)`` must be fetched again, or null: it isn't in
    ``inventory(file, size, sha256)``, has no record in ``manifest(file, modified, sha256)``, or its
    modification mark, size or checksum differs.  A missing recorded checksum is no reason."""
    have = inventory.select("file", F.col("size").alias("have_size"), F.col("sha256").alias("have_sha"))
    record = manifest.select("file", F.col("modified").alias("rec_modified"), F.col("sha256").alias("rec_sha"), F.lit(True).alias("recorded"))
    reason = (
        F.when(F.col("have_size").isNull(), "absent")
        .when(F.col("recorded").isNull(), "no record")
        .when(~F.col("modified").eqNullSafe(F.col("rec_modified")), "modified")
        .when(F.col("size") != F.col("have_size"), "size")
        .when(F.col("rec_sha") != F.col("have_sha"), "checksum")
    )
    return listing.join(have, "file", "left").join(record, "file", "left").select("file", reason.alias("reason"))


def feed_status_report(subscription: DataFrame, listing: DataFrame, fetched: DataFrame, streaks: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """A verdict for every subscribed feed: 'not listed', 'new' (fetched now), 'stale' or 'current'."""
    there = listing.groupBy("feed").agg(F.max("size").alias("size")).withColumn("__listed", F.lit(True))
    got = fetched.select("feed").distinct().withColumn("__got", F.lit(True))
    s = streaks.select("feed", "streak")
    verdict = (
        F.when(F.col("__listed").isNull(), "not listed")
        .when(F.col("__got").isNotNull(), "new")
        .when(fn.is_stale(F.col("feed"), F.col("streak"), limits), "stale")
        .otherwise("current")
    )
    rows = subscription.join(there, "feed", "left").join(got, "feed", "left").join(s, "feed", "left")
    return rows.select("feed", verdict.alias("verdict"), F.coalesce("streak", F.lit(0)).alias("streak"), F.coalesce("size", F.lit(0)).alias("size"))
