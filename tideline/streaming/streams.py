"""Incremental merges with Structured Streaming.

Each stream works through ``foreachBatch`` on a table in generations.  The commit that publishes a batch
notes the stream and the batch, and a batch that is noted is skipped, so a replay after a crash does
no harm, whatever else has been written to the table before, between or after.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tideline.operators import feeds, merge, publish

STREAKS = "feed string, checked bigint, modified string, streak bigint"
Writer = tuple[str, int]


def run(source: DataFrame, step: Callable[[DataFrame, Writer], None], root: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Runs a stream over what there is now, batch by batch.  ``step`` gets each batch with its writer:
    the id that Spark keeps for the stream in its checkpoint, and the number of the batch.  A batch is
    computed once, since that also moves the stream's state, and kept beside the checkpoint for the
    step's several uses; one that is in the table is skipped."""

    def once(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        writer = (publish._read(spark, f"{checkpoint}/metadata")["id"], number)
        if not publish.batch_done(spark, root, writer):
            held = f"{checkpoint}-held/{number}"
            batch.write.mode("overwrite").parquet(held)
            step(spark.read.schema(batch.schema).parquet(held), writer)
            publish.delete(spark, held)

    query = source.writeStream.foreachBatch(once).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def files(spark: SparkSession, path: str, schema: StructType | str, per_batch: int | None = None) -> DataFrame:
    """The files of a folder as a stream: all that are new in a batch, or ``per_batch`` at a time."""
    reader = spark.readStream.schema(schema)
    return (reader if per_batch is None else reader.option("maxFilesPerTrigger", per_batch)).parquet(path)


def year_of(column: str) -> Column:
    """The partition of a date, or of a text such as ``2020Q1`` that begins with a year."""
    return F.substring(F.col(column).cast("string"), 1, 4)


def _own_folder(root: str, writer: Writer) -> str:
    return f"{root}/batch={writer[0]}-{writer[1]}"


def stream_upsert(source: DataFrame, root: str, keys: Sequence[str], order: str, checkpoint: str, part: Column, insert_only: bool = False) -> None:
    """Merges every batch into the table in parts below ``root``, rewriting the partitions ``part`` that
    it touches; of rows with one key in a batch the last by ``order`` counts.  Rows of one key must
    share a partition.  The table may hold rows before, and others may write to it meanwhile."""
    names = [f.name for f in source.schema if f.name != order]
    rest = [c for c in names if c not in keys]
    pick = F.min_by if insert_only else F.max_by
    how = merge.merge_insert_only if insert_only else merge.merge_update

    def step(batch: DataFrame, writer: Writer) -> None:
        once = batch.groupBy(*keys).agg(pick(F.struct(*rest), F.col(order)).alias("r")).select(*keys, "r.*").select(*names)
        publish.update(once, root, part, lambda base, new: how(base, new, keys), keep=1, writer=writer)

    run(source, step, root, checkpoint)


def stream_versions(source: DataFrame, root: str, keys: Sequence[str], version: str, values: Sequence[str], checkpoint: str, part: Column, lateness: str | None = None) -> StreamingQuery:
    """Late corrections become versions, unchanged readings vanish.

    Without ``lateness`` the versions of a key must arrive in order of ``version``, over batches and in
    any order within one.  With a ``lateness``, such as ``"30 days"``, they may arrive that much
    later than the newest version seen: readings wait in Spark's state store, keyed and
    grouped by version, until the watermark has passed them, and then go on in order.  So the state
    holds the readings of that time and no more.  Of two readings of one key and version the greater
    counts.  A reading that comes later still can't be put in order any more: the stream fails and names how many
    there were, since dropping them in silence would lose corrections.  The last ``lateness`` of
    readings is published when newer ones arrive.

    ``part`` is the partition of a row, the same for all versions of a key; those that a batch touches
    are rewritten."""
    names = source.schema.fieldNames()

    def grow(base: DataFrame, new: DataFrame) -> DataFrame:
        both = base.select(*names).withColumn("__new", F.lit(False)).unionByName(new.withColumn("__new", F.lit(True)))
        w = Window.partitionBy(*keys).orderBy(version, "__new")
        same = F.struct(*values).eqNullSafe(F.lag(F.struct(*values)).over(w)) & (F.row_number().over(w) > 1)
        return both.withColumn("__same", same).where("not __new or not __same").select(names)

    def step(batch: DataFrame, writer: Writer) -> None:
        publish.update(batch, root, part, grow, keep=1, writer=writer)

    if lateness is None:
        return run(source, step, root, checkpoint)
    rest = [c for c in names if c not in keys and c != version]
    timed = source.withColumn("__at", F.col(version).cast("timestamp")).withWatermark("__at", lateness)
    waiting = timed.groupBy(*keys, "__at").agg(F.max(F.struct(version, *rest)).alias("r"))
    query = run(waiting, lambda batch, writer: step(batch.select(*keys, "r.*").select(*names), writer), root, checkpoint)
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    if dropped:
        raise ValueError(f"{dropped} readings of {root} came more than {lateness} late")
    return query


def stream_late_window(source: DataFrame, root: str, late: str, keys: Sequence[str], order: str, days: int, checkpoint: str, part: Column, date_col: str = "date") -> None:
    """Rows within ``days`` of the newest date seen are merged, the last value winning, which rewrites
    the partitions ``part`` that they touch; older ones go to the ``late`` table for the next full
    merge.  The newest date is that of the table's statistics or of the batch.  A batch may be late as a
    whole: it then leaves the table as it is."""
    names = [f.name for f in source.schema if f.name != order]
    rest = [c for c in names if c not in keys]

    def step(batch: DataFrame, writer: Writer) -> None:
        spark = batch.sparkSession
        last = publish.latest(spark, root)
        held = F.lit(last.newest if last else None).cast("date")
        newest = batch.agg(F.greatest(F.max(date_col).cast("date"), held).alias("d")).first()["d"]
        fresh = F.coalesce(F.col(date_col) >= F.date_sub(F.lit(newest).cast("date"), days), F.lit(False))
        batch.where(~fresh).write.mode("overwrite").parquet(_own_folder(late, writer))
        once = batch.where(fresh).groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")).select(*keys, "r.*")
        publish.update(once.select(names), root, part, lambda base, new: merge.merge_update(base, new, keys), keep=1, date_col=date_col, writer=writer)

    run(source, step, root, checkpoint)


def stream_streaks(source: DataFrame, root: str, out: str, checkpoint: str) -> None:
    """``source(feed, checked, modified)`` to running streaks, written below ``out``; the last value and
    streak of each feed are the table in generations below ``root``.  Checks of a feed must arrive in
    order over batches.

    A batch is counted like a whole table, in two levels, with each feed's last check put before it;
    what carries on that check's run takes over its streak."""

    def step(batch: DataFrame, writer: Writer) -> None:
        spark = batch.sparkSession
        held = publish.current(spark, root)
        held = spark.createDataFrame([], STREAKS) if held is None else held
        before = held.select("feed", F.col("checked").alias("__at"), F.col("streak").alias("__had"))
        rows = feeds.unchanged_streak(batch.select("feed", "checked", "modified").unionByName(held.select("feed", "checked", "modified")))
        rows = rows.join(before, "feed", "left").where("__at is null or checked > __at")
        ends = rows.where("streak = 0").groupBy("feed").agg(F.min("checked").alias("__end"))
        carried = F.col("__at").isNotNull() & (F.col("__end").isNull() | (F.col("checked") < F.col("__end")))
        streak = F.col("streak") + F.when(carried, F.col("__had")).otherwise(0)
        rows = rows.join(ends, "feed", "left").select("feed", "checked", "modified", streak.alias("streak"))
        folder = _own_folder(out, writer)
        rows.write.mode("overwrite").parquet(folder)
        done = spark.read.schema(STREAKS).parquet(folder).unionByName(held)
        last = F.max_by(F.struct("modified", "streak"), "checked").alias("r")
        publish.publish(done.groupBy("feed").agg(F.max("checked").alias("checked"), last).select("feed", "checked", "r.*"), root, keep=1, writer=writer)

    run(source, step, root, checkpoint)
