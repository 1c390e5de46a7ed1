"""Tables kept clustered by code and block of days, so that merges, as-of joins and back-adjustment leave
them where they are.

A :class:`Layout` says into how many buckets a table is dealt.  Its files are bucketed by a hash of the code
and of the block of days that a row's date falls in, so the rows of a key lie in one bucket, and a code with
most of the rows lies in as many as it has blocks.  Spark knows the layout of such a frame: what is united
with it or joined to it is dealt the same way, and the table itself takes part without an exchange.

Frames of a clustered table (``publish.clustered``) carry the hash as ``__at``; operators keep it, and what they
return is written without an exchange too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block(date: Column, days: int) -> Column:
    """The block of ``days`` that a date falls in; null dates have one of their own."""
    return F.coalesce(F.floor(F.unix_date(date) / days), F.lit(-(1 << 40)))


@dataclass(frozen=True)
class Layout:
    """Rows of a code and a block of ``days`` lie in one of ``buckets``.  Choose these so that a bucket of a
    part fits a task's memory; they stay as the table was first written."""

    buckets: int
    days: int = 366

    def at(self, date: str = "date") -> Column:
        return F.xxhash64(F.col("code").cast("string"), block(F.col(date), self.days))

    def place(self, df: DataFrame) -> DataFrame:
        """``df``, which holds ``__at``, dealt as the table is."""
        return df.repartition(self.buckets, "__at")

    def deal(self, df: DataFrame, date: str = "date") -> DataFrame:
        return self.place(df.withColumn("__at", self.at(date)))


def _met(base: DataFrame, new: DataFrame, layout: Layout, keys: Sequence[str]) -> DataFrame:
    """For each key the row of ``base`` as ``__b`` and that of ``new`` as ``__n``, either null where there is none.

    A union and one aggregate in place of a full join, whose result would no longer be known to be dealt
    as the table is.  Null keys are equal; a key that is twice on one side fails when it is read."""
    new = new.withColumns({k: F.col(k).cast(base.schema[k].dataType) for k in keys})
    row = lambda df: F.struct(F.lit(True).alias("__is"), *[c for c in df.columns if c not in (*keys, "__at")])
    old, came = base.select("__at", *keys, row(base).alias("__b")), layout.deal(new).select("__at", *keys, row(new).alias("__n"))
    one = old.unionByName(came, allowMissingColumns=True).groupBy("__at", *keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("__b", "__n")], *[F.count(c).alias(f"{c}s") for c in ("__b", "__n")])
    twice = lambda c, which: F.when(F.col(f"{c}s") > 1, F.raise_error(F.concat(F.lit(f"the {which} rows hold a key twice: "), F.to_json(F.struct(*keys))))).otherwise(F.col(c)).alias(c)
    return one.select("__at", *keys, twice("__b", "stored"), twice("__n", "new"))


def merge_update(base: DataFrame, new: DataFrame, layout: Layout, keys: Sequence[str], defaults: Mapping[str, object] | None = None, extend: bool = False) -> DataFrame:
    """As ``merge.merge_update``, for a ``base`` that is clustered: only ``new`` is dealt.  ``keys`` must hold
    code and date, and a stored key must be there once."""
    given = defaults or {}
    added = [c for c in new.columns if extend and c not in base.columns]
    is_new, is_old = F.col("__n").isNotNull(), F.col("__b").isNotNull()

    def column(c: str) -> Column:
        if c in (*keys, "__at"):
            return F.col(c)
        kind = (new if c in added else base).schema[c].dataType
        default = F.lit(given.get(c)).cast(kind)
        if c in added:
            return F.when(is_new, F.col(f"__n.{c}")).otherwise(default).alias(c)
        if c in new.columns:
            return F.when(is_new, F.col(f"__n.{c}").cast(kind)).otherwise(F.col(f"__b.{c}")).alias(c)
        return F.when(is_old, F.col(f"__b.{c}")).otherwise(default).alias(c)

    return _met(base, new, layout, keys).select(*[column(c) for c in [*base.columns, *added]])


def merge_insert_only(base: DataFrame, new: DataFrame, layout: Layout, keys: Sequence[str], defaults: Mapping[str, object] | None = None, flag: str | None = None) -> DataFrame:
    """As ``merge.merge_insert_only``, for a ``base`` that is clustered."""
    given, is_old = defaults or {}, F.col("__b").isNotNull()

    def column(c: str) -> Column:
        if c in (*keys, "__at"):
            return F.col(c)
        kind = base.schema[c].dataType
        fresh = F.col(f"__n.{c}") if c in new.columns else F.lit(given.get(c))
        return F.when(is_old, F.col(f"__b.{c}")).otherwise(fresh.cast(kind)).alias(c)

    further = [(~is_old).alias(flag)] if flag else []
    return _met(base, new, layout, keys).select(*[column(c) for c in base.columns], *further)
