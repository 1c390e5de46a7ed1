"""Merges on natural keys.  Each returns the next state of the table; publishing makes it current."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, failing when it is read if a key is there twice.

    The check is an aggregate on the keys that a merge needs anyway: no separate job."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count("*").alias("__n"), F.any_value(F.struct(*rest) if rest else F.lit(0)).alias("__r"))
    checked = F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("the new rows hold a key twice: "), F.to_json(F.struct(*keys))))).otherwise(F.col("__r"))
    one = one.select(*keys, checked.alias("__r"))
    return one.select(*[F.col(c) if c in keys else F.col(f"__r.{c}").alias(c) for c in df.columns])


def merge_update(base: DataFrame, new: DataFrame, keys: Sequence[str], defaults: Mapping[str, object] | None = None, extend: bool = False) -> DataFrame:
    """Inserts, and on a key match overwrites just the columns that ``new`` has; inserted rows take
    the declared defaults for the others (else null).  ``new`` must have each key once.  A null in a
    key is a value like any other, so a merge that is repeated changes nothing.  With ``extend``, columns
    that only ``new`` has are added, old rows taking the default."""
    defaults = defaults or {}
    n = assert_unique(new, keys).withColumn("__new", F.lit(True))
    b = base.withColumn("__old", F.lit(True)).alias("b")
    joined = b.join(n.alias("n"), [F.col(f"b.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys], "full")
    is_new, is_old = F.col("__new").isNotNull(), F.col("__old").isNotNull()
    added = [c for c in new.columns if extend and c not in base.columns]
    kind = lambda c: (new if c in added else base).schema[c].dataType

    def column(c: str) -> Column:
        if c in keys:
            return F.coalesce(F.col(f"b.{c}"), F.col(f"n.{c}")).alias(c)
        default = F.lit(defaults.get(c)).cast(kind(c))
        if c in added:
            return F.when(is_new, F.col(f"n.{c}")).otherwise(default).alias(c)
        if c in new.columns:
            return F.when(is_new, F.col(f"n.{c}").cast(kind(c))).otherwise(F.col(f"b.{c}")).alias(c)
        return F.when(is_old, F.col(f"b.{c}")).otherwise(default).alias(c)

    return joined.select(*[column(c) for c in [*base.columns, *added]])


def fresh_rows(base: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``new`` whose key ``base`` lacks, nulls in keys being equal; counting them gives
    the true insert count."""
    n, b = assert_unique(new, keys).alias("n"), base.select(*keys).alias("b")
    return n.join(b, [F.col(f"n.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "left_anti")


def merge_insert_only(base: DataFrame, new: DataFrame, keys: Sequence[str], defaults: Mapping[str, object] | None = None, flag: str | None = None) -> DataFrame:
    """Existing rows stay as they are; new keys are added.  ``flag`` names a further column that tells
    the added rows, so that they can be counted while the result is written."""
    added = fresh_rows(base, new, keys)
    given = defaults or {}
    fill = {c: F.lit(given.get(c)).cast(base.schema[c].dataType) for c in base.columns if c not in new.columns}
    added = added.withColumns(fill).select(base.columns)
    if flag:
        base, added = base.withColumn(flag, F.lit(False)), added.withColumn(flag, F.lit(True))
    return base.unionByName(added)


def changed_versions(base: DataFrame, new: DataFrame, keys: Sequence[str], version: str, values: Sequence[str]) -> DataFrame:
    """The rows of ``new`` whose values differ (nulls compared as values) from the newest stored
    version of their key, or whose key is new."""
    newest = base.groupBy(*keys).agg(F.max_by(F.struct(*values), version).alias("__was"))
    rows = new.join(newest, list(keys), "left")
    return rows.where(F.col("__was").isNull() | ~F.struct(*values).eqNullSafe(F.col("__was"))).select(new.columns)


def append_changed_versions(base: DataFrame, new: DataFrame, keys: Sequence[str], version: str, values: Sequence[str]) -> DataFrame:
    """Adds the changed versions; one with a key and version that are there already updates them."""
    return merge_update(base, changed_versions(base, new, keys, version, values), [*keys, version])


def mark_checked(base: DataFrame, codes: DataFrame, day: Column, column: str = "checked") -> DataFrame:
    """Sets one column for the listed codes.  Failed reads must not be in the list."""
    hit = codes.select("code").distinct().withColumn("__hit", F.lit(True))
    return base.join(hit, "code", "left").withColumn(column, F.when(F.col("__hit"), day).otherwise(F.col(column))).select(base.columns)


def evolve_schema(base: DataFrame, added: Mapping[str, tuple[str | DataType, object]], backfill: Mapping[str, str] | None = None) -> DataFrame:
    """Adds columns with a default for the rows there are, and fills nulls of a column from
    another.  A row that stays null in a backfilled column fails."""
    out = base
    for name, (kind, default) in added.items():
        if name not in out.columns:
            out = out.withColumn(name, F.lit(default).cast(kind))
    for name, source in (backfill or {}).items():
        filled = F.coalesce(F.col(name), F.col(source).cast(out.schema[name].dataType))
        out = out.withColumn(name, F.when(filled.isNull(), F.raise_error(F.lit(f"{name} can't be filled"))).otherwise(filled))
    return out
