"""Queries: merges, publishing, streams and jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators import asof, merge, publish, worklists
from tideline.operators import normalize as nz
from tideline.operators.clustered import Layout
from tideline.plans import jobs
from tideline.plans.catalog import SQL, query
from tideline.plans.queries_read import _AVAIL, LIMITS, raw
from tideline.plans.queries_relate import MARKETS, day, delisted, sourced, statement_lines
from tideline.sources import tables, views
from tideline.streaming import streams

KEY = ["code", "date"]


def halves(spark, d):
    """Sourced bars before a day, and later ones (overlapping by two days) with another close."""
    s = sourced(spark, d)
    return s.where("date < '2024-01-20'"), s.where("date >= '2024-01-18'").select("code", "date", (F.col("close") + 1).alias("close"))


_BASE = "SELECT * FROM v_src WHERE date < DATE '2024-01-20'"
_NEW = "SELECT code, date, close + 1 AS close FROM v_src WHERE date >= DATE '2024-01-18'"
_REST = ("open", "high", "low", "volume", "trade_value")


@query(f"""SELECT coalesce(b.code, n.code) AS code, coalesce(b.date, n.date) AS date, CASE WHEN n.code IS NOT NULL THEN n.close ELSE b.close END AS close, {', '.join(f'b.{c}' for c in _REST)},
    CASE WHEN b.code IS NULL THEN 'primary' ELSE b.source END AS source FROM ({_BASE}) b FULL JOIN ({_NEW}) n ON b.code = n.code AND b.date = n.date""")
def mrg_1_merge_update(spark, d):
    base, new = halves(spark, d)
    return merge.merge_update(base, new, KEY, {"source": "primary"})


@query("""SELECT code, date, CASE WHEN year(date) = 1996 THEN -close ELSE close END AS close, low, high, volume, trade_value,
    CASE WHEN date BETWEEN DATE '1996-07-01' AND DATE '1996-12-31' THEN 'primary' ELSE 'archive' END AS source FROM v_long""")
def mrg_1_merge_into_parts(spark, d):
    """A long history by year, of which one year is merged anew: the folders of the others stay."""
    b, root = views.long_bars(spark, d), tables.scratch(spark, "by-year")
    jobs.merge_into(nz.stamp_source(b.where("not date between '1996-07-01' and '1996-12-31'"), "archive"), root, "daily_bars")
    jobs.merge_into(b.where("year(date) = 1996").withColumn("close", -F.col("close")), root, "daily_bars")
    jobs.merge_into(b.where("false"), root, "daily_bars")  # a day without rows
    return publish.current(spark, root).select("code", "date", *[F.col(c).cast("bigint").alias(c) for c in ("close", "low", "high", "volume", "trade_value")], "source")


def clustered_bars(spark, d):
    """A long history kept clustered by code and year's block, of which one year is merged anew, and its folder."""
    b, root = views.long_bars(spark, d), tables.scratch(spark, "clustered")
    jobs.merge_into(nz.stamp_source(b.where("not date between '1996-07-01' and '1996-12-31'"), "archive"), root, "daily_bars", layout=Layout(8))
    jobs.merge_into(b.where("year(date) = 1996").withColumn("close", -F.col("close")).withColumn("revision", F.lit(1)), root, "daily_bars")
    return root


_CLUSTERED = """SELECT code, date, CASE WHEN year(date) = 1996 THEN -close ELSE close END AS close, low, high, volume, trade_value,
    CASE WHEN date BETWEEN DATE '1996-07-01' AND DATE '1996-12-31' THEN 'primary' ELSE 'archive' END AS source FROM v_long"""


@query(f"SELECT *, CASE WHEN year(date) = 1996 THEN 1 END AS revision FROM ({_CLUSTERED})")
def mrg_1_merge_into_clustered(spark, d):
    df, _ = publish.clustered(spark, clustered_bars(spark, d))
    return df.select("code", "date", *[F.col(c).cast("bigint").alias(c) for c in ("close", "low", "high", "volume", "trade_value")], "source", "revision")


_SPLITS = "SELECT code, date, CASE WHEN volume % 2 = 0 THEN 0.5 ELSE 2.0 END AS factor FROM v_long WHERE volume % 5 = 0"


@query(f"""SELECT code, date, volume, source, p * low AS low, p * high AS high, p * close AS close FROM (SELECT b.*, coalesce(product(f.factor) OVER (PARTITION BY b.code ORDER BY b.date DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1.0) AS p FROM ({_CLUSTERED}) b LEFT JOIN ({_SPLITS}) f USING (code, date))""")
def job_7_adjust_clustered(spark, d):
    """Merged, adjusted and published in one layout."""
    source, root = clustered_bars(spark, d), tables.scratch(spark, "adjusted")
    events = views.long_bars(spark, d).where("volume % 5 = 0").select("code", "date", F.when(F.col("volume") % 2 == 0, 0.5).otherwise(2.0).alias("factor"))
    jobs.adjust_clustered(spark, source, events, root)
    return publish.current(spark, root).select("code", "date", "volume", "source", "low", "high", "close")


@query("SELECT b.*, s.shares, b.close * s.shares AS market_cap FROM v_share_bars b ASOF LEFT JOIN v_shares s ON b.code = s.code AND b.date >= s.date")
def jn_13_market_cap_clustered(spark, d):
    root = tables.scratch(spark, "clustered")
    publish.publish(views.share_bars(spark, d), root, date_col="date", layout=Layout(8))
    bars, layout = publish.clustered(spark, root)
    return asof.market_cap_asof(bars, views.shares(spark, d), layout).drop("__at")


@query("SELECT b.code, b.date, b.close, arg_max(s.shares, (s.date, s.shares)) AS shares FROM v_share_bars b LEFT JOIN v_shares s ON b.code = s.code AND s.date <= b.date AND s.date + CAST(s.shares % 200 AS INTEGER) <= b.date GROUP BY ALL")
def jn_14_asof_shares_pit_clustered(spark, d):
    root = tables.scratch(spark, "clustered")
    publish.publish(views.share_bars(spark, d), root, date_col="date", layout=Layout(8))
    bars, layout = publish.clustered(spark, root)
    known = views.shares(spark, d).withColumn("knowledge_date", F.expr("date_add(date, cast(shares % 200 as int))"))
    return asof.asof_shares_pit(bars, known, layout=layout).drop("__at")


@query(f"""SELECT code, date, close, {', '.join(_REST)}, source FROM ({_BASE}) UNION ALL
    SELECT code, date, close, NULL, NULL, NULL, NULL, NULL, 'primary' FROM ({_NEW}) n WHERE NOT EXISTS (SELECT 1 FROM ({_BASE}) b WHERE b.code = n.code AND b.date = n.date)""")
def mrg_2_merge_insert_only(spark, d):
    base, new = halves(spark, d)
    return merge.merge_insert_only(base, new, KEY, {"source": "primary"})


@query("""SELECT 'table' AS leg, code, date, close, (date < DATE '1997-01-01')::BIGINT AS rows FROM v_long UNION ALL
    SELECT 'inserted', NULL, NULL, NULL, count(*) FILTER (date >= DATE '1997-01-01') FROM v_long UNION ALL SELECT 'newest', NULL, max(date), NULL, count(*) FROM v_long""")
def mrg_2_insert_into_parts(spark, d):
    """History inserted over a part of it: what is there stays, and the counts were measured while writing."""
    b, root = views.long_bars(spark, d).select("code", "date", "close", "volume"), tables.scratch(spark, "by-year")
    jobs.insert_into(b.where("date < '1997-01-01'").withColumn("volume", F.lit(1)), root, "daily_bars")
    done = jobs.insert_into(b.withColumn("volume", F.lit(0)), root, "daily_bars")
    table = publish.current(spark, root).select(F.lit("table").alias("leg"), *KEY, F.col("close").cast("bigint").alias("close"), F.col("volume").alias("rows"))
    measured = spark.createDataFrame([("inserted", None, done.tally["inserted"]), ("newest", done.newest, done.rows)], "leg string, date date, rows bigint")
    return worklists.concat(table, measured)


def versions(spark, d):
    f = views.facts(spark, d)
    base = f.where("knowledge_date < '1998-01-01'")
    newest = asof.newest_per_key(base, ["code", "period"], "knowledge_date")
    k = F.length("code") % 2
    again = newest.select("code", "period", F.to_date(F.lit("1998-01-01")).alias("knowledge_date"), F.when(k == 0, F.col("value")).otherwise(F.col("value") + 1).alias("value"))
    return base, again.unionByName(f.where("knowledge_date > '1998-01-01'"))


@query("""WITH base AS (SELECT * FROM v_facts WHERE knowledge_date < DATE '1998-01-01')
    SELECT * FROM base UNION ALL
    SELECT code, period, DATE '1998-01-01', value + 1 FROM (SELECT * FROM base QUALIFY row_number() OVER (PARTITION BY code, period ORDER BY knowledge_date DESC) = 1) WHERE length(code) % 2 = 1 UNION ALL
    SELECT n.* FROM (SELECT * FROM v_facts WHERE knowledge_date > DATE '1998-01-01') n
    LEFT JOIN (SELECT * FROM base QUALIFY row_number() OVER (PARTITION BY code, period ORDER BY knowledge_date DESC) = 1) b USING (code, period) WHERE b.value IS DISTINCT FROM n.value""")
def mrg_3_append_changed_versions(spark, d):
    base, new = versions(spark, d)
    return merge.append_changed_versions(base, new, ["code", "period"], "knowledge_date", ["value"])


@query("SELECT code, name, market, l AS last_trade_date, CASE WHEN code::INT % 2 = 0 THEN DATE '2024-02-01' WHEN code::INT % 4 = 0 THEN c END AS checked FROM (SELECT m.*, c, CASE WHEN code::INT % 3 > 0 THEN c END AS l FROM v_master m LEFT JOIN (SELECT code, min(date) AS c FROM v_long GROUP BY code) USING (code))")
def mrg_4_mark_checked(spark, d):
    m = delisted(spark, d)
    return merge.mark_checked(m, m.where("cast(code as int) % 2 = 0").select("code"), day("2024-02-01"))


_FACTOR = "SELECT code, date, 2.0 AS factor FROM v_bars WHERE close % 50 = 0"
_ADJUSTED = f"SELECT b.code, b.date, b.volume, b.trade_value, 'primary' AS source, {', '.join(f'any_value(b.{c})::DOUBLE * coalesce(product(f.factor), 1.0) AS {c}' for c in ('open', 'high', 'low', 'close'))} FROM v_bars b LEFT JOIN ({_FACTOR}) f ON f.code = b.code AND f.date > b.date GROUP BY b.code, b.date, b.volume, b.trade_value"


def _factors(spark, d):
    return views.bars(spark, d).where("close % 50 = 0").select("code", "date", F.lit(2.0).alias("factor"))


@query(_ADJUSTED.replace("2.0 AS factor", "0.5 AS factor").replace("close % 50 = 0", "volume > 1").replace("'primary' AS source", "'rebuilt' AS source"))
def mrg_5_rebuild_table(spark, d):
    """A table that is there with other figures and older rows, all of which a rebuild replaces."""
    root, b = tables.scratch(spark, "adjusted"), views.bars(spark, d).withColumn("source", F.lit("rebuilt"))
    old = jobs.typed(b.withColumn("close", F.lit(0)).withColumn("date", F.date_sub("date", 9000)).unionByName(b), "daily_bars_adjusted")
    publish.publish(old, root, 1)
    jobs.adjust_rebuild(b, b.where("volume > 1").select("code", "date", F.lit(0.5).alias("factor")), root)
    return publish.current(spark, root)


@query("SELECT * FROM v_bars WHERE date < DATE '2024-01-30'")
def mrg_6_publish(spark, d):
    """Three generations and one that a gate stops: the third stays current."""
    root, b = tables.scratch(spark, "bars"), views.bars(spark, d)
    for last in ("2024-01-10", "2024-01-20", "2024-01-30"):
        publish.publish(b.where(F.col("date") < last), root, 1, "date", jobs.gates())
    try:
        publish.publish(b.where("date < '2024-01-05'"), root, 1, "date", jobs.gates())
    except publish.GateFailed:
        return publish.current(spark, root)
    raise AssertionError("a generation that shrank was published")


@query("SELECT *, 'primary' AS source, 0 AS revision, knowledge_date AS seen FROM v_facts")
def mrg_7_evolve_schema(spark, d):
    f = views.facts(spark, d).withColumn("seen", F.lit(None).cast("date"))
    return merge.evolve_schema(f, {"source": ("string", "primary"), "revision": ("int", 0)}, {"seen": "knowledge_date"})


@query("""SELECT code, date, CASE WHEN date < DATE '1997-01-01' AND code::INT % 2 = 0 THEN close + 2 WHEN date >= DATE '1999-01-01' THEN close + 1 ELSE close END AS close FROM v_long""")
def mrg_6_two_writers(spark, d):
    """While one writer merges new closes into a year, another does so in others and in that one; both
    changes are there, since the first looks again at what it had started from."""
    b, root, seen = views.long_bars(spark, d).select("code", "date", "close"), tables.scratch(spark, "writers"), []
    year = streams.year_of("date")
    publish.update(b, root, year, lambda base, new: new)

    def first(base, new):
        if not seen:
            seen.append(publish.update(b.where("date >= '1999-01-01'").withColumn("close", F.col("close") + 1), root, year, lambda x, y: merge.merge_update(x, y, KEY)))
            seen.append(publish.update(b.where("date < '1997-01-01'").withColumn("close", F.col("close") + 1), root, year, lambda x, y: merge.merge_update(x, y, KEY)))
        return base.join(new, KEY, "left").select(*KEY, (base["close"] + F.coalesce("add", F.when(F.col("date") < "1997-01-01", -1).otherwise(0))).alias("close"))

    publish.update(b.where("date < '1997-01-01' and cast(code as int) % 2 = 0").select(*KEY, F.lit(1).alias("add")), root, year, first)
    return publish.current(spark, root)


@query("""SELECT code, date, close, CASE WHEN year(date) = 1996 THEN CASE WHEN code::INT % 2 = 0 THEN 'checked' END ELSE 'unknown' END AS grade, CASE WHEN year(date) = 1996 THEN 1 ELSE 0 END AS revision FROM v_long""")
def mrg_7_later_columns(spark, d):
    """A history by year whose later columns are added without rewriting it: one by a commit alone, one by a
    merge into one year."""
    b, root = views.long_bars(spark, d).select("code", "date", "close"), tables.scratch(spark, "later")
    year = streams.year_of("date")
    publish.update(b, root, year, lambda base, new: new)
    publish.add_columns(spark, root, {"grade": ("string", "unknown")})
    new = b.where("year(date) = 1996").withColumn("grade", F.when(F.col("code").cast("int") % 2 == 0, "checked")).withColumn("revision", F.lit(1))
    publish.update(new, root, year, lambda base, rows: merge.merge_update(base, rows, KEY, extend=True), defaults={"revision": 0})
    return publish.current(spark, root)


@query("SELECT *, 'archive' AS source FROM v_long")
def mrg_8_stamp_source(spark, d):
    return nz.stamp_source(views.long_bars(spark, d), "archive")


def _landing(df: DataFrame, order: str, parts: int = 3) -> Iterator[str]:
    """``df`` landing in a folder in parts, in order of a number: the folder, after each part."""
    path = tables.scratch(df.sparkSession, "landed")
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    step = (hi - lo) // parts + 1
    for k in range(parts):
        df.where((F.col(order) >= lo + k * step) & (F.col(order) < lo + (k + 1) * step)).write.mode("append").parquet(path)
        yield path


@query("SELECT code, date, arg_max(px, event_id) AS px FROM v_ev GROUP BY ALL")
def str_1_stream_upsert(spark, d):
    r = raw(spark, d).select("code", "date", "px", "event_id")
    root = tables.scratch(spark, "upsert")
    for path in _landing(r, "event_id"):
        streams.stream_upsert(streams.files(spark, path, r.schema), root, KEY, "event_id", root + "-state", streams.year_of("date"))
    return publish.current(spark, root)


@query("""SELECT code, date, arg_max(px, event_id) AS px FROM v_ev WHERE event_id % 5 <> 0 GROUP BY ALL UNION ALL
    SELECT code, date, -1 FROM v_ev GROUP BY code, date HAVING bool_and(event_id % 5 = 0) UNION ALL SELECT code, date - 365, 5 FROM v_bars""")
def str_1_stream_onto_table(spark, d):
    """A stream onto a table that holds rows of its days, and another merge between its batches."""
    r = raw(spark, d).select("code", "date", "px", "event_id")
    root, year = tables.scratch(spark, "onto"), streams.year_of("date")
    own = r.select(*KEY).distinct()
    publish.update(own.withColumn("px", F.lit(-1).cast("bigint")), root, year, lambda base, new: new)
    for k, path in enumerate(_landing(r.where("event_id % 5 != 0"), "event_id")):
        streams.stream_upsert(streams.files(spark, path, r.schema), root, KEY, "event_id", root + "-state", year)
        if k == 0:
            older = own.select("code", F.date_sub("date", 365).alias("date"), F.lit(5).cast("bigint").alias("px"))
            publish.update(older, root, year, lambda base, new: merge.merge_update(base, new, KEY))
    return publish.current(spark, root)


_VERSIONS = "SELECT code, period, knowledge_date, cents FROM (SELECT *, lag(cents) OVER (PARTITION BY code, period ORDER BY knowledge_date) AS was FROM (SELECT code, period, knowledge_date, CAST(floor(value / 100000) AS BIGINT) AS cents FROM v_facts)) WHERE was IS NULL OR was <> cents"


@query(_VERSIONS)
def str_2_late_versions(spark, d):
    """Readings that arrive up to three weeks late, over batches: those of the last thirty days wait in the state."""
    f = views.facts(spark, d).select("code", "period", "knowledge_date", F.floor(F.col("value") / 100_000).cast("bigint").alias("cents"))
    arrival = F.unix_date("knowledge_date") + F.pmod(F.xxhash64("code", "knowledge_date"), F.lit(21))
    root, kind = tables.scratch(spark, "late-versions"), f.schema
    args = (root, ["code", "period"], "knowledge_date", ["cents"], root + "-state", streams.year_of("period"), "30 days")
    for path in _landing(f.withColumn("n", arrival), "n"):
        streams.stream_versions(streams.files(spark, path, kind), *args)
    spark.createDataFrame([("", "2100Q1", dt.date(2100, 1, 1), 0)], kind).write.mode("append").parquet(path)  # time goes on
    streams.stream_versions(streams.files(spark, path, kind), *args)
    return publish.current(spark, root)


@query("SELECT code, period, knowledge_date, cents FROM (SELECT *, lag(cents) OVER (PARTITION BY code, period ORDER BY knowledge_date) AS was FROM (SELECT code, period, knowledge_date, CAST(floor(value / 100000) AS BIGINT) AS cents FROM v_facts)) WHERE was IS NULL OR was <> cents")
def str_2_stream_versions(spark, d):
    f = views.facts(spark, d).select("code", "period", "knowledge_date", F.floor(F.col("value") / 100_000).cast("bigint").alias("cents"))
    root = tables.scratch(spark, "versions")
    for path in _landing(f.withColumn("n", F.unix_date("knowledge_date")), "n"):
        streams.stream_versions(streams.files(spark, path, f.schema), root, ["code", "period"], "knowledge_date", ["cents"], root + "-state", streams.year_of("period"))
    return publish.current(spark, root)


@query("""WITH e AS (SELECT code, date, px, event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS batch FROM v_ev),
    seen AS (SELECT batch, max(max(date)) OVER (ORDER BY batch) AS newest FROM e GROUP BY batch),
    f AS (SELECT e.*, date >= newest - 10 AS fresh FROM e JOIN seen USING (batch))
    SELECT 'table' AS part, code, date, arg_max(px, (batch, event_id)) AS px FROM f WHERE fresh GROUP BY code, date UNION ALL SELECT 'late', code, date, px FROM f WHERE NOT fresh""")
def str_3_late_window(spark, d):
    """One type of event after the other arrives: the table, and the rows that came too late for it."""
    e = views.table(spark, d, "events")
    batch = F.when(F.col("event_type") == "click", 0).when(F.col("event_type") == "view", 1).otherwise(2)
    r = e.select(views.code("user_id").alias("code"), F.to_date("ts").alias("date"), views.cents("value").alias("px"), F.struct(batch.alias("batch"), "event_id").alias("arrived"), batch.alias("n"))
    root, late = tables.scratch(spark, "window"), tables.scratch(spark, "late")
    for path in _landing(r, "n"):
        streams.stream_late_window(streams.files(spark, path, r.drop("n").schema), root, late, KEY, "arrived", 10, root + "-state", streams.year_of("date"))
    rows = lambda part, df: df.select(F.lit(part).alias("part"), *KEY, "px")
    return rows("table", publish.current(spark, root)).unionByName(rows("late", spark.read.parquet(late)))


@query("""WITH e AS (SELECT *, CASE WHEN date >= DATE '2024-01-20' AND event_id % 2 = 0 THEN 0 WHEN date < DATE '2024-01-10' THEN 1 ELSE 2 END AS batch FROM v_ev),
    f AS (SELECT e.*, date >= (SELECT max(date) FROM e WHERE batch = 0) - 10 AS fresh FROM e)
    SELECT 'table' AS part, code, date, arg_max(px, (batch, event_id)) AS px FROM f WHERE fresh GROUP BY code, date UNION ALL SELECT 'late', code, date, px FROM f WHERE NOT fresh""")
def str_3_late_batch(spark, d):
    """The second batch is late as a whole and leaves the table as it is."""
    e = views.table(spark, d, "events").withColumn("date", F.to_date("ts"))
    batch = F.when((F.col("date") >= "2024-01-20") & (F.col("event_id") % 2 == 0), 0).when(F.col("date") < "2024-01-10", 1).otherwise(2)
    r = e.select(views.code("user_id").alias("code"), "date", views.cents("value").alias("px"), F.struct(batch.alias("batch"), "event_id").alias("arrived"), batch.alias("n"))
    root, late = tables.scratch(spark, "window"), tables.scratch(spark, "late")
    for path in _landing(r, "n"):
        streams.stream_late_window(streams.files(spark, path, r.drop("n").schema), root, late, KEY, "arrived", 10, root + "-state", streams.year_of("date"))
    rows = lambda part, df: df.select(F.lit(part).alias("part"), *KEY, "px")
    return rows("table", publish.current(spark, root)).unionByName(rows("late", spark.read.parquet(late)))


@query("""WITH c AS (SELECT *, CASE WHEN lag(modified) OVER w IS NOT DISTINCT FROM modified THEN 0 ELSE 1 END AS ch FROM v_checks WINDOW w AS (PARTITION BY feed ORDER BY checked)),
    g AS (SELECT *, sum(ch) OVER (PARTITION BY feed ORDER BY checked) AS run FROM c)
    SELECT feed, checked, modified, row_number() OVER (PARTITION BY feed, run ORDER BY checked) - 1 AS streak FROM g""")
def str_4_stream_streaks(spark, d):
    c = views.feed_checks(spark, d)
    root, out = tables.scratch(spark, "last-checks"), tables.scratch(spark, "streaks")
    for path in _landing(c, "checked"):
        streams.stream_streaks(streams.files(spark, path, c.schema), root, out, root + "-state")
    return spark.read.parquet(out).drop("batch")


def _raw_bars(spark, d):
    """One raw row per code and day: the bar as text."""
    b = views.bars(spark, d)
    text = lambda c: F.concat(F.lit("-"), c)
    return b.select("code", F.date_format("date", "yyyyMMdd").alias("dt"), *[text(c).alias(c) for c in ("open", "high", "low", "close")], *[F.col(c).cast("string").alias(c) for c in ("volume", "trade_value")])


def _typed_bars(df: DataFrame) -> DataFrame:
    return jobs.typed(df, "daily_bars")


_TYPED = "code, date, open::INT AS open, high::INT AS high, low::INT AS low, close::INT AS close, volume, trade_value"


@query(f"""WITH stored AS (SELECT * FROM v_src WHERE code::INT % 2 = 0 OR date < DATE '2024-01-15'), m AS (SELECT max(date) AS m FROM stored WHERE code = '000002'),
    lag AS (SELECT code, max(date) AS l FROM stored GROUP BY code HAVING max(date) < (SELECT m FROM m))
    SELECT {_TYPED}, source FROM stored UNION ALL SELECT {_TYPED}, 'primary' FROM v_src JOIN lag USING (code) WHERE date > l""")
def job_1_catch_up(spark, d):
    stored = _typed_bars(sourced(spark, d).where("cast(code as int) % 2 = 0 or date < '2024-01-15'"))
    return jobs.catch_up(stored, _raw_bars(spark, d), "000002", day("2000-01-01"))


@query("""SELECT 'bars' AS leg, code, date, close, volume AS value, CASE WHEN date < DATE '2024-01-20' THEN source ELSE 'primary' END AS source FROM v_src
    UNION ALL SELECT 'flow', code, date, close, CASE WHEN date >= DATE '2024-01-18' THEN -open END, 'backfill' FROM v_bars WHERE close > 0
    UNION ALL SELECT 'flow', code, date, close, -open, 'primary' FROM v_bars WHERE date >= DATE '2024-01-18' AND close <= 0
    UNION ALL SELECT 'index', code, date, close, trade_value, CASE WHEN date >= DATE '2024-01-18' THEN 'New' ELSE 'Old' END FROM v_bars""")
def job_2_daily_ingest(spark, d):
    base = _typed_bars(sourced(spark, d).where("date < '2024-01-20'"))
    new = _raw_bars(spark, d).where("dt >= '20240118'")
    flow = nz.normalize_partial_flow(views.bars(spark, d).select("code", "date", "close", "volume", F.col("open").alias("institution"), F.col("low").alias("foreign_")))
    raw_flow = new.select("code", "dt", "close", F.lit("0.5").alias("flu_rt"), F.col("volume").alias("acc_trde_qty"), *[F.col("open").alias(x) for x in nz.INVESTORS])
    index = jobs.typed(views.bars(spark, d).withColumn("name", F.lit("Old")), "sector_index")
    outcomes = new.select("code", F.lit("done").alias("outcome"), F.lit(1).alias("rows"))
    done = jobs.daily_ingest(base, jobs.typed(flow, "supply_demand"), index, new, raw_flow, new.withColumn("name", F.lit(" New ")), outcomes)
    leg = lambda name, df, value, source: df.select(F.lit(name).alias("leg"), *KEY, F.col("close").cast("bigint").alias("close"), F.col(value).alias("value"), F.col(source).alias("source"))
    return worklists.concat(leg("bars", done.bars, "volume", "source"), leg("flow", done.flow, "individual", "source"), leg("index", done.index, "trade_value", "name"))


@query("""SELECT 'daily_bars' AS leg, code, date, close, CASE WHEN date < DATE '2024-01-20' THEN source ELSE 'primary' END AS source FROM v_src
    UNION ALL SELECT 'supply_demand', code, date, close, 'primary' FROM v_bars WHERE date >= DATE '2024-01-18' UNION ALL SELECT 'sector_index', code, date, close, 'New' FROM v_bars WHERE date >= DATE '2024-01-18'""")
def job_2_ingest_into_years(spark, d):
    """The last days into tables by year, of which one holds rows already; run twice, as after a failure."""
    root, new = tables.scratch(spark, "daily"), _raw_bars(spark, d).where("dt >= '20240118'")
    jobs.merge_into(sourced(spark, d).where("date < '2024-01-20'"), f"{root}/daily_bars", "daily_bars")
    flow = new.select("code", "dt", "close", F.lit("0.5").alias("flu_rt"), F.col("volume").alias("acc_trde_qty"), *[F.col("open").alias(x) for x in nz.INVESTORS])
    outcomes = new.select("code", F.lit("done").alias("outcome"), F.lit(1).alias("rows"))
    for _ in range(2):
        jobs.daily_ingest_into(root, new, flow, new.withColumn("name", F.lit(" New ")), outcomes)
    leg = lambda name, source: publish.current(spark, f"{root}/{name}").select(F.lit(name).alias("leg"), *KEY, F.col("close").cast("bigint").alias("close"), F.col(source).alias("source"))
    return worklists.concat(leg("daily_bars", "source"), leg("supply_demand", "source"), leg("sector_index", "name"))


@query("""SELECT 'short' AS leg, code, date, close::INT AS close, -volume AS volume, open AS short_qty, low AS short_balance, 0.5::DOUBLE AS short_ratio, high::INT AS short_avg_price, 0::BIGINT AS short_value, NULL::BIGINT AS new_qty, NULL::BIGINT AS balance_amt, NULL::DOUBLE AS credit_rt FROM v_bars
    UNION ALL SELECT 'credit', code, date, close, NULL, NULL, NULL, NULL, NULL, NULL, -volume, -volume, -volume::DOUBLE FROM v_bars""")
def job_3_short_credit_ingest(spark, d):
    b = views.bars(spark, d)
    s = lambda c: F.col(c).cast("string")
    short = b.select("code", F.date_format("date", "yyyyMMdd").alias("dt"), F.concat(F.lit("-"), "close").alias("close"), F.concat(F.lit("-"), "volume").alias("volume"), s("open").alias("short_qty"), s("low").alias("short_balance"), F.lit("+0.5").alias("short_ratio"), s("high").alias("short_avg_price"), F.lit("").alias("short_value"))
    credit = short.select("code", "dt", "close", *[F.col("volume").alias(c) for c in ("new_qty", "repay_qty", "balance_qty", "balance_amt", "balance_rt", "credit_rt")])
    none = lambda t: spark.createDataFrame([], jobs.TABLES[t].schema)
    a, b = jobs.short_credit_ingest(none("short_selling"), none("credit_balance"), short, credit)
    b = b.select("code", "date", "close", "new_qty", "balance_amt", "credit_rt")
    return worklists.concat(a.withColumn("leg", F.lit("short")), b.withColumn("leg", F.lit("credit")))


_AVAIL_4 = _AVAIL.replace("period", "p.period")


_BACKFILL = f"""SELECT id::VARCHAR AS code, p.period, {_AVAIL_4} AS avail_date, {_AVAIL_4} AS knowledge_date, netinc, netinc_prior, revenue, revenue_prior, op_income, op_income_prior
    FROM ({SQL['agg_5_financials_six']}) JOIN (SELECT o_orderkey, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS period FROM orders) p ON o_orderkey = id
    WHERE netinc IS NOT NULL AND {_AVAIL_4} <= DATE '1999-01-01'"""


def _lines(spark, d):
    """Statement lines of orders as companies, each with the period of its order."""
    o = views.table(spark, d, "orders")
    p = F.concat(F.year("o_orderdate"), F.lit("Q"), F.quarter("o_orderdate"))
    return statement_lines(spark, d).join(o.select(F.col("o_orderkey").alias("id"), p.alias("period")), "id").withColumn("code", F.col("id").cast("string"))


@query(_BACKFILL)
def job_4_earnings_backfill(spark, d):
    empty, lines = spark.createDataFrame([], jobs.TABLES["earnings"].schema), _lines(spark, d)
    return jobs.earnings_backfill(empty, lines.select("code").distinct(), 1992, 1999, lines, day("1999-01-01"), "avail")


@query(f"""WITH b AS ({_BACKFILL}) SELECT * FROM b UNION ALL
    SELECT code, period, avail_date, DATE '1999-02-01', {", ".join(f"{c} * 10" for c in jobs.FIGURES[1:])} FROM b WHERE code::BIGINT % 3 = 0 AND period IN ('1998Q2', '1998Q3')""")
def job_4_earnings_increment(spark, d):
    """The last quarters read again: what a third of the companies have restated becomes a version, what is as it
    was does not."""
    stored, lines = job_4_earnings_backfill(spark, d), _lines(spark, d)
    tenfold = lambda c: F.when((F.col("id") % 3 == 0) & F.col(c).rlike("[0-9]$"), F.concat(c, F.lit("0"))).otherwise(F.col(c)).alias(c)
    again = lines.select("code", "period", "status", "pos", "account_nm", tenfold("thstrm_amount"), tenfold("frmtrm_amount"))
    return jobs.earnings_increment(stored, lines.select("code").distinct(), 4, again, day("1999-02-01"), "today")


_RECENT = "SELECT year(q) || 'Q' || quarter(q) AS period FROM (SELECT CAST(date_trunc('quarter', DATE '1997-08-15') - to_months(3 * i::INT) AS DATE) AS q FROM range(4) t(i))"


@query(f"""WITH recent AS ({_RECENT}), due AS (SELECT o_custkey::VARCHAR AS code, period FROM (SELECT DISTINCT o_custkey FROM orders) CROSS JOIN recent WHERE {_AVAIL} <= DATE '1997-08-15'),
    pending AS (SELECT * FROM due WHERE NOT EXISTS (SELECT 1 FROM v_facts f WHERE f.code = due.code AND f.period = due.period AND f.value < 150000))
    SELECT code, period, (row_number() OVER (PARTITION BY period ORDER BY code) - 1) // 100 AS batch FROM pending""")
def job_4_earnings_worklist(spark, d):
    """What an increment still has to ask for, in batches; cheap facts are there already."""
    codes = views.table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("code")).distinct()
    return jobs.earnings_worklist(codes, jobs.recent(spark, 4, day("1997-08-15")), views.facts(spark, d).where("value < 150000"), day("1997-08-15"))


@query("SELECT o_orderkey::VARCHAR AS code, DATE '2024-02-01' AS date, o_orderkey * 1000.0::DOUBLE AS target_mean, 4.25::DOUBLE AS recomm_mean, '2024-01-01' AS base_date, 5.0::DOUBLE AS fwd_eps, NULL::DOUBLE AS prev_eps, '202612' AS est_year FROM orders WHERE o_orderkey % 2 = 1")
def job_5_consensus_snapshot(spark, d):
    k = F.col("o_orderkey")
    a = F.concat(F.lit('{"consensusInfo":{"priceTargetMean":"'), F.format_number(k * 1000, 0), F.lit('","recommMean":"4.25","createDate":"2024-01-01"}}'))
    b = F.lit('{"financeInfo":{"trTitleList":[{"key":"202612","isConsensus":"Y"}],"rowList":[{"title":"EPS","columns":{"202612":{"value":"5"}}}]}}')
    rows = views.table(spark, d, "orders").select(k.cast("string").alias("code"), k.alias("k"), a.alias("consensus"), b.alias("estimate"))
    have = jobs.typed(rows.where("k % 2 = 0").select("code", day("2024-02-01").alias("date")), "consensus")
    schema = jobs.TABLES["consensus"].schema
    base = have.select(*[F.col(c) if c in KEY else F.lit(None).cast(schema[c].dataType).alias(c) for c in schema.fieldNames()])
    return jobs.consensus_snapshot(base, rows.select("code"), rows.drop("k"), day("2024-02-01")).where("target_mean is not null")


_CHAIN = f"(SELECT * FROM v_long WHERE code IN (SELECT code FROM v_master WHERE market IN {MARKETS}))"


@query(
    f"""SELECT 'bars' AS leg, count(*) FILTER (close > 0) AS missing FROM {_CHAIN} UNION ALL SELECT 'shares', count(DISTINCT (code, year(date))) FROM {_CHAIN}
    UNION ALL SELECT 'flow', count(*) FILTER (close > 0) FROM {_CHAIN} UNION ALL SELECT 'checked', count(DISTINCT code) FROM {_CHAIN}"""
)
def job_6_survivorship_chain(spark, d):
    b = views.long_bars(spark, d)
    none = lambda t: spark.createDataFrame([], jobs.TABLES[t].schema)
    fetched = b.select("code", "date", F.col("low").alias("open"), "high", "low", "close", "volume")
    reports = b.select("code", F.year("date").alias("year"), F.lit("11011").alias("report"), F.col("volume").alias("shares"), "date", F.date_add("date", 30).alias("receipt_date"))
    pages = b.select("code", F.lit(1).alias("page"), F.lit(0).alias("pos"), "date", "close", "volume", F.col("low").alias("institution"), F.col("high").alias("foreign_"))
    done = jobs.survivorship_chain(delisted(spark, d).withColumn("checked", F.lit(None).cast("date")), none("daily_bars"), none("shares_outstanding_history"), none("supply_demand"), fetched, reports, pages, day("1995-01-01"), day("2024-02-01"), MARKETS)
    return worklists.legs({"bars": done.bars, "shares": done.shares, "flow": done.flow, "checked": done.master.where("checked is not null")})


@query(_ADJUSTED)
def job_7_adjust_rebuild(spark, d):
    root = tables.scratch(spark, "adjusted")
    for _ in range(2):  # a second run replaces every row and changes nothing
        jobs.adjust_rebuild(views.bars(spark, d).withColumn("source", F.lit("primary")), _factors(spark, d), root)
    return publish.current(spark, root)


_FILES = "SELECT code AS file, min(date)::VARCHAR AS modified, count(*) AS size, sum(open)::BIGINT % 4 AS k FROM v_bars GROUP BY code"


@query(f"""WITH files AS ({_FILES}), refresh AS (
        SELECT file, CASE k WHEN 0 THEN 'absent' WHEN 1 THEN 'no record' WHEN 2 THEN 'modified' END AS reason FROM files WHERE k < 3)
    SELECT 'table' AS leg, code AS name, date, close AS close_split, open AS close, volume * 1000000 AS mcap, NULL AS reason FROM v_bars WHERE code IN (SELECT file FROM refresh)
    UNION ALL SELECT 'refresh', file, NULL, NULL, NULL, NULL, reason FROM refresh
    UNION ALL SELECT 'plan', feed, NULL, NULL, NULL, NULL, listed FROM (VALUES ('stocks', 'true'), ('gone', 'false')) p(feed, listed)
    UNION ALL SELECT 'report', feed, NULL, NULL, NULL, NULL, verdict FROM (VALUES ('stocks', 'new'), ('gone', 'not listed')) r(feed, verdict)""")
def job_8_bulk_rebuild(spark, d):
    """A file for each code: a quarter of them absent, without a record, modified and current."""
    root = tables.scratch(spark, "vendor")
    b = views.bars(spark, d).select("code", "date", "close", F.col("open").alias("closeadj"), F.col("volume").alias("mcap"))
    per = b.groupBy(F.col("code").alias("file")).agg(F.min("date").cast("string").alias("modified"), F.count("*").alias("size"), (F.sum("closeadj") % 4).alias("k"))
    listing = per.select(F.lit("stocks").alias("feed"), "file", "modified", "size")
    inventory = per.where("k != 0").select("file", "size", F.lit("h").alias("sha256"))
    manifest = per.where("k != 1").select("file", F.when(F.col("k") == 2, "before").otherwise(F.col("modified")).alias("modified"), F.lit("h").alias("sha256"))
    wanted = spark.createDataFrame([("stocks",), ("gone",)], "feed string")
    plan = jobs.bulk_sync(wanted, listing, inventory, manifest, views.feed_checks(spark, d), LIMITS)
    drop = b.join(plan.refresh.select(F.col("file").alias("code")), "code", "left_semi")
    jobs.bulk_rebuild(drop, root, "date")
    leg = lambda name, df, who, why, *rest: df.select(F.lit(name).alias("leg"), F.col(who).alias("name"), F.col(why).cast("string").alias("reason"), *rest)
    table = publish.current(spark, root).select(F.lit("table").alias("leg"), F.col("code").alias("name"), "date", "close_split", "close", "mcap")
    report = plan.report.select("feed", "verdict").distinct()
    return worklists.concat(table, leg("refresh", plan.refresh, "file", "reason"), leg("plan", plan.plan, "feed", "listed"), leg("report", report, "feed", "verdict"))


@query("SELECT code, date, trade_value AS shares_outstanding, 'snapshot' AS source, NULL::DATE AS knowledge_date FROM v_bars WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'")
def job_9_shares_by_calendar(spark, d):
    """A snapshot file for each of some days, of which those of trading days count."""
    b, path = views.bars(spark, d), tables.scratch(spark, "snapshots")
    rows = b.select("date", "code", F.format_number("trade_value", 0).alias("listed shares"), F.lit("x").alias("other"))
    found = []
    for k in range(3, 14):
        own = f"{path}/2024-01-{k:02d}"
        rows.where(F.col("date") == f"2024-01-{k:02d}").drop("date").write.option("header", True).csv(own)
        found.append(tables.read_snapshot_csv(spark, own, f"2024-01-{k:02d}", "code", "listed shares"))
    empty = spark.createDataFrame([], jobs.TABLES["shares_outstanding_history"].schema)
    days = worklists.trading_calendar(b, day("2024-01-05"), day("2024-01-09"))
    return jobs.shares_by_calendar(empty, worklists.concat(*found), days, "snapshot")
