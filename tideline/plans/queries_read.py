"""Queries: sources, normalisers, filters and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.functions import scalars as fn
from tideline.operators import normalize as nz
from tideline.operators import publish
from tideline.operators import worklists as wl
from tideline.plans import jobs
from tideline.plans.catalog import query
from tideline.sources import tables, views
from tideline.sources.schemas import INVESTORS, TABLES


def raw(spark: SparkSession, d: str) -> DataFrame:
    """Events as raw payload rows, whose values are text."""
    e = views.table(spark, d, "events").select("*", views.cents("value").alias("px"), views.code("user_id").alias("code"), F.to_date("ts").alias("date"))
    return e.select(
        "code",
        "event_id",
        "px",
        "date",
        F.when(F.col("event_id") % 13 == 0, "").otherwise(F.date_format("ts", "yyyyMMdd")).alias("dt"),
        F.concat(F.when(F.col("event_id") % 3 == 0, "-").otherwise("+"), "px").alias("signed"),
        F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("px").cast("string")).alias("maybe"),
        F.concat(F.floor(F.col("px") / 100), F.lit("."), F.col("px") % 10).alias("dec"),
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'")
def src_1_read_table(spark, d):
    t = tables.read_table(spark, f"{d}/orders.parquet", views.table(spark, d, "orders").schema)
    return t.where("o_orderdate >= '1997-01-01' and o_orderdate < '1998-01-01'").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT code, date, close::INT AS close, volume, 'archive' AS source FROM v_long WHERE date BETWEEN DATE '1996-03-01' AND DATE '1996-03-31'")
def src_1_read_parts(spark, d):
    """A month of a long history that is kept by year: one year's folder is opened."""
    root = tables.scratch(spark, "history")
    jobs.merge_into(nz.stamp_source(views.long_bars(spark, d), "archive"), root, "daily_bars")
    return publish.current(spark, root, {"date": (dt.date(1996, 3, 1), dt.date(1996, 3, 31))}).select("code", "date", "close", "volume", "source")


@query("SELECT code, CAST(row_number() OVER (PARTITION BY code ORDER BY event_id) - 1 AS INTEGER) AS pos, event_id::VARCHAR AS id, json_extract_string(props, '$.k') AS k FROM v_ev")
def src_2_explode_payload(spark, d):
    e = views.table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return _exploded(e.select(views.code("user_id").alias("code"), "event_id", "k"))


def _exploded(e: DataFrame, width: int = 10_000) -> DataFrame:
    """Events ``(code, event_id, k)`` as payloads of ``width`` event ids each, so that a code with many
    events isn't one text, and exploded again; ``pos`` counts over all payloads of a code."""
    rows = F.sort_array(F.collect_list(F.struct("event_id", "k")))
    body = F.to_json(F.struct(F.transform(rows, lambda x: F.struct(x["event_id"].cast("string").alias("id"), x["k"].alias("k"))).alias("list")))
    payloads = e.groupBy("code", F.floor(F.col("event_id") / width).alias("part")).agg(body.alias("body"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("code").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = payloads.select(F.col("code").alias("own"), F.col("part").alias("at"), before.alias("first"))
    got = tables.explode_payload(payloads.select("code", "part", "body"), "body", "list", "id string, k string")
    same = F.col("code").eqNullSafe(F.col("own")) & F.col("part").eqNullSafe(F.col("at"))
    return got.join(first, same).select("code", (F.col("pos") + F.col("first")).cast("int").alias("pos"), "id", "k")


def _snapshot(spark, d):
    path = tables.scratch(spark, "snapshot")
    rows = views.table(spark, d, "orders").select(F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("code"), F.when(F.col("o_orderkey") % 10 == 0, "-").otherwise(F.format_number("o_orderkey", 0)).alias("listed shares"), F.lit("x").alias("other"))
    rows.write.option("header", True).csv(path)
    return path


@query("SELECT lpad(o_custkey::VARCHAR, 6, '0') AS code, DATE '2020-01-02' AS date, o_orderkey AS shares_outstanding FROM orders WHERE o_orderkey % 10 <> 0")
def src_3_read_snapshot_csv(spark, d):
    return tables.read_snapshot_csv(spark, _snapshot(spark, d), "2020-01-02", "code", "listed shares")


@query("SELECT code, date, trade_value AS shares_outstanding FROM v_bars WHERE day(date) % 3 < 2")
def src_3_read_snapshots(spark, d):
    """A file for each day in one folder: every third with its columns in another order, and every third without the column."""
    path, b = tables.scratch(spark, "snapshots"), views.bars(spark, d)
    n, kind = F.format_number("trade_value", 0), F.dayofmonth("date") % 3
    cell = F.concat(F.lit('"'), n, F.lit('"'))
    line = F.when(kind == 0, F.concat_ws(",", "code", F.lit("종목"), cell)).otherwise(F.concat_ws(",", cell, "code"))
    head = F.when(kind == 0, "종목코드,이름,상장주식수").when(kind == 1, "상장주식수,종목코드").otherwise("주식수,종목코드")
    days = b.select("date", line.alias("line"), head.alias("head")).groupBy("date").agg(F.concat_ws("\n", F.first("head"), F.concat_ws("\n", F.collect_list("line"))).alias("value"))
    days.repartition("date").write.partitionBy("date").text(path)
    return tables.read_snapshots(spark, path, "종목코드", "상장주식수")


@query("SELECT code, date, open::DOUBLE AS open, high::DOUBLE AS high, low::DOUBLE AS low, close::DOUBLE AS close, volume::DOUBLE AS volume FROM v_bars")
def src_4_parse_array_text(spark, d):
    b = views.bars(spark, d)
    row = F.concat(F.lit('["'), F.date_format("date", "yyyyMMdd"), F.lit('", '), F.concat_ws(", ", "open", "high", "low", "close", "volume"), F.lit(", 0.5]"))
    text = b.groupBy("code", F.trunc("date", "month").alias("month")).agg(F.concat(F.lit("x = [['day', 'o'],\n"), F.concat_ws(",\n", F.collect_list(row)), F.lit("];")).alias("body"))
    return tables.parse_array_text(text).drop("pos", "month")


@query("SELECT code, date, close, -volume AS change, volume, open AS institution, -low AS foreign_ FROM v_bars WHERE day(date) % 4 <> 0")
def src_5_parse_flow_html(spark, d):
    b = views.bars(spark, d)
    cell = lambda c: F.concat(F.lit('<td class="n"><span>'), c, F.lit("</span></td>\n"))
    n = lambda c: cell(F.format_number(c, 0))
    numbers = F.concat(n(F.col("close")), n(-F.col("volume")), cell(F.lit("+0.5%")), n(F.col("volume")), cell(F.concat(F.lit("+"), F.format_number("open", 0))), n(-F.col("low")))
    short = F.dayofmonth("date") % 4 == 0  # these rows lack a cell
    row = F.concat(F.lit("<tr><td><span>"), F.date_format("date", "yyyy.MM.dd"), F.lit("</span></td>"), numbers, F.when(short, "").otherwise(n(F.lit(7))), F.lit("</tr>\n"))
    page = b.groupBy("code", F.trunc("date", "month").alias("month")).agg(F.concat(F.lit("<table><tr><th>day</th></tr>"), F.concat_ws("", F.collect_list(row)), F.lit("</table>")).alias("html"))
    return tables.parse_flow_html(page).drop("pos", "month")


@query("SELECT CASE event_type WHEN 'click' THEN 'prices' ELSE event_type END AS \"table\", count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY ALL")
def src_6_read_bulk_drop(spark, d):
    e = views.table(spark, d, "events")
    path = tables.scratch(spark, "drop")
    e.select("event_id", F.when(F.col("event_type") == "click", "stocks").otherwise(F.col("event_type")).alias("feed"), F.when(F.col("event_type") == "view", "delta").otherwise("full").alias("history")).write.option("header", True).csv(path, compression="gzip")
    rows = tables.read_bulk_drop(spark, path, "event_id bigint, path string, history string").withColumnRenamed("path", "feed")
    return tables.bulk_plan(rows.withColumn("path", F.col("event_id"))).groupBy("table").agg(F.count("*").alias("n"))


@query("SELECT date::VARCHAR AS day, CAST(length(line) + 1 AS BIGINT) AS size, sha256(line || chr(10)) AS sha256 FROM (SELECT date, date || ' ' || count(*) || ' ' || sum(px)::BIGINT AS line FROM v_ev GROUP BY date)")
def src_7_file_inventory(spark, d):
    """A file for each day, with one line."""
    path = tables.scratch(spark, "files")
    line = F.concat_ws(" ", "date", F.count("*"), F.sum("px"))
    raw(spark, d).groupBy("date").agg(line.alias("value")).write.partitionBy("date").text(path)
    return tables.file_inventory(spark, path).select(F.regexp_extract("path", "date=([^/]+)", 1).alias("day"), "size", "sha256")


@query("SELECT feed, max(checked) AS checked FROM v_checks GROUP BY feed")
def src_8_read_control(spark, d):
    path = tables.scratch(spark, "control")
    views.feed_checks(spark, d).groupBy("feed").agg(F.max("checked").alias("checked")).write.json(path)
    none = tables.read_control(spark, path + "-missing", "feed string, checked bigint")
    return tables.read_control(spark, path, "feed string, checked bigint").unionByName(none)


@query("SELECT feed, CASE WHEN feed < 'm' THEN max(checked) ELSE min(checked) END AS checked, CASE WHEN feed < 'd' THEN NULL WHEN feed < 'm' THEN max(modified) ELSE min(modified) END AS modified, 'seen ' || min(checked) AS note FROM v_checks GROUP BY feed")
def src_9_write_control(spark, d):
    """New records of some feeds, one with a null, replace the old ones, whose own facts stay."""
    c = views.feed_checks(spark, d).groupBy("feed").agg(F.min("checked").alias("lo"), F.max("checked").alias("hi"), F.min("modified").alias("first"), F.max("modified").alias("last"))
    old = c.select("feed", F.col("lo").alias("checked"), F.col("first").alias("modified"), F.concat(F.lit("seen "), "lo").alias("note"))
    new = c.where("feed < 'm'").select("feed", F.col("hi").alias("checked"), F.when(F.col("feed") >= "d", F.col("last")).alias("modified"))
    root = tables.scratch(spark, "control")
    for part in (old, new):
        tables.write_control(part, root, "feed")
    return publish.current(spark, root)


@query("SELECT code, date, CASE WHEN volume > 2 THEN volume END AS volume FROM v_bars")
def src_10_append_csv(spark, d):
    path = tables.scratch(spark, "out")
    b = views.bars(spark, d).withColumn("volume", F.expr("case when volume > 2 then volume end"))
    for part in (b.where("open % 2 = 0"), b.where("open % 2 = 1")):
        tables.append_csv(part, path, ("code", "date", "volume"))
    return tables.read_bulk_drop(spark, path, "code string, date date, volume bigint")


@query("SELECT code, date FROM v_bars WHERE day(date) % 2 = 1")
def src_11_done_from_csv(spark, d):
    path = tables.scratch(spark, "done")
    b = views.bars(spark, d)
    tables.append_csv(b.where("day(date) % 2 = 0"), path, ("code", "date"))
    return wl.difference(b.select("code", "date"), tables.done_from_csv(spark, path, ["code", "date"], "code string, date date"), "code", "date")


@query("""SELECT 'daily_bars' AS "table", code, date, CASE WHEN date >= DATE '2024-01-20' - 7 THEN close + 1 ELSE close END AS close, NULL AS name FROM v_bars WHERE date < DATE '2024-01-16' OR date >= DATE '2024-01-20' - 7
    UNION ALL SELECT 'stocks', code, NULL, NULL, CASE WHEN market < 'M' THEN upper(name) ELSE name END FROM v_master""")
def src_12_copy_window(spark, d):
    """Bars, of which the last days are copied over, and a master, which is copied whole."""
    b, m = views.bars(spark, d), views.suppliers(spark, d)
    typed = lambda df, name: df.select([F.col(c).cast(TABLES[name].schema[c].dataType).alias(c) if c in df.columns else F.lit(None).cast(TABLES[name].schema[c].dataType).alias(c) for c in TABLES[name].schema.fieldNames()])
    source = {"daily_bars": b.select("code", F.date_format("date", "yyyyMMdd").alias("date"), (F.col("close") + 1).alias("close")), "stocks": m.where("market < 'M'").withColumn("name", F.upper("name"))}
    target = {"daily_bars": typed(b.where("date < '2024-01-16'"), "daily_bars"), "stocks": typed(m, "stocks")}
    done = jobs.copy_tables(source, target, 7, F.to_date(F.lit("2024-01-20")))
    bars = done["daily_bars"].select(F.lit("daily_bars").alias("table"), "code", "date", F.col("close").cast("bigint").alias("close"))
    return wl.concat(bars, done["stocks"].select(F.lit("stocks").alias("table"), "code", "name"))


_NUM = "CASE WHEN event_id % 7 = 0 THEN 0 ELSE px END"
_DAY = "CASE WHEN event_id % 13 <> 0 THEN date END"


@query(f"SELECT event_id, code, date, px AS open, px AS high, px AS low, px AS close, CASE WHEN event_id % 3 = 0 THEN -px ELSE px END AS volume, {_NUM} AS trade_value FROM v_raw WHERE event_id % 13 <> 0")
def prj_1_normalize_bars(spark, d):
    r = raw(spark, d)
    r = r.select("event_id", "code", "dt", *[F.col("signed").alias(c) for c in ("open", "high", "low", "close", "volume")], F.col("maybe").alias("trade_value"))
    return _with_id(r, nz.normalize_bars)


def _with_id(r: DataFrame, f) -> DataFrame:
    """Keeps the event id through a normaliser that selects its own columns."""
    return f(r.withColumn("code", F.concat_ws("|", "code", "event_id"))).withColumn("event_id", F.substring_index("code", "|", -1).cast("bigint")).withColumn("code", F.substring_index("code", "|", 1))


@query("SELECT event_id, code, date, px AS close, dec::DOUBLE AS flu_rt, px AS acc_trde_qty, " + ", ".join(f"{'CASE WHEN event_id % 3 = 0 THEN -px ELSE px END' if i % 2 else _NUM} AS {x}" for i, x in enumerate(INVESTORS)) + " FROM v_raw WHERE event_id % 13 <> 0")
def prj_2_normalize_flow(spark, d):
    r = raw(spark, d).select("event_id", "code", "dt", F.col("signed").alias("close"), F.concat(F.lit("+"), "dec").alias("flu_rt"), F.col("px").cast("string").alias("acc_trde_qty"), *[F.col("signed" if i % 2 else "maybe").alias(x) for i, x in enumerate(INVESTORS)])
    return _with_id(r, nz.normalize_flow)


_S = "CASE WHEN event_id % 3 = 0 THEN -px ELSE px END"


@query(f"SELECT event_id, code, date, px AS close, {_S} AS volume, {_S} AS short_qty, {_NUM} AS short_balance, {_S} AS short_avg_price, {_NUM} AS short_value, dec::DOUBLE AS short_ratio FROM v_raw WHERE event_id % 13 <> 0")
def prj_3_normalize_short(spark, d):
    r = raw(spark, d).select("event_id", "code", "dt", F.col("dec").alias("short_ratio"), *[F.col("signed").alias(c) for c in ("close", "volume", "short_qty", "short_avg_price")], *[F.col("maybe").alias(c) for c in ("short_balance", "short_value")])
    return _with_id(r, nz.normalize_short)


@query(f"SELECT event_id, code, date, px AS close, {_S} AS new_qty, {_NUM} AS repay_qty, {_S} AS balance_qty, {_NUM} AS balance_amt, dec::DOUBLE AS balance_rt, dec::DOUBLE AS credit_rt FROM v_raw WHERE event_id % 13 <> 0")
def prj_4_normalize_credit(spark, d):
    r = raw(spark, d).select("event_id", "code", "dt", *[F.col("dec").alias(c) for c in ("balance_rt", "credit_rt")], *[F.col("signed").alias(c) for c in ("close", "new_qty", "balance_qty")], *[F.col("maybe").alias(c) for c in ("repay_qty", "balance_amt")])
    return _with_id(r, nz.normalize_credit)


@query(f"SELECT event_id, code, date, 'Index' AS name, px AS open, px AS high, px AS low, px AS close, {_S} AS volume, {_NUM} AS trade_value FROM v_raw WHERE event_id % 13 <> 0")
def prj_5_normalize_index(spark, d):
    r = raw(spark, d).select("event_id", "code", "dt", F.lit(" Index ").alias("name"), *[F.col("signed").alias(c) for c in ("open", "high", "low", "close", "volume")], F.col("maybe").alias("trade_value"))
    return _with_id(r, nz.normalize_index)


@query(f"SELECT code, DATE '2024-02-01' AS date, 1000 * ({_NUM}) AS shares_outstanding FROM v_raw")
def prj_6_normalize_listed_shares(spark, d):
    return nz.normalize_listed_shares(raw(spark, d).select("code", F.col("maybe").alias("listed")), F.to_date(F.lit("2024-02-01")))


@query("SELECT c_custkey::VARCHAR AS code, c_name AS name, c_mktsegment AS market, n_name AS sector, '' AS kind FROM customer JOIN nation ON c_nationkey = n_nationkey")
def prj_7_normalize_master(spark, d):
    c, n = views.table(spark, d, "customer"), views.table(spark, d, "nation")
    pad = lambda x: F.concat(F.lit("  "), x, F.lit(" "))
    rows = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(pad(F.col("c_custkey").cast("string")).alias("code"), pad("c_name").alias("name"), pad("c_mktsegment").alias("market"), pad("n_name").alias("sector"), F.lit(None).cast("string").alias("kind"))
    return nz.normalize_master(rows)


@query("SELECT s_suppkey::VARCHAR AS code, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END AS name, 'X' AS market FROM supplier WHERE s_suppkey % 5 <> 0")
def prj_8_normalize_delisted_master(spark, d):
    s = views.table(spark, d, "supplier")
    return nz.normalize_delisted_master(s.select(F.when(F.col("s_suppkey") % 5 == 0, "  ").otherwise(F.col("s_suppkey").cast("string")).alias("short_code"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name")).alias("codeName"), F.lit("X ").alias("marketName")))


def _json(*pairs) -> F.Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in pairs]))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey * 1000.0::DOUBLE END AS target_mean, CASE WHEN o_orderkey % 4 > 0 THEN 4.25::DOUBLE END AS recomm_mean, CASE WHEN o_orderkey % 4 > 1 THEN o_orderdate::DATE::VARCHAR END AS base_date FROM orders")
def prj_9_extract_consensus(spark, d):
    k = F.col("o_orderkey")
    info = F.struct(F.format_number(k * 1000, 0).alias("priceTargetMean"), F.lit("4.25").alias("recommMean"), F.when(k % 4 > 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("").alias("createDate"))
    o = views.table(spark, d, "orders").select(k.alias("id"), _json(("consensusInfo", F.when(k % 4 > 0, info))).alias("payload"))
    return nz.extract_consensus(o)


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 IN (1, 2) THEN o_orderkey::DOUBLE END AS fwd_eps, CASE WHEN o_orderkey % 4 IN (1, 2) THEN 7.5::DOUBLE END AS prev_eps, CASE WHEN o_orderkey % 4 IN (1, 2) THEN '202612' END AS est_year FROM orders")
def prj_10_extract_estimate(spark, d):
    k = F.col("o_orderkey")
    mark = F.when(k % 4 == 0, "N").otherwise("Y")
    titles = ['{"key":"202412","isConsensus":"N"}', '{"key":"202512","isConsensus":"N"}', '{"key":"202612","isConsensus":"%s"}', '{"key":"202712","isConsensus":"%s"}']
    name = F.when(k % 4 == 3, '"PER"').when(k % 4 == 2, '{"name":"EPS"}').otherwise('"EPS"')
    body = F.concat(
        F.lit('{"financeInfo":{"trTitleList":[' + ",".join(titles[:2]) + ',{"key":"202612","isConsensus":"'), mark, F.lit('"},{"key":"202712","isConsensus":"'), mark,
        F.lit('"}],"rowList":[{"title":"Sales","columns":{"202612":{"value":"1"}}},{"title":'), name, F.lit(',"columns":{"202512":{"value":"7.5"},"202612":{"value":"'), F.format_number(k, 0), F.lit('"}}}]}}'),
    )
    return nz.extract_estimate(views.table(spark, d, "orders").select(k.alias("id"), body.alias("payload")))


def _array_bars(spark, d):
    b = views.bars(spark, d)
    halted = F.col("close") % 5 == 0
    z = lambda c: F.when(halted, 0).otherwise(F.col(c))
    return b.select("code", "date", z("open").alias("open"), z("low").alias("high"), z("high").alias("low"), F.when(F.col("close") % 7 == 0, 0).otherwise(F.col("close")).alias("close"), F.when(halted, 0).otherwise(F.col("volume") * 100_000).alias("volume"))


@query("""SELECT code, date, CASE WHEN h THEN close ELSE open END AS open, CASE WHEN h THEN close ELSE greatest(low, close) END AS high, CASE WHEN h THEN close ELSE least(high, close) END AS low, close,
    CASE WHEN h THEN 0 ELSE volume * 100000 END AS volume, CAST(round_even(close::DOUBLE * CASE WHEN h THEN 0 ELSE volume * 100000 END / 1e6, 0) AS BIGINT) AS trade_value, 'backfill' AS source
    FROM (SELECT *, close % 5 = 0 AS h FROM v_bars) WHERE close % 7 <> 0""")
def prj_11_normalize_delisted_bars(spark, d):
    return nz.normalize_delisted_bars(_array_bars(spark, d))


@query("SELECT code, date, close, NULL::DOUBLE AS flu_rt, volume AS acc_trde_qty, " + ", ".join(f"{ {'institution': 'open', 'foreign_': '-low'}.get(x, 'NULL::BIGINT')} AS {x}" for x in INVESTORS) + ", 'backfill' AS source FROM v_bars WHERE close % 7 <> 0")
def prj_12_normalize_partial_flow(spark, d):
    b = views.bars(spark, d).select("code", "date", F.when(F.col("close") % 7 != 0, F.col("close")).alias("close"), "volume", F.col("open").alias("institution"), (-F.col("low")).alias("foreign_"))
    return nz.normalize_partial_flow(b)


def _share_lines(spark, d):
    x = views.table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("p"), F.max("l_shipdate").alias("s"))
    return x.select(
        F.col("l_orderkey").alias("id"),
        F.when(F.col("l_orderkey") % 5 == 0, "013").otherwise("000").alias("status"),
        F.col("l_linenumber").alias("pos"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit(f" {nz.COMMON_SHARE}")).otherwise("x").alias("se"),
        F.when(F.col("p") % 3 == 0, "-").otherwise(F.format_number("p", 0)).alias("istc_totqy"),
        F.date_format("s", "yyyy-MM-dd").alias("stlm_dt"),
        F.concat(F.when(F.col("p") % 4 == 0, "no").otherwise(""), F.date_format("s", "yyyyMMdd"), F.lit("000123")).alias("rcept_no"),
    )


_LINES = "SELECT l_orderkey AS id, l_linenumber AS pos, max(l_partkey) AS p, max(l_shipdate)::DATE AS s FROM lineitem GROUP BY ALL"


@query(f"SELECT id, arg_min(p, pos) FILTER (id % 5 <> 0 AND pos % 2 = 0 AND p % 3 <> 0) AS shares, arg_min(s, pos) FILTER (id % 5 <> 0 AND pos % 2 = 0 AND p % 3 <> 0) AS date FROM ({_LINES}) GROUP BY id")
def prj_13_extract_issued_shares(spark, d):
    return nz.extract_issued_shares(_share_lines(spark, d))


@query(f"SELECT id, arg_min(s, pos) FILTER (p % 4 <> 0) AS receipt_date FROM ({_LINES}) GROUP BY id")
def prj_14_extract_receipt_date(spark, d):
    return nz.extract_receipt_date(_share_lines(spark, d))


_SIX = ("netinc", "netinc_prior", "revenue", "revenue_prior", "op_income", "op_income_prior")


def _six(spark, d):
    o = views.table(spark, d, "orders")
    v = F.col("o_totalprice")
    return o.select(F.col("o_orderkey").cast("string").alias("code"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"), F.when(F.col("o_orderkey") % 3 != 0, v).alias("netinc"), *[v.alias(c) for c in _SIX[1:]])


@query(
    """SELECT o_orderkey::VARCHAR AS code, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS period, CAST(e + CASE WHEN quarter(o_orderdate) = 4 THEN 90 ELSE 45 END AS DATE) AS avail_date,
    CAST(e + CASE WHEN quarter(o_orderdate) = 4 THEN 90 ELSE 45 END AS DATE) AS knowledge_date, """
    + ", ".join(f"o_totalprice AS {c}" for c in _SIX)
    + " FROM (SELECT *, last_day(CAST(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH AS DATE)) AS e FROM orders) WHERE o_orderkey % 3 <> 0"
)
def prj_15_build_earnings_rows(spark, d):
    return nz.build_earnings_rows(_six(spark, d), "avail", F.current_date())


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS target_mean, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS recomm_mean, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice END AS fwd_eps, DATE '2024-02-01' AS date FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 OR o_orderkey % 5 = 0")
def prj_16_build_consensus_rows(spark, d):
    o = views.table(spark, d, "orders")
    v = lambda n: F.when(F.col("o_orderkey") % n == 0, F.col("o_totalprice"))
    return nz.build_consensus_rows(o.select(F.col("o_orderkey").alias("id"), v(2).alias("target_mean"), v(3).alias("recomm_mean"), v(5).alias("fwd_eps")), F.to_date(F.lit("2024-02-01")))


@query("SELECT code, name, market FROM v_master WHERE market IN ('NATION_1', 'NATION_2', 'NATION_3') AND code LIKE '%0'")
def flt_1_common_stock_only(spark, d):
    return nz.common_stock_only(views.suppliers(spark, d), markets=("NATION_1", "NATION_2", "NATION_3"))


@query("SELECT * FROM v_bars WHERE date >= DATE '2024-01-20' - 5")
def flt_2_cutoff_window(spark, d):
    return nz.cutoff_window(views.bars(spark, d), F.to_date(F.lit("2024-01-20")), 5)


@query("SELECT b.* FROM v_bars b LEFT JOIN (SELECT code, max(date) AS m FROM v_bars WHERE day(date) % 9 = 0 AND open % 2 = 0 GROUP BY code) s USING (code) WHERE m IS NULL OR date > m")
def flt_3_newer_than_stored(spark, d):
    b = views.bars(spark, d)
    return nz.newer_than_stored(b, b.where("day(date) % 9 = 0 and open % 2 = 0"))


_AVAIL = "CAST(last_day(make_date(substr(period, 1, 4)::INT, substr(period, 6, 1)::INT * 3, 1)) + CASE WHEN period LIKE '%Q4' THEN 90 ELSE 45 END AS DATE)"


@query(f"SELECT * FROM v_facts WHERE {_AVAIL} <= DATE '1999-02-10'")
def flt_4_lookahead_guard(spark, d):
    return nz.lookahead_guard(views.facts(spark, d), F.to_date(F.lit("1999-02-10")))


@query("SELECT code, name, market, l AS last_trade_date FROM (SELECT m.*, CASE WHEN code::INT % 3 > 0 THEN l END AS l FROM v_master m LEFT JOIN (SELECT code, min(date) AS l FROM v_long GROUP BY code) USING (code)) WHERE market IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5') AND (l IS NULL OR l >= DATE '1995-01-15')")
def flt_5_universe_predicate(spark, d):
    last = views.long_bars(spark, d).groupBy("code").agg(F.min("date").alias("l"))
    m = views.suppliers(spark, d).join(last, "code", "left").withColumn("last_trade_date", F.expr("case when cast(code as int) % 3 > 0 then l end")).drop("l")
    return m.where(nz.universe_predicate(F.to_date(F.lit("1995-01-15")), ("NATION_1", "NATION_2", "NATION_3", "NATION_5")))


@query("SELECT * FROM v_bars WHERE date >= DATE '2024-01-11'")
def flt_6_since(spark, d):
    return nz.since(views.bars(spark, d), F.to_date(F.lit("2024-01-11")))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN '013' ELSE '000' END AS status, CASE WHEN event_type <> 'error' THEN value END AS value FROM events")
def flt_7_status_ok(spark, d):
    e = views.table(spark, d, "events").select("event_id", F.when(F.col("event_type") == "error", "013").otherwise("000").alias("status"), "value")
    return nz.status_ok(e, "value")


@query("SELECT * FROM v_master WHERE market = 'NATION_3'")
def flt_8_market_filter(spark, d):
    return nz.market_filter(views.suppliers(spark, d), "NATION_3")


@query(f"SELECT event_id, {_S} AS a, {_NUM} AS b, 0::BIGINT AS c, dec::DOUBLE AS f FROM v_raw")
def fn_1_lenient(spark, d):
    r = raw(spark, d)
    return r.select("event_id", fn.lenient_int(F.concat(F.lit(" "), "signed")).alias("a"), fn.lenient_int(F.col("maybe")).alias("b"), fn.lenient_int(F.lit("12.5")).alias("c"), fn.lenient_float(F.concat(F.lit("+"), "dec")).alias("f"))


@query("SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN px::DOUBLE END AS a, dec::DOUBLE AS b, NULL::DOUBLE AS c FROM v_raw")
def fn_2_nullable_float(spark, d):
    return raw(spark, d).select("event_id", fn.nullable_float(F.when(F.col("maybe") == "n/a", "n/a").otherwise(F.format_number("px", 0))).alias("a"), fn.nullable_float(F.col("dec")).alias("b"), fn.nullable_float(F.concat("px", F.lit("d"))).alias("c"))


@query("SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN px END AS a, NULL::BIGINT AS b FROM v_raw")
def fn_3_nullable_int(spark, d):
    return raw(spark, d).select("event_id", fn.nullable_int(F.when(F.col("maybe") == "n/a", "-").otherwise(F.format_number("px", 0))).alias("a"), fn.nullable_int(F.col("dec")).alias("b"))


@query("SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN px END AS a, px // 100 AS b FROM v_raw")
def fn_4_nullable_int_trunc(spark, d):
    return raw(spark, d).select("event_id", fn.nullable_int_trunc(F.when(F.col("maybe") == "n/a", "N/A").otherwise(F.concat(F.lit('"'), F.format_number("px", 0), F.lit('"')))).alias("a"), fn.nullable_int_trunc(F.col("dec")).alias("b"))


@query(f"SELECT event_id, {_S} AS a FROM v_raw")
def fn_5_signed_int(spark, d):
    return raw(spark, d).select("event_id", fn.signed_int(F.col("signed")).alias("a"))


_MISSING = "CASE event_id % 4 WHEN 0 THEN px % 3 WHEN 3 THEN px END"


@query(f"SELECT event_id, {_MISSING}::DOUBLE AS f, {_MISSING} AS i, {_MISSING} AS t, count(*) FILTER ({_MISSING} = 0) OVER () AS zeros FROM v_ev")
def fn_6_falsy(spark, d):
    """Landed texts: zeros stay zeros, an empty text and a null are missing."""
    k = F.col("event_id") % 4
    text = F.when(k == 0, (F.col("px") % 3).cast("string")).when(k == 1, "").when(k == 3, F.col("px").cast("string"))
    e = raw(spark, d).select("event_id", text.alias("v"))
    out = e.select("event_id", fn.nullable_float(F.col("v")).alias("f"), fn.nullable_int(F.col("v")).alias("i"), fn.nullable_int_trunc(F.col("v")).alias("t"))
    return out.crossJoin(F.broadcast(out.agg(F.count_if(F.col("i") == 0).alias("zeros"))))


@query("SELECT code, date, CASE WHEN p IS NOT NULL AND p <> 0 THEN (close - p)::DOUBLE / abs(p) END AS growth FROM (SELECT *, lag(close - 500) OVER (PARTITION BY code ORDER BY date) AS p FROM v_bars)")
def fn_7_yoy_growth(spark, d):
    return views.bars(spark, d).select("code", "date", fn.yoy_growth(F.col("close"), F.expr("lag(close - 500) over (partition by code order by date)")).alias("growth"))


@query("SELECT code, date, CAST(round_even(close::DOUBLE * (volume * 1000)::DOUBLE / 1e6, 0) AS BIGINT) AS v FROM v_bars")
def fn_8_approx_trade_value(spark, d):
    return views.bars(spark, d).select("code", "date", fn.approx_trade_value(F.col("close"), F.col("volume") * 1000).alias("v"))


@query("SELECT event_id, ts::DATE AS a, ts::DATE AS b, ts::DATE AS c, NULL::DATE AS e FROM events")
def fn_9_parse_date(spark, d):
    return views.table(spark, d, "events").select("event_id", *[fn.parse_date(F.date_format("ts", f)).alias(n) for n, f in (("a", "yyyyMMdd"), ("b", "yyyy-MM-dd"), ("c", "yyyy.MM.dd"), ("e", "yyyy/MM/dd"))])


@query(f"SELECT DISTINCT period, {_AVAIL} AS avail FROM v_facts")
def fn_10_avail_date(spark, d):
    return views.facts(spark, d).select("period").distinct().select("period", fn.avail_date(F.col("period")).alias("avail"))


@query("SELECT o_orderkey, year(o_orderdate) || 'Q' || ((month(o_orderdate) - 1) // 3 + 1) AS period FROM orders")
def fn_11_period_of(spark, d):
    return views.table(spark, d, "orders").select("o_orderkey", fn.period_of(F.year("o_orderdate"), fn.quarter_of(F.col("o_orderdate"))).alias("period"))


@query("SELECT DISTINCT o_orderdate::DATE AS today, year(q) || 'Q' || quarter(q) AS period FROM (SELECT o_orderdate, CAST(date_trunc('quarter', o_orderdate) - to_months(3 * i::INT) AS DATE) AS q FROM orders, range(5) t(i))")
def fn_12_recent_quarters(spark, d):
    days = views.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("today")).distinct()
    return days.select("today", F.explode(fn.recent_quarters(F.col("today"), 5)).alias("period"))


@query("SELECT y || 'Q' || q AS period, count(v.period) AS facts FROM range(1995, 2000) a(y) CROSS JOIN range(1, 5) b(q) LEFT JOIN v_facts v ON v.period = y || 'Q' || q GROUP BY ALL")
def fn_13_period_range(spark, d):
    f = views.facts(spark, d)
    wanted = spark.range(1).select(F.explode(fn.period_range(1995, 1999)).alias("period"))
    return wanted.join(f.groupBy("period").agg(F.count("*").alias("facts")), "period", "left").select("period", F.coalesce("facts", F.lit(0)).alias("facts"))


# after each "://" that follows a scheme: what stands before the first "@" is a user, a colon and a password
_DSN_SQL = r"""SELECT doc_id, array_to_string(list_transform(range(1, len(p) + 1), lambda i: CASE
        WHEN i > 1 AND regexp_matches(p[i - 1], '[A-Za-z][A-Za-z0-9+.-]*$') AND contains(p[i], '@') AND strpos(h[i], ':') BETWEEN 2 AND length(h[i]) - 1 AND NOT regexp_matches(h[i], '[/\s]')
        THEN split_part(p[i], ':', 1) || ':***' || substr(p[i], strpos(p[i], '@')) ELSE p[i] END), '://') AS t
    FROM (SELECT *, list_transform(p, lambda x: split_part(x, '@', 1)) AS h FROM (SELECT doc_id, string_split(t, '://') AS p FROM ({})))"""


@query("SELECT doc_id, md5(t) AS t FROM (" + _DSN_SQL.format("SELECT doc_id, 'db://user' || doc_id || ':pw' || doc_id || '@host/x http://h:80/a' || doc_id || '@b ' || coalesce(text, '') AS t FROM documents") + ")")
def fn_14_mask_dsn(spark, d):
    t = F.concat(F.lit("db://user"), "doc_id", F.lit(":pw"), "doc_id", F.lit("@host/x http://h:80/a"), "doc_id", F.lit("@b "), F.coalesce("text", F.lit("")))
    return views.table(spark, d, "documents").select("doc_id", F.md5(fn.mask_dsn(t)).alias("t"))


# a name before an equals sign and the beginning of a value after it
_SECRETS_SQL = """CAST(len(list_filter(range(1, len(p)), lambda i: regexp_matches(lower(p[i]), '(^|[^0-9a-z_])(api_key|apikey|token)$')
    AND p[i + 1] <> '' AND NOT contains('& "' || chr(39) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), left(p[i + 1], 1)))) AS BIGINT)"""


@query(f"SELECT doc_id, 'https://h/?api_key=***&f=' || source || ' TOKEN=***\" apikey=\"k\" Token=***''' AS t, '' AS n, {_SECRETS_SQL} AS masked FROM (SELECT *, string_split(regexp_replace(text, ' *= *', '=', 'g'), '=') AS p FROM documents)")
def fn_15_mask_secrets(spark, d):
    t = views.table(spark, d, "documents")
    squeezed = F.regexp_replace("text", " *= *", "=")
    hits = lambda c: F.size(F.regexp_extract_all(c, F.lit(r"(?i)\b((?:api_?key|token)=\*\*\*)"), F.lit(1)))
    return t.select("doc_id", fn.mask_secrets(F.concat(F.lit("https://h/?api_key=s3"), "doc_id", F.lit("&f="), "source", F.lit(" TOKEN=abc\" apikey=\"k\" Token=x'"))).alias("t"), fn.mask_secrets(F.lit(None).cast("string")).alias("n"), hits(fn.mask_secrets(squeezed)).cast("bigint").alias("masked"))


@query("SELECT doc_id, md5(array_to_string(list_concat(['run', '--db', '***'], string_split(coalesce(text, ''), ' ')[2:], ['--dsn', '***', source]), ' ')) AS t FROM documents")
def fn_16_mask_options(spark, d):
    """The words of each text as arguments, the first of them a secret."""
    words = F.split(F.coalesce("text", F.lit("")), " ", -1)
    args = F.concat(F.array(F.lit("run"), F.lit("--db")), words, F.array(F.lit("--dsn"), F.lit("x"), F.col("source")))
    return views.table(spark, d, "documents").select("doc_id", F.md5(F.array_join(fn.mask_options(args), " ")).alias("t"))


LIMITS = {"click": 4, "error": 8, "view": 30}


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 4 WHEN 'error' THEN 8 WHEN 'view' THEN 30 ELSE 2 END AS \"limit\", event_id % 10 >= CASE event_type WHEN 'click' THEN 4 WHEN 'error' THEN 8 WHEN 'view' THEN 30 ELSE 2 END AS stale FROM events")
def fn_17_is_stale(spark, d):
    e = views.table(spark, d, "events")
    return e.select("event_id", fn.stale_threshold(F.col("event_type"), LIMITS).alias("limit"), fn.is_stale(F.col("event_type"), F.col("event_id") % 10, LIMITS).alias("stale"))


@query("SELECT o_orderkey, format('{:.1f}', o_orderkey * 100000 / 1e6) AS mb, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 150.0::DOUBLE END AS change FROM orders")
def fn_18_formats(spark, d):
    o = views.table(spark, d, "orders")
    k = F.col("o_orderkey")
    return o.select("o_orderkey", F.replace(fn.size_mb(k * 100_000), F.lit(","), F.lit("")).alias("mb"), fn.change_percent(k * 5, F.when(k % 2 == 1, k * 2).otherwise(0)).alias("change"))
