"""Queries: joins and work lists, aggregates, windows, ranking and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions import scalars as fn
from tideline.operators import asof, feeds, quality
from tideline.operators import normalize as nz
from tideline.operators import worklists as wl
from tideline.plans.catalog import query
from tideline.plans.queries_read import raw
from tideline.sources import views

day = lambda text: F.to_date(F.lit(text))


def sourced(spark, d):
    return views.bars(spark, d).withColumn("source", F.when(F.dayofmonth("date") % 3 == 0, "backfill").otherwise("primary"))


@query("SELECT c_custkey::VARCHAR AS code, p.period FROM customer CROSS JOIN (SELECT y || 'Q' || q AS period FROM range(1995, 1999) a(y), range(1, 5) b(q)) p WHERE NOT EXISTS (SELECT 1 FROM v_facts f WHERE f.code = c_custkey::VARCHAR AND f.period = p.period)")
def jn_1_pending_periods(spark, d):
    codes = views.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("code"))
    periods = spark.range(1).select(F.explode(fn.period_range(1995, 1998)).alias("period"))
    return wl.pending_periods(codes, periods, views.facts(spark, d))


@query("SELECT code, min(date) AS first_date, max(date) AS last_date FROM v_src WHERE source = 'backfill' AND code NOT IN (SELECT code FROM v_bars WHERE date = DATE '2024-01-10') GROUP BY code")
def jn_2_shares_worklist(spark, d):
    return wl.shares_worklist(sourced(spark, d), views.bars(spark, d).where("date = '2024-01-10'"), "backfill")


@query("SELECT DISTINCT code FROM v_src WHERE source = 'backfill' AND code NOT IN (SELECT code FROM v_bars WHERE date = DATE '2024-01-11')")
def jn_3_flow_worklist(spark, d):
    return wl.flow_worklist(sourced(spark, d), views.bars(spark, d).where("date = '2024-01-11'"), "backfill")


MARKETS = ("NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_7", "NATION_11", "NATION_13")


def delisted(spark, d):
    last = views.long_bars(spark, d).groupBy("code").agg(F.min("date").alias("l"))
    m = views.suppliers(spark, d).join(last, "code", "left")
    k = F.col("code").cast("int")
    return m.select("code", "name", "market", F.when(k % 3 > 0, F.col("l")).alias("last_trade_date"), F.when(k % 4 == 0, F.col("l")).alias("checked"))


@query(
    "SELECT code, l AS last_trade_date FROM (SELECT m.*, CASE WHEN code::INT % 3 > 0 THEN l END AS l FROM v_master m LEFT JOIN (SELECT code, min(date) AS l FROM v_long GROUP BY code) USING (code)) "
    f"WHERE market IN {MARKETS} AND (l IS NULL OR l >= DATE '1995-01-03') AND code::INT % 4 <> 0 AND code NOT IN (SELECT code FROM v_long WHERE date = DATE '1996-03-01')"
)
def jn_4_delisted_bars_worklist(spark, d):
    fetched = views.long_bars(spark, d).where("date = '1996-03-01'").withColumn("source", F.lit("backfill"))
    return wl.delisted_bars_worklist(delisted(spark, d), fetched, "backfill", day("1995-01-03"), MARKETS)


@query("SELECT DISTINCT code FROM v_bars WHERE code NOT IN (SELECT code FROM v_bars WHERE date = DATE '2024-01-15')")
def jn_5_coverage_missing(spark, d):
    b = views.bars(spark, d)
    return wl.coverage_missing(b.select("code").distinct(), b, day("2024-01-15"))


@query("SELECT code FROM v_master WHERE code NOT IN (SELECT code FROM v_long WHERE date = DATE '1996-05-06')")
def jn_6_pending_today(spark, d):
    return wl.pending_today(views.suppliers(spark, d).select("code"), views.long_bars(spark, d), day("1996-05-06"))


@query("SELECT code, name, n, n IS NULL AS unmapped FROM v_master LEFT JOIN (SELECT code, count(*) AS n FROM v_long WHERE code::INT % 3 > 0 GROUP BY code) USING (code)")
def jn_7_map_identifiers(spark, d):
    m = views.long_bars(spark, d).where("cast(code as int) % 3 > 0").groupBy("code").agg(F.count("*").alias("n"))
    mapped, unmapped = wl.map_identifiers(views.suppliers(spark, d).select("code", "name"), m)
    return mapped.withColumn("unmapped", F.lit(False)).unionByName(unmapped.withColumns({"n": F.lit(None).cast("bigint"), "unmapped": F.lit(True)}))


@query("SELECT m.*, l AS last_trade_date FROM v_master m LEFT JOIN (SELECT code, max(date) AS l FROM v_long WHERE code::INT % 3 > 0 GROUP BY code) USING (code)")
def jn_8_attach_last_trade_date(spark, d):
    return wl.attach_last_trade_date(views.suppliers(spark, d), views.long_bars(spark, d).where("cast(code as int) % 3 > 0"))


@query("SELECT feed, feed IN (SELECT event_type FROM events WHERE value >= 100) AS listed FROM (SELECT DISTINCT event_type AS feed FROM events UNION ALL SELECT 'gone')")
def jn_9_plan_vs_listing(spark, d):
    e = views.table(spark, d, "events").select(F.col("event_type").alias("feed"), "value")
    wanted = e.select("feed").distinct().union(spark.range(1).select(F.lit("gone").alias("feed")))
    return wl.plan_vs_listing(wanted, e.where("value >= 100"))


@query("SELECT c_custkey::VARCHAR AS code, v.value FROM customer LEFT JOIN (SELECT code, max(value) AS value FROM v_facts WHERE period = '1997Q2' GROUP BY code) v ON v.code = c_custkey::VARCHAR")
def jn_10_fill_requested(spark, d):
    wanted = views.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("code"))
    return wl.fill_requested(wanted, views.facts(spark, d).where("period = '1997Q2'").groupBy("code").agg(F.max("value").alias("value")), "code")


@query("SELECT * FROM v_facts WHERE period IN ('1996Q1', '1996Q2', '1997Q4') QUALIFY row_number() OVER (PARTITION BY code, period ORDER BY knowledge_date DESC) = 1")
def jn_11_latest_version(spark, d):
    f = views.facts(spark, d)
    return asof.latest_version(f, f.where("period in ('1996Q1', '1996Q2', '1997Q4')"))


@query("SELECT * FROM v_facts WHERE knowledge_date <= DATE '1997-05-20' QUALIFY row_number() OVER (PARTITION BY code, period ORDER BY knowledge_date DESC) = 1")
def jn_12_asof_earnings(spark, d):
    return asof.asof_earnings(views.facts(spark, d), day("1997-05-20"))


@query("SELECT b.*, s.shares, b.close * s.shares AS market_cap FROM v_share_bars b ASOF LEFT JOIN v_shares s ON b.code = s.code AND b.date >= s.date")
def jn_13_market_cap_asof(spark, d):
    return asof.market_cap_asof(views.share_bars(spark, d), views.shares(spark, d))


@query("SELECT b.code, b.date, b.close, arg_max(s.shares, (s.date, s.shares)) AS shares FROM v_share_bars b LEFT JOIN v_shares s ON b.code = s.code AND s.date <= b.date AND s.date + CAST(s.shares % 200 AS INTEGER) <= b.date GROUP BY ALL")
def jn_14_asof_shares_pit(spark, d):
    s = views.shares(spark, d).withColumn("knowledge_date", F.expr("date_add(date, cast(shares % 200 as int))"))
    return asof.asof_shares_pit(views.share_bars(spark, d), s)


@query("SELECT DISTINCT code FROM v_bars WHERE code IN (SELECT code FROM v_bars WHERE open % 3 = 0) AND code IN (SELECT code FROM v_bars WHERE date >= DATE '2024-01-29' AND close % 3 = 0)")
def jn_15_codes_with_rows(spark, d):
    b = views.bars(spark, d)
    return wl.swept(b.select("code").distinct(), b.where("open % 3 = 0"), b.where("close % 3 = 0"), day("2024-01-29"))


def counts(spark, d):
    """Tables of events by type, now and before: one that has lost a tenth, one that has lost a hundredth, one gone."""
    e = views.table(spark, d, "events").where("event_type in ('click', 'view', 'error')").select("event_type", "event_id", F.to_date("ts").alias("date"))
    lost = ((F.col("event_type") == "click") & (F.col("event_id") % 10 == 0)) | ((F.col("event_type") == "error") & (F.col("event_id") % 100 == 0))
    expected = ("click", "view", "error")
    now = quality.counts_by(e.where(~lost), F.col("event_type"), expected, absent=("gone",))
    also = F.explode(F.when(F.col("event_type") == "view", F.array(F.lit("view"), F.lit("gone"))).otherwise(F.array("event_type")))
    was = quality.counts_by(e.withColumn("event_type", also), F.col("event_type"), (*expected, "gone"))
    return now, was


_NOW = (
    "SELECT event_type AS \"table\", count(*) AS rows, max(ts::DATE) AS newest FROM events WHERE event_type IN ('click', 'view', 'error') AND NOT (event_type = 'click' AND event_id % 10 = 0) "
    "AND NOT (event_type = 'error' AND event_id % 100 = 0) GROUP BY 1 UNION ALL SELECT 'gone', NULL, NULL"
)
_WAS = (
    "SELECT event_type AS \"table\", count(*) AS rows, max(ts::DATE) AS newest FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY 1 "
    "UNION ALL SELECT 'gone', count(*), max(ts::DATE) FROM events WHERE event_type = 'view'"
)


@query(f"SELECT n.*, w.rows AS was_rows, w.newest AS was_newest FROM ({_NOW}) n LEFT JOIN ({_WAS}) w USING (\"table\")")
def jn_16_compare_to_baseline(spark, d):
    return quality.compare_to_baseline(*counts(spark, d))


@query("""SELECT event_id AS file, CASE WHEN event_id % 5 = 0 THEN 'absent' WHEN event_id % 7 = 0 THEN 'no record' WHEN event_id % 11 = 0 THEN 'modified' WHEN event_id % 13 = 0 THEN 'size'
    WHEN event_id % 17 = 0 AND event_id % 2 = 0 THEN 'checksum' END AS reason FROM events""")
def jn_17_needs_refresh(spark, d):
    e, k = views.table(spark, d, "events"), F.col("event_id")
    listing = e.select(k.alias("file"), F.lit("m").alias("modified"), k.alias("size"))
    inventory = e.where("event_id % 5 > 0").select(k.alias("file"), F.when(k % 13 == 0, k + 1).otherwise(k).alias("size"), F.lit("abc").alias("sha256"))
    manifest = e.where("event_id % 7 > 0").select(k.alias("file"), F.when(k % 11 == 0, "n").otherwise("m").alias("modified"), F.when((k % 17 == 0) & (k % 2 == 0), "xyz").when(k % 17 > 0, "abc").alias("sha256"))
    return feeds.needs_refresh(listing, inventory, manifest)


@query("SELECT code, max(date) AS latest FROM v_bars GROUP BY code")
def agg_1_latest_date_per_code(spark, d):
    return quality.latest_date_per_code(views.bars(spark, d))


@query("SELECT code, min(date) AS first_date, max(date) AS last_date FROM v_long GROUP BY code")
def agg_2_trading_span(spark, d):
    return quality.trading_span(views.long_bars(spark, d))


@query("SELECT code, avg(trade_value) AS avg_value FROM v_long WHERE date >= (SELECT max(date) FROM v_long) - 90 GROUP BY code")
def agg_3_liquidity(spark, d):
    return wl.liquidity(views.long_bars(spark, d))


def statement_lines(spark, d):
    """Lines of orders as statement lines with labels and amounts, some blank."""
    x = views.table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("p"))
    k = F.col("p")
    label = F.when(k % 3 == 0, F.lit(f" {nz.NET_INCOME[0]} ")).when(k % 3 == 1, nz.REVENUE[0]).otherwise(nz.OPERATING[0])
    return x.select(
        F.col("l_orderkey").alias("id"),
        F.when(F.col("l_orderkey") % 5 == 0, "013").otherwise("000").alias("status"),
        F.col("l_linenumber").alias("pos"),
        label.alias("account_nm"),
        F.when(k % 4 == 0, "").otherwise(F.format_number(k, 0)).alias("thstrm_amount"),
        F.when(k % 5 == 0, "-").otherwise(F.format_number(k * 2, 0)).alias("frmtrm_amount"),
    )


_L = "SELECT l_orderkey AS id, l_linenumber AS pos, max(l_partkey) AS p FROM lineitem GROUP BY ALL"


def _pick_sql(m: int, name: str) -> str:
    fits = f"id % 5 <> 0 AND p % 3 = {m}"
    at = f"(min(pos) FILTER ({fits} AND p % 4 <> 0) OVER (PARTITION BY id))"
    return f"{at} AS at_{name}, CASE WHEN {fits} AND p % 4 <> 0 AND pos = {at} THEN p::DOUBLE END AS c_{name}, CASE WHEN {fits} AND p % 5 <> 0 AND ({at} IS NULL OR pos <= {at}) THEN pos END AS q_{name}"


def _pick_out(name: str) -> str:
    return f"max(c_{name}) AS {name}, arg_max(2.0::DOUBLE * p, q_{name}) FILTER (q_{name} IS NOT NULL) AS {name}_prior"


@query(f"SELECT id, {_pick_out('netinc')} FROM (SELECT *, {_pick_sql(0, 'netinc')} FROM ({_L})) GROUP BY id")
def agg_4_first_match_pick(spark, d):
    return nz.financials_six(statement_lines(spark, d), ["id"]).select("id", "netinc", "netinc_prior")


@query(f"SELECT id, {', '.join(map(_pick_out, ('netinc', 'revenue', 'op_income')))} FROM (SELECT *, {', '.join(_pick_sql(m, n) for m, n in enumerate(('netinc', 'revenue', 'op_income')))} FROM ({_L})) GROUP BY id")
def agg_5_financials_six(spark, d):
    return nz.financials_six(statement_lines(spark, d), ["id"])


@query(_NOW)
def agg_6_table_counts(spark, d):
    return counts(spark, d)[0]


@query("SELECT max(date) AS newest FROM v_long")
def agg_7_newest_date(spark, d):
    return quality.newest_date(views.long_bars(spark, d))


@query("SELECT source, count(*) AS rows, count(DISTINCT code) AS codes, count(CASE WHEN open % 2 = 0 THEN open END) AS known FROM v_src GROUP BY source")
def agg_8_source_profile(spark, d):
    return quality.source_profile(sourced(spark, d).withColumn("odd", F.expr("case when open % 2 = 0 then open end")), "odd")


@query("SELECT count(*) AS duplicates FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def agg_9_duplicate_versions(spark, d):
    return quality.duplicate_versions(views.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT count(*) FILTER (code::INT % 4 = 0) AS checked, count(*) FILTER (code::INT % 4 <> 0) AS unchecked FROM v_master")
def agg_10_checked_profile(spark, d):
    return quality.checked_profile(delisted(spark, d))


def outcomes(spark, d):
    k = F.col("event_id")
    return views.table(spark, d, "events").select(k.cast("string").alias("code"), F.when(k % 11 == 0, "failed").when(k % 3 == 0, "skipped").otherwise("done").alias("outcome"), (k % 100).alias("rows"))


_OUT = "SELECT CASE WHEN event_id % 11 = 0 THEN 'failed' WHEN event_id % 3 = 0 THEN 'skipped' ELSE 'done' END AS o, event_id % 100 AS r FROM events"


@query(f"SELECT count(*) FILTER (o = 'done') AS done, count(*) FILTER (o = 'skipped') AS skipped, count(*) FILTER (o = 'failed') AS failed, CAST(sum(r) FILTER (o = 'done') AS BIGINT) AS rows FROM ({_OUT})")
def agg_11_run_summary(spark, d):
    return quality.run_summary(outcomes(spark, d))


def report(spark, d):
    e = views.table(spark, d, "events").select(F.col("event_type").alias("feed"), "event_id", F.to_date("ts").alias("date"))
    k = F.concat("feed", F.lit("-"), F.dayofmonth("date"))
    wanted = e.select(k.alias("feed")).distinct()
    listing = e.where("day(date) % 5 > 0").groupBy(k.alias("feed")).agg(F.sum("event_id").alias("size"))
    fetched = e.where("day(date) % 7 = 0").select(k.alias("feed"))
    streaks = e.groupBy(k.alias("feed")).agg((F.count("*") % 4).alias("streak"))
    return feeds.feed_status_report(wanted, listing, fetched, streaks, {})


_REPORT = """SELECT event_type || '-' || day(ts) AS feed, CASE WHEN day(any_value(ts)) % 5 = 0 THEN 'not listed' WHEN day(any_value(ts)) % 7 = 0 THEN 'new' WHEN count(*) % 4 >= 2 THEN 'stale' ELSE 'current' END AS verdict,
    count(*) % 4 AS streak, CASE WHEN day(any_value(ts)) % 5 = 0 THEN 0 ELSE CAST(sum(event_id) AS BIGINT) END AS size FROM events GROUP BY 1"""


@query(f"SELECT verdict, count(*) AS feeds, CAST(sum(size) AS BIGINT) AS bytes FROM ({_REPORT}) GROUP BY verdict")
def agg_12_status_totals(spark, d):
    return quality.status_totals(report(spark, d))


@query("SELECT coalesce(max(date) FILTER (code = '000005'), DATE '2000-01-01') AS latest FROM v_long")
def agg_13_market_latest(spark, d):
    return quality.market_latest(views.long_bars(spark, d), "000005", day("2000-01-01"))


@query("SELECT quantile_cont(e, 0.5) AS p50, quantile_cont(e, 0.95) AS p95, quantile_cont(e, 0.99) AS p99 FROM (SELECT abs(close * volume - trade_value)::DOUBLE / abs(trade_value) AS e FROM v_bars)")
def agg_14_approx_error_profile(spark, d):
    return quality.approx_error_profile(views.bars(spark, d).withColumn("approx", F.col("close") * F.col("volume")), "approx", "trade_value")


@query("SELECT source, count(*) AS known, count(*) FILTER (r = 0) AS balanced, CAST(sum(abs(r)) AS BIGINT) AS residual FROM (SELECT source, CASE WHEN source = 'primary' THEN 0 ELSE close - low END AS r FROM v_src) GROUP BY source")
def agg_15_flow_residual(spark, d):
    s = sourced(spark, d).select("source", F.col("close").alias("individual"), (-F.col("low")).alias("foreign_"), F.lit(0).alias("institution"), F.when(F.col("source") == "primary", F.col("low") - F.col("close")).otherwise(0).alias("other_corp"))
    return quality.flow_residual(s)


@query("SELECT * FROM v_facts QUALIFY row_number() OVER (PARTITION BY code, period ORDER BY knowledge_date DESC) = 1")
def win_1_newest_per_key(spark, d):
    return asof.newest_per_key(views.facts(spark, d), ["code", "period"], "knowledge_date")


@query("""WITH r AS (SELECT o_custkey::VARCHAR AS code, year(o_orderdate) AS y, o_orderkey % 4 AS rank, o_orderdate::DATE AS date, o_orderkey AS n, CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate::DATE + 60 END AS receipt FROM orders WHERE o_orderkey % 5 > 0)
    SELECT code, date, n AS shares_outstanding, coalesce(receipt, date) AS knowledge_date FROM r QUALIFY row_number() OVER (PARTITION BY code, y ORDER BY rank, date, n) = 1""")
def win_2_first_success_per_year(spark, d):
    k = F.col("o_orderkey")
    date = F.to_date("o_orderdate")
    order = F.array(*[F.lit(x) for x in nz.REPORT_ORDER])
    r = views.table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("code"), F.year("o_orderdate").alias("year"), F.element_at(order, (k % 4 + 1).cast("int")).alias("report"), F.when(k % 5 > 0, k).alias("shares"), date.alias("date"), F.when(k % 3 > 0, F.date_add(date, 60)).alias("receipt_date"))
    return nz.first_success_per_year(r)


@query("""WITH c AS (SELECT *, CASE WHEN lag(modified) OVER w IS NOT DISTINCT FROM modified THEN 0 ELSE 1 END AS ch FROM v_checks WINDOW w AS (PARTITION BY feed ORDER BY checked)),
    g AS (SELECT *, sum(ch) OVER (PARTITION BY feed ORDER BY checked) AS run FROM c)
    SELECT feed, checked, modified, row_number() OVER (PARTITION BY feed, run ORDER BY checked) - 1 AS streak FROM g""")
def win_3_unchanged_streak(spark, d):
    return feeds.unchanged_streak(views.feed_checks(spark, d), 5_000)


@query("SELECT code, date, event_id, px FROM v_ev QUALIFY row_number() OVER (PARTITION BY code, date ORDER BY event_id) = 1")
def win_4_dedupe_first(spark, d):
    return wl.dedupe_first(raw(spark, d).select("code", "date", "event_id", "px"), ["code", "date"], "event_id")


@query("SELECT code, arg_max(px, event_id) AS px FROM v_ev GROUP BY code")
def win_5_dedupe_last(spark, d):
    return wl.dedupe_last(raw(spark, d), ["code"], "px", "event_id")


@query("SELECT strftime(date, '%Y%m%d') AS generation, n AS number, CASE WHEN r = 1 THEN 'current' WHEN r <= 6 THEN 'kept' ELSE 'delete' END AS state FROM (SELECT date, max(event_id) AS n, row_number() OVER (ORDER BY max(event_id) DESC) AS r FROM v_ev GROUP BY date)")
def win_6_retain_generations(spark, d):
    from tideline.operators.publish import retain_generations

    gens = raw(spark, d).groupBy(F.date_format("date", "yyyyMMdd").alias("generation")).agg(F.max("event_id").alias("number"))
    return retain_generations(gens, 5)


@query("""WITH f AS (SELECT code, date, CASE WHEN close % 2 = 0 THEN 0.5 ELSE 2.0 END AS factor FROM v_bars WHERE close % 5 = 0)
    SELECT b.code, b.date, b.volume, b.trade_value, """ + ", ".join(f"any_value(b.{c})::DOUBLE * coalesce(product(f.factor), 1.0) AS {c}" for c in ("open", "high", "low", "close")) + " FROM v_bars b LEFT JOIN f ON f.code = b.code AND f.date > b.date GROUP BY b.code, b.date, b.volume, b.trade_value")
def win_7_back_adjust(spark, d):
    b = views.bars(spark, d)
    return asof.back_adjust(b, b.where("close % 5 = 0").select("code", "date", F.when(F.col("close") % 2 == 0, 0.5).otherwise(2.0).alias("factor")))


@query("""WITH top AS (SELECT code, avg(trade_value) AS avg_value FROM v_bars WHERE date >= (SELECT max(date) FROM v_bars) - 90 GROUP BY code ORDER BY 2 DESC, code LIMIT 20),
    s AS (SELECT lpad(code, 6, '0') AS code, date, shares FROM v_shares),
    b AS (SELECT b.code, b.date, b.close, t.avg_value FROM v_bars b JOIN top t USING (code))
    SELECT b.*, s.shares, b.close * s.shares AS market_cap FROM b ASOF LEFT JOIN s ON b.code = s.code AND b.date >= s.date""")
def srt_1_top_n_liquid(spark, d):
    b = views.bars(spark, d)
    top = wl.top_n_liquid(b, 20)
    s = views.shares(spark, d).withColumn("code", F.lpad("code", 6, "0"))
    bars = b.select("code", "date", "close").join(F.broadcast(top), "code")  # at most 20 codes
    return asof.market_cap_asof(bars, s.join(F.broadcast(top.select("code")), "code", "left_semi"))


@query("SELECT code FROM v_bars UNION SELECT code FROM v_long")
def srt_2_all_codes(spark, d):
    return wl.all_codes(views.bars(spark, d), views.long_bars(spark, d))


@query("SELECT code, date, close FROM v_bars ORDER BY code, date LIMIT 25")
def srt_3_head_n(spark, d):
    return wl.head_n(views.bars(spark, d).select("code", "date", "close"), 25, "code", "date")


@query("SELECT * FROM v_long WHERE code = '000003'")
def srt_4_series(spark, d):
    return wl.series(views.long_bars(spark, d), "000003")


@query("SELECT code, period, (row_number() OVER (PARTITION BY period ORDER BY code) - 1) // 100 AS batch FROM (SELECT DISTINCT code, period FROM v_facts)")
def srt_5_batch_worklist(spark, d):
    return wl.batch_worklist(views.facts(spark, d).select("code", "period").distinct())


_LEGS = " UNION ALL ".join(f"SELECT '{n}' AS leg, count(*) AS missing FROM (SELECT DISTINCT code FROM v_bars) WHERE code NOT IN (SELECT code FROM v_bars WHERE date BETWEEN DATE '2024-01-15' - {k} AND DATE '2024-01-15' AND {w})" for n, k, w in (("bars", 0, "true"), ("flow", 0, "open % 2 = 0"), ("shares", 7, "close % 9 = 0")))


def coverage(spark, d):
    b = views.bars(spark, d)
    m = b.select("code").distinct()
    t = day("2024-01-15")
    return wl.legs({"bars": wl.coverage_missing(m, b, t), "flow": wl.coverage_missing(m, b.where("open % 2 = 0"), t), "shares": wl.coverage_missing(m, b.where("close % 9 = 0"), t, 7)})


@query(_LEGS)
def set_1_union_coverage(spark, d):
    return coverage(spark, d)


@query("SELECT DISTINCT code FROM v_bars EXCEPT SELECT code FROM v_long")
def set_2_difference(spark, d):
    return wl.difference(views.bars(spark, d).select("code").distinct(), views.long_bars(spark, d), "code")


@query("SELECT code, date, close, open FROM v_bars UNION ALL SELECT code, date, close, NULL FROM v_long")
def set_3_concat(spark, d):
    return wl.concat(views.bars(spark, d).select("code", "date", "close", "open"), views.long_bars(spark, d).select("code", "date", "close"))


@query("SELECT DISTINCT date FROM v_long WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def set_4_trading_calendar(spark, d):
    return wl.trading_calendar(views.long_bars(spark, d), day("1996-01-01"), day("1996-12-31"))


@query("SELECT \"table\", CASE WHEN rows IS NULL THEN 'missing' ELSE 'empty' END AS reason FROM (SELECT * FROM (" + _NOW + ") RIGHT JOIN (SELECT unnest(['click', 'view', 'error', 'gone', 'never']) AS \"table\") USING (\"table\")) WHERE coalesce(rows, 0) = 0")
def qlt_1_gate_presence(spark, d):
    wanted = spark.createDataFrame([(x,) for x in ("click", "view", "error", "gone", "never")], "table string")
    return quality.gate_presence(counts(spark, d)[0], wanted)


@query(f"SELECT n.\"table\", n.rows, w.rows AS was_rows FROM ({_NOW}) n JOIN ({_WAS}) w USING (\"table\") WHERE n.rows < w.rows * 0.95")
def qlt_2_gate_row_regression(spark, d):
    return quality.gate_row_regression(quality.compare_to_baseline(*counts(spark, d)))


@query(f"SELECT n.\"table\", n.newest, w.newest AS was_newest FROM ({_NOW}) n JOIN ({_WAS}) w USING (\"table\") WHERE w.newest IS NOT NULL AND (n.newest IS NULL OR n.newest < w.newest)")
def qlt_3_gate_date_regression(spark, d):
    return quality.gate_date_regression(quality.compare_to_baseline(*counts(spark, d)))


@query(f"SELECT done, failed, rate FROM (SELECT count(*) FILTER (o = 'done') AS done, count(*) FILTER (o = 'failed') AS failed, count(*) FILTER (o = 'failed')::DOUBLE / count(*) FILTER (o IN ('done', 'failed')) AS rate FROM ({_OUT})) WHERE rate > 0.05")
def qlt_4_failure_rate_gate(spark, d):
    return quality.failure_rate_gate(outcomes(spark, d), 0.05)


@query("SELECT code, date, open, open + 50 AS high, low, close FROM v_bars WHERE open + 50 < greatest(open, close) OR low > least(open, close)")
def qlt_5_bar_consistency(spark, d):
    return quality.bar_consistency(views.bars(spark, d).select("code", "date", "open", (F.col("open") + 50).alias("high"), "low", "close"))


@query(f"SELECT leg, codes, missing, missing::DOUBLE / codes AS share FROM ({_LEGS.replace('v_bars WHERE', 'v_ev WHERE').replace('open % 2 = 0', 'px % 2 = 0').replace('close % 9 = 0', 'px % 9 = 0')}) CROSS JOIN (SELECT count(DISTINCT code) AS codes FROM v_bars)")
def qlt_6_coverage_report(spark, d):
    """Coverage by events: legs of all, of even and of some prices."""
    e = raw(spark, d).select("code", "date", "px")
    return wl.coverage_report(e.select("code"), {"bars": (e, 0), "flow": (e.where("px % 2 = 0"), 0), "shares": (e.where("px % 9 = 0"), 7)}, day("2024-01-15"))


@query(_REPORT)
def qlt_7_feed_status_report(spark, d):
    return report(spark, d)


_PIT = "SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS known, o_orderdate::DATE AS about FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


@query(f"""SELECT 'kept' AS what, l_orderkey AS a, l_linenumber::BIGINT AS b FROM ({_PIT}) WHERE NOT known < about UNION ALL
    SELECT 'counted', count(*), count(*) FILTER (known < about) FROM ({_PIT}) UNION ALL SELECT 'aborted', NULL, count(*) FROM ({_PIT}) HAVING count(*) FILTER (known < about) > 0""")
def qlt_8_pit_violations(spark, d):
    """The rows without those known too early, how many these are, and that a limit of none aborts."""
    x = views.table(spark, d, "lineitem").join(views.table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    x = x.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("known"), F.to_date("o_orderdate").alias("about"))
    n = quality.pit_violations(x, "known", "about")
    kept = quality.drop_pit_violations(x, "known", "about", 1.0).select(F.lit("kept").alias("what"), F.col("l_orderkey").alias("a"), F.col("l_linenumber").cast("bigint").alias("b"))
    counted = n.select(F.lit("counted").alias("what"), F.col("rows").alias("a"), F.col("violations").alias("b"))
    try:
        quality.drop_pit_violations(x, "known", "about", 0.0)
        return wl.concat(kept, counted)
    except ValueError:
        return wl.concat(kept, counted, n.select(F.lit("aborted").alias("what"), F.lit(None).cast("bigint").alias("a"), F.col("rows").alias("b")))


@query("SELECT code, date, close AS close_split, open AS close, volume * 1000000 AS mcap, open % 2 = 0 AS is_delisted FROM v_bars")
def qlt_9_vendor_rules(spark, d):
    b = views.bars(spark, d).select("code", "date", "close", F.col("open").alias("closeadj"), F.col("volume").alias("mcap"), F.when(F.col("open") % 2 == 0, "Y").otherwise("N").alias("isdelisted"))
    return quality.vendor_rules(b)


@query("SELECT 'even' AS what, count(*) = 0 AS failed, count(*) AS rows FROM v_bars WHERE open % 2 = 0 UNION ALL SELECT 'upside down', count(*) = 0, count(*) FROM v_bars WHERE high < low UNION ALL SELECT 'all', count(*) = 0, count(*) FROM v_bars")
def qlt_10_empty_result_is_failure(spark, d):
    """Whether each of some results is a failure, being empty."""
    b = views.bars(spark, d)

    def outcome(what, rows):
        try:
            return quality.not_empty(rows, what).agg(F.lit(False).alias("failed"), F.count("*").alias("rows"))
        except ValueError:
            return rows.agg(F.lit(True).alias("failed"), F.count("*").alias("rows"))

    parts = {"even": b.where("open % 2 = 0"), "upside down": b.where("high < low"), "all": b}
    return wl.concat(*[outcome(k, v).select(F.lit(k).alias("what"), "failed", "rows") for k, v in parts.items()])
