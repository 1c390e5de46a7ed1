"""Normalisers: raw payload rows, whose values are text, to typed rows.

All are projections and filters, so they never shuffle, except those that pick one row of a payload.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions import scalars as fn
from tideline.sources.schemas import INVESTORS

#: Labels as they stand in raw payloads.
NET_INCOME = ("당기순이익", "당기순이익(손실)", "분기순이익", "분기순이익(손실)", "반기순이익", "반기순이익(손실)")
REVENUE = ("매출액", "수익(매출액)", "영업수익")
OPERATING = ("영업이익", "영업이익(손실)")
COMMON_SHARE = "보통주"
OK = "000"
MAIN_MARKETS = ("거래소", "코스닥")
DELISTED_MARKETS = ("유가증권", "코스닥")
REPORT_ORDER = ("11011", "11014", "11012", "11013")


def _price(c: str) -> Column:
    return F.abs(fn.lenient_int(F.col(c)))


def _dated(df: DataFrame, date: str = "dt") -> DataFrame:
    return df.where(F.trim(F.coalesce(F.col(date), F.lit(""))) != "")


def normalize_bars(df: DataFrame) -> DataFrame:
    """``(code, dt, open, high, low, close, volume, trade_value)`` as text to bars.  A sign before a
    price is a direction and is dropped; volume and value keep theirs.  Rows without a date go."""
    return _dated(df).select(
        "code",
        fn.parse_date(F.col("dt")).alias("date"),
        *[_price(c).alias(c) for c in ("open", "high", "low", "close")],
        *[fn.lenient_int(F.col(c)).alias(c) for c in ("volume", "trade_value")],
    )


def normalize_flow(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Net buying by investor group; ``mapping`` names the raw column of each group."""
    names = mapping or {x: x for x in INVESTORS}
    return _dated(df).select(
        "code",
        fn.parse_date(F.col("dt")).alias("date"),
        _price("close").alias("close"),
        fn.lenient_float(F.col("flu_rt")).alias("flu_rt"),
        fn.lenient_int(F.col("acc_trde_qty")).alias("acc_trde_qty"),
        *[fn.lenient_int(F.col(raw)).alias(name) for name, raw in names.items()],
    )


def _signed_except_close(df: DataFrame, ints: Sequence[str], floats: Sequence[str]) -> DataFrame:
    return _dated(df).select(
        "code",
        fn.parse_date(F.col("dt")).alias("date"),
        _price("close").alias("close"),
        *[fn.lenient_int(F.col(c)).alias(c) for c in ints],
        *[fn.lenient_float(F.col(c)).alias(c) for c in floats],
    )


def normalize_short(df: DataFrame) -> DataFrame:
    """Short selling; only the close loses its sign."""
    return _signed_except_close(df, ("volume", "short_qty", "short_balance", "short_avg_price", "short_value"), ("short_ratio",))


def normalize_credit(df: DataFrame) -> DataFrame:
    """Credit balances; only the close loses its sign."""
    return _signed_except_close(df, ("new_qty", "repay_qty", "balance_qty", "balance_amt"), ("balance_rt", "credit_rt"))


def normalize_index(df: DataFrame) -> DataFrame:
    """Index bars: like bars, with a name.  Rows without a date go here, too."""
    return _dated(df).select(
        "code",
        fn.parse_date(F.col("dt")).alias("date"),
        F.trim("name").alias("name"),
        *[_price(c).alias(c) for c in ("open", "high", "low", "close")],
        *[fn.lenient_int(F.col(c)).alias(c) for c in ("volume", "trade_value")],
    )


def normalize_listed_shares(df: DataFrame, day: Column) -> DataFrame:
    """Listed shares, which come in thousands, stamped with the run's date."""
    return df.select("code", day.alias("date"), (fn.lenient_int(F.col("listed")) * 1000).alias("shares_outstanding"))


def normalize_master(df: DataFrame) -> DataFrame:
    names = ("code", "name", "market", "sector", "kind")
    return df.select(*[F.trim(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in names])


def normalize_delisted_master(df: DataFrame) -> DataFrame:
    """Rows without a code go; a null name or market becomes ''."""
    rows = df.select(F.trim(F.coalesce("short_code", F.lit(""))).alias("code"), *[F.trim(F.coalesce(c, F.lit(""))).alias(n) for c, n in (("codeName", "name"), ("marketName", "market"))])
    return rows.where("code != ''")


def extract_consensus(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Target price, recommendation and base date of a consensus payload; what is absent is null."""
    get = lambda k: F.get_json_object(payload, f"$.consensusInfo.{k}")
    rest = [c for c in df.columns if c != payload]
    return df.select(*rest, fn.nullable_float(get("priceTargetMean")).alias("target_mean"), fn.nullable_float(get("recommMean")).alias("recomm_mean"), F.nullif(F.trim(get("createDate")), F.lit("")).alias("base_date"))


ESTIMATE = "struct<trTitleList:array<struct<key:string,isConsensus:string>>,rowList:array<struct<title:string,columns:map<string,struct<value:string>>>>>"


def extract_estimate(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Forward and previous EPS: the first title marked as consensus gives the year, the last
    unmarked one the actual.  A title is text or an object with a name.  Without a consensus year
    or a row titled EPS all three are null."""
    rest = [c for c in df.columns if c != payload]
    info = df.withColumn("__f", F.from_json(F.get_json_object(payload, "$.financeInfo"), ESTIMATE))
    marked = F.col("__f.trTitleList")
    year = F.get(F.filter(marked, lambda t: t["isConsensus"] == "Y"), F.lit(0))["key"]
    others = F.filter(marked, lambda t: ~F.coalesce(t["isConsensus"] == "Y", F.lit(False)))
    last = F.try_element_at(others, F.lit(-1))["key"]
    title = lambda r: F.coalesce(F.get_json_object(r["title"], "$.name"), r["title"])
    row = F.get(F.filter("__f.rowList", lambda r: F.coalesce(title(r) == "EPS", F.lit(False))), F.lit(0))["columns"]
    info = info.select(*rest, year.alias("__y"), last.alias("__l"), row.alias("__r")).withColumn("__ok", F.col("__y").isNotNull() & F.col("__r").isNotNull())
    value = lambda k: F.when(F.col("__ok"), fn.nullable_float(F.try_element_at("__r", F.col(k))["value"]))
    return info.select(*rest, value("__y").alias("fwd_eps"), value("__l").alias("prev_eps"), F.when(F.col("__ok"), F.col("__y")).alias("est_year"))


def normalize_delisted_bars(df: DataFrame, source: str = "backfill") -> DataFrame:
    """Bars of delisted codes from array text: a close of 0 or less goes; without volume they stay.
    On a halted day (no open, high and low) all prices are the close; else high and low are widened
    to hold it.  The traded value is approximated."""
    p = {c: F.col(c).cast("bigint") for c in ("open", "high", "low", "close", "volume")}
    halted = (p["open"] <= 0) & (p["high"] <= 0) & (p["low"] <= 0)
    pick = lambda c: F.when(halted, p["close"]).otherwise(c)
    return df.where(F.col("close").cast("bigint") > 0).select(
        "code",
        "date",
        pick(p["open"]).alias("open"),
        pick(F.greatest(p["high"], p["close"])).alias("high"),
        pick(F.least(p["low"], p["close"])).alias("low"),
        p["close"].alias("close"),
        p["volume"].alias("volume"),
        fn.approx_trade_value(p["close"], p["volume"]).alias("trade_value"),
        F.lit(source).alias("source"),
    )


def normalize_partial_flow(df: DataFrame, source: str = "backfill") -> DataFrame:
    """Flow rows that know two investor groups only; the others are null, never 0."""
    known = ("institution", "foreign_")
    return df.where("close > 0").select(
        "code",
        "date",
        "close",
        F.lit(None).cast("double").alias("flu_rt"),
        F.col("volume").alias("acc_trde_qty"),
        *[(F.col(x) if x in known else F.lit(None).cast("bigint")).alias(x) for x in INVESTORS],
        F.lit(source).alias("source"),
    )


def _first(value: Column, order: Column, where: Column) -> Column:
    return F.min_by(value, F.when(where, order))


def extract_issued_shares(df: DataFrame) -> DataFrame:
    """Per payload ``(id, status)``, from its lines ``(id, status, pos, se, istc_totqy, stlm_dt)``: the
    first common-share line with a count that is neither null nor 0: ``(id, shares, date)``."""
    count = fn.nullable_int(F.col("istc_totqy"))
    fits = (F.col("status") == OK) & (F.trim("se") == COMMON_SHARE) & (F.coalesce(count, F.lit(0)) != 0)
    return df.groupBy("id").agg(F.min_by(F.struct(count.alias("n"), fn.parse_date(F.col("stlm_dt")).alias("d")), F.when(fits, F.col("pos"))).alias("s"), F.max(fits).alias("any")).select(
        "id", F.when(F.col("any"), F.col("s.n")).alias("shares"), F.when(F.col("any"), F.col("s.d")).alias("date")
    )


def extract_receipt_date(df: DataFrame) -> DataFrame:
    """Per payload the date that begins the first receipt number with eight leading digits."""
    fits = F.col("rcept_no").rlike(r"^\d{8}")
    day = fn.parse_date(F.substring("rcept_no", 1, 8))
    return df.groupBy("id").agg(F.min_by(day, F.when(fits, F.col("pos"))).alias("d"), F.max(fits).alias("any")).select("id", F.when(F.col("any"), F.col("d")).alias("receipt_date"))


def financials_six(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key six columns of net income, revenue and operating income from statement lines
    ``(keys, status, pos, account_nm, thstrm_amount, frmtrm_amount)``.  A status other than OK gives
    nulls.

    A figure is the first amount there is among the lines with one of its labels; its prior value the
    last prior amount at or before that line, or of all such lines if none has a current amount.  The
    place of the first comes from a window, the rest from one aggregate on the same exchange."""
    good = F.col("status") == OK
    cur, prior = (F.when(good, fn.nullable_float(F.col(c))) for c in ("thstrm_amount", "frmtrm_amount"))
    measures = {"netinc": NET_INCOME, "revenue": REVENUE, "op_income": OPERATING}
    label = F.trim("account_nm")
    rows = lines.select(*keys, "pos", cur.alias("cur"), prior.alias("prior"), *[label.isin(*labels).alias(f"is_{name}") for name, labels in measures.items()])
    there = {name: F.when(F.col(f"is_{name}") & F.col("cur").isNotNull(), F.col("pos")) for name in measures}
    rows = rows.withColumns({f"at_{name}": F.min(pos).over(Window.partitionBy(*keys)) for name, pos in there.items()})
    out = []
    for name, pos in there.items():
        upto = F.col(f"at_{name}").isNull() | (F.col("pos") <= F.col(f"at_{name}"))
        before = F.when(F.col(f"is_{name}") & F.col("prior").isNotNull() & upto, F.col("pos"))
        out += [F.min_by("cur", pos).alias(name), F.max_by("prior", before).alias(f"{name}_prior")]
    return rows.groupBy(*keys).agg(*out)


def build_earnings_rows(df: DataFrame, mode: str, today: Column) -> DataFrame:
    """Rows ``(code, year, quarter, six figures)`` to versions.  ``mode`` is 'today' (known since this
    run) or 'avail' (known since the figures could be known); it must be chosen.  Rows without net
    income go."""
    if mode not in ("today", "avail"):
        raise ValueError("mode must be 'today' or 'avail'")
    rows = df.where("netinc is not null").withColumn("period", fn.period_of(F.col("year"), F.col("quarter")))
    rows = rows.withColumn("avail_date", fn.avail_date(F.col("period")))
    rows = rows.withColumn("knowledge_date", today if mode == "today" else F.col("avail_date"))
    figures = ("netinc", "netinc_prior", "revenue", "revenue_prior", "op_income", "op_income_prior")
    return rows.select("code", "period", "knowledge_date", "avail_date", *figures)


def build_consensus_rows(df: DataFrame, day: Column) -> DataFrame:
    """Stamped rows; those that know neither a target, a recommendation nor a forward EPS go."""
    return df.withColumn("date", day).na.drop(how="all", subset=["target_mean", "recomm_mean", "fwd_eps"])


def common_stock_only(df: DataFrame, all_kinds: bool = False, markets: Sequence[str] = MAIN_MARKETS) -> DataFrame:
    return df if all_kinds else df.where(F.col("market").isin(*markets) & F.col("code").endswith("0"))


def cutoff_window(df: DataFrame, today: Column, days: int, zero_means_all: bool = True) -> DataFrame:
    """Rows of the last ``days``.  For bars, flow and index 0 means all rows, for short selling and
    credit today's only."""
    return df if days == 0 and zero_means_all else df.where(F.col("date") >= F.date_sub(today, days))


def newer_than_stored(df: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows later than the latest stored one of their code; all rows of codes that aren't stored."""
    latest = stored.groupBy("code").agg(F.max("date").alias("__latest"))
    return df.join(latest, "code", "left").where("__latest is null or date > __latest").drop("__latest")


def lookahead_guard(df: DataFrame, today: Column) -> DataFrame:
    """Periods whose figures can't be known yet go."""
    return df.where(fn.avail_date(F.col("period")) <= today)


def universe_predicate(start: Column, markets: Sequence[str] = DELISTED_MARKETS) -> Column:
    """Six digits, a main market, and not known to have left before the history starts."""
    return F.col("code").rlike(r"^\d{6}$") & F.col("market").isin(*markets) & (F.col("last_trade_date").isNull() | (F.col("last_trade_date") >= start))


def since(df: DataFrame, start: Column) -> DataFrame:
    return df.where(F.col("date") >= start)


def status_ok(df: DataFrame, *columns: str) -> DataFrame:
    """Values of payloads whose status isn't OK become null; the rows stay."""
    return df.withColumns({c: F.when(F.col("status") == OK, F.col(c)) for c in columns})


def market_filter(df: DataFrame, market: str | None) -> DataFrame:
    """Rows of a market; None keeps all."""
    return df if market is None else df.where(F.col("market") == market)


def stamp_source(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("source", F.lit(source))


def first_success_per_year(reports: DataFrame, order: Sequence[str] = REPORT_ORDER) -> DataFrame:
    """Of the reports ``(code, year, report, shares, date, receipt_date)`` of a year the first in
    ``order`` that has shares and a date: ``(code, date, shares_outstanding, knowledge_date)``."""
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("report"))
    fits = reports.where("shares is not null and date is not null").withColumn("__rank", rank).where("__rank > 0")
    w = Window.partitionBy("code", "year").orderBy("__rank", "date", "shares")
    return fits.withColumn("__n", F.row_number().over(w)).where("__n = 1").select("code", "date", F.col("shares").alias("shares_outstanding"), F.coalesce("receipt_date", "date").alias("knowledge_date"))
