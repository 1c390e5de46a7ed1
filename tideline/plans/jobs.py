"""Jobs: what a user calls, composed of operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import scalars as fn
from tideline.operators import asof, clustered, feeds, merge, publish, quality
from tideline.operators import normalize as nz
from tideline.operators import worklists as wl
from tideline.operators.clustered import Layout
from tideline.sources.schemas import TABLES
from tideline.sources.tables import copy_window

FIGURES = ("avail_date", "netinc", "netinc_prior", "revenue", "revenue_prior", "op_income", "op_income_prior")


def typed(df: DataFrame, table: str) -> DataFrame:
    """``df``'s columns cast to those of a known table."""
    schema = TABLES[table].schema
    return df.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in schema.fieldNames() if c in df.columns])


def upsert(base: DataFrame, new: DataFrame, table: str) -> DataFrame:
    t = TABLES[table]
    return merge.merge_update(base, typed(new, table), t.keys, t.defaults)


def _year(table: str) -> tuple[str, Column]:
    """The column by whose year a table is kept in parts, and the part."""
    by = next(c for c in ("date", "period") if c in TABLES[table].keys)
    return by, F.substring(F.col(by).cast("string"), 1, 4)


def _whole(base: DataFrame, table: str) -> DataFrame:
    """``base`` with the columns of a known table, and those that it has besides."""
    schema = TABLES[table].schema
    missing = {f.name: F.lit(TABLES[table].defaults.get(f.name)).cast(f.dataType) for f in schema if f.name not in base.columns}
    return base.withColumns(missing).select(*schema.fieldNames(), *[c for c in base.columns if c not in schema.names])


def _into(new: DataFrame, root: str, table: str, keep: int, writer: tuple[str, int] | None, step, tally=None, layout: Layout | None = None) -> publish.Generation | None:
    by, part = _year(table)
    schema = TABLES[table].schema
    rows = new.withColumns({c: F.col(c).cast(schema[c].dataType) for c in new.columns if c in schema.names})

    def run(base: DataFrame, rows: DataFrame) -> DataFrame:
        last = publish.latest(rows.sparkSession, root)
        dealt = last.clustering() if last and "__at" in base.columns else None
        return step(_whole(base, table), rows, {**TABLES[table].defaults, **(last.defaults if last else {})}, dealt)

    return publish.update(rows, root, part, run, keep, by if by == "date" else None, writer, TABLES[table].defaults, tally, layout=layout, in_place=True)


def merge_into(new: DataFrame, root: str, table: str, keep: int = 2, writer: tuple[str, int] | None = None, layout: Layout | None = None) -> publish.Generation | None:
    """Merges rows into the table below ``root``, which is kept in parts by year (of the date, or of the
    period): only the years that ``new`` touches are read and written.  Columns beyond those of the known
    table are kept, and added to it if they are new.  No rows at all leave the table as it is.  A new table of
    code and date is kept clustered if a ``layout`` is given; merges then deal only the new rows."""

    def step(base, rows, defaults, dealt):
        keys = TABLES[table].keys
        if dealt:
            return clustered.merge_update(base, rows, dealt, keys, defaults, extend=True)
        return merge.merge_update(base, rows, keys, defaults, extend=True)

    return _into(new, root, table, keep, writer, step, layout=layout)


def insert_into(new: DataFrame, root: str, table: str, keep: int = 2, writer: tuple[str, int] | None = None, layout: Layout | None = None) -> publish.Generation | None:
    """As :func:`merge_into`, but rows that are there stay as they are.  The true insert count is measured
    while the years are written: ``tally["inserted"]`` of the result."""

    def step(base, rows, defaults, dealt):
        known, keys = rows.select([c for c in rows.columns if c in base.columns]), TABLES[table].keys
        if dealt:
            return clustered.merge_insert_only(base, known, dealt, keys, defaults, flag="__inserted")
        return merge.merge_insert_only(base, known, keys, defaults, flag="__inserted")

    return _into(new, root, table, keep, writer, step, {"inserted": F.count_if("__inserted")}, layout)


def copy_recent(spark: SparkSession, source: str, target: str, table: str, first: dt.date | None, last: dt.date | None = None) -> publish.Generation | None:
    """Copies the rows of some days from one table in parts to another: of the source only the years that
    hold such days are opened, of the target only those years are read and written."""
    by, _ = _year(table)
    rows = publish.current(spark, source, {by: (first, last)})
    return None if rows is None else merge_into(rows, target, table)


def copy_tables(source: Mapping[str, DataFrame], target: Mapping[str, DataFrame], days: int | None, today: Column, whole: Sequence[str] = ("stocks", "delisted_stocks")) -> dict[str, DataFrame]:
    """The next state of each target table: rows of the last ``days`` of its source (of all of it if
    None, and for masters) merged into it by the table's keys."""
    out = {}
    for name, rows in source.items():
        recent_rows = rows if name in whole else copy_window(rows, days, today)
        out[name] = upsert(target[name], recent_rows, name)
    return out


def behind(bars: DataFrame, reference: str, base_date: Column) -> DataFrame:
    """Codes whose last bar is before the market's newest date."""
    newest = quality.market_latest(bars, reference, base_date).scalar()
    return quality.latest_date_per_code(bars).where(F.col("latest") < newest)


def catch_up(bars: DataFrame, raw: DataFrame, reference: str, base_date: Column) -> DataFrame:
    """Bars of the codes that are behind, newer than what is stored, merged."""
    rows = nz.normalize_bars(raw).join(behind(bars, reference, base_date).select("code"), "code", "left_semi")
    return upsert(bars, nz.newer_than_stored(rows, bars), "daily_bars")


@dataclass
class Ingested:
    bars: DataFrame
    flow: DataFrame
    index: DataFrame


def daily_ingest(bars: DataFrame, flow: DataFrame, index: DataFrame, raw_bars: DataFrame, raw_flow: DataFrame, raw_index: DataFrame, outcomes: DataFrame, failure_limit: float = 0.2) -> Ingested:
    """Bars, flow and index rows of a day, merged; fails if too many codes failed."""
    if found := quality.failure_rate_gate(outcomes, failure_limit).collect():
        raise RuntimeError(f"too many codes failed: {found[0].asDict()}")
    return Ingested(
        upsert(bars, nz.normalize_bars(raw_bars), "daily_bars"),
        upsert(flow, nz.normalize_flow(raw_flow), "supply_demand"),
        upsert(index, nz.normalize_index(raw_index), "sector_index"),
    )


def daily_ingest_into(root: str, raw_bars: DataFrame, raw_flow: DataFrame, raw_index: DataFrame, outcomes: DataFrame, failure_limit: float = 0.2) -> dict[str, publish.Generation | None]:
    """:func:`daily_ingest` into tables by year below ``root``: of each table only the years of the new rows are
    read and written.  A table that is there after a failure of the next one takes the same rows again
    unharmed."""
    if found := quality.failure_rate_gate(outcomes, failure_limit).collect():
        raise RuntimeError(f"too many codes failed: {found[0].asDict()}")
    legs = {"daily_bars": nz.normalize_bars(raw_bars), "supply_demand": nz.normalize_flow(raw_flow), "sector_index": nz.normalize_index(raw_index)}
    return {name: merge_into(rows, f"{root}/{name}", name) for name, rows in legs.items()}


def short_credit_ingest(short: DataFrame, credit: DataFrame, raw_short: DataFrame, raw_credit: DataFrame) -> tuple[DataFrame, DataFrame]:
    return upsert(short, nz.normalize_short(raw_short), "short_selling"), upsert(credit, nz.normalize_credit(raw_credit), "credit_balance")


def recent(spark: SparkSession, quarters: int, today: Column) -> DataFrame:
    """The periods of an increment: that of today and those before it."""
    return spark.range(1).select(F.explode(fn.recent_quarters(today, quarters)).alias("period"))


def earnings_worklist(codes: DataFrame, periods: DataFrame, earnings: DataFrame, today: Column, size: int = 100) -> DataFrame:
    """``(code, period, batch)`` of what is pending and can be known by now, for requests of at most
    ``size`` codes of one period."""
    return wl.batch_worklist(nz.lookahead_guard(wl.pending_periods(codes.select("code"), periods, earnings), today), size).select("code", "period", "batch")


def earnings_increment(earnings: DataFrame, codes: DataFrame, quarters: int, lines: DataFrame, today: Column, mode: str, pending_only: bool = False) -> DataFrame:
    """The last quarters of the codes from statement lines as in :func:`earnings_backfill`."""
    return _earnings(earnings, codes, recent(codes.sparkSession, quarters, today), lines, today, mode, pending_only)


def earnings_backfill(earnings: DataFrame, codes: DataFrame, first_year: int, last_year: int, lines: DataFrame, today: Column, mode: str, pending_only: bool = False) -> DataFrame:
    """All quarters of the years that can be known by now, from statement
    lines ``(code, period, status, pos, account_nm, thstrm_amount, frmtrm_amount)``, appended as
    versions: a restated figure becomes a version of its own, one that hasn't changed does not.
    With ``pending_only``, periods that are stored are left out, restatements with them; it saves
    requests where statements are still to be fetched."""
    periods = codes.sparkSession.range(1).select(F.explode(fn.period_range(first_year, last_year)).alias("period"))
    return _earnings(earnings, codes, periods, lines, today, mode, pending_only)


def _earnings(earnings: DataFrame, codes: DataFrame, periods: DataFrame, lines: DataFrame, today: Column, mode: str, pending_only: bool) -> DataFrame:
    stored = earnings if pending_only else earnings.where("false")
    due = nz.lookahead_guard(wl.pending_periods(codes.select("code"), periods, stored), today)
    six = nz.financials_six(lines, ["code", "period"])
    rows = due.join(six, ["code", "period"], "left")
    rows = rows.withColumns({"year": F.substring("period", 1, 4).cast("int"), "quarter": F.substring("period", 6, 1).cast("int")})
    new = nz.build_earnings_rows(rows, mode, today)
    return merge.append_changed_versions(earnings, new.select(earnings.columns), ["code", "period"], "knowledge_date", FIGURES)


def consensus_snapshot(consensus: DataFrame, universe: DataFrame, payloads: DataFrame, day: Column) -> DataFrame:
    """``payloads(code, consensus, estimate)`` of codes that have no snapshot of the day yet, merged."""
    due = payloads.join(wl.pending_today(universe, consensus, day).select("code"), "code", "left_semi")
    a = nz.extract_consensus(due.select("code", F.col("consensus").alias("payload")))
    b = nz.extract_estimate(due.select("code", F.col("estimate").alias("payload")))
    return upsert(consensus, nz.build_consensus_rows(a.join(b, "code"), day), "consensus")


@dataclass
class Chain:
    master: DataFrame
    bars: DataFrame
    shares: DataFrame
    flow: DataFrame


def survivorship_chain(master: DataFrame, bars: DataFrame, shares: DataFrame, flow: DataFrame, fetched: DataFrame, reports: DataFrame, flow_pages: DataFrame, start: Column, day: Column, markets: Sequence[str], source: str = "backfill") -> Chain:
    """Delisted codes, in order: master with last trade dates, their bars (inserted only, codes marked
    as checked), share points, flow.  ``fetched(code, date, open, high, low, close, volume)`` are array
    rows, ``reports`` as in first_success_per_year, ``flow_pages(code, page, pos, date, close, ...)``."""
    dated = master.drop("last_trade_date").select("code", "name", "market", "checked")
    dated = wl.attach_last_trade_date(dated, bars)
    todo = wl.delisted_bars_worklist(dated, bars, source, start, markets).select("code")
    rows = fetched.join(todo, "code", "left_semi")
    key = list(TABLES["daily_bars"].keys)
    new_bars = merge.merge_insert_only(bars, typed(nz.normalize_delisted_bars(rows, source), "daily_bars"), key)
    checked = merge.mark_checked(dated, rows.select("code"), day)
    todo = wl.shares_worklist(new_bars, shares, source).select("code")
    points = nz.stamp_source(nz.first_success_per_year(reports.join(todo, "code", "left_semi")), source)
    new_shares = merge.merge_insert_only(shares, typed(points, "shares_outstanding_history"), key)
    todo = wl.flow_worklist(new_bars, flow, source)
    pages = wl.dedupe_first(nz.since(flow_pages.join(todo, "code", "left_semi"), start), ["code", "date"], "page", "pos")
    new_flow = merge.merge_insert_only(flow, typed(nz.normalize_partial_flow(pages, source), "supply_demand"), key)
    return Chain(checked, new_bars, new_shares, new_flow)


def adjust_rebuild(bars: DataFrame, factors: DataFrame, root: str, keep: int = 2) -> str:
    """The adjusted table, computed anew and published."""
    return publish.publish(typed(asof.back_adjust(bars, factors), "daily_bars_adjusted"), root, keep, "date")


def adjust_clustered(spark: SparkSession, source: str, factors: DataFrame, root: str, keep: int = 2) -> publish.Generation:
    """The adjusted table of one that is kept clustered below ``source``, published below ``root`` in the same
    layout: bars are read, adjusted and written without being dealt anew."""
    bars, layout = publish.clustered(spark, source)
    adjusted = asof.back_adjust(bars, factors, [c for c in ("open", "high", "low", "close") if c in bars.columns], layout=layout)
    schema = TABLES["daily_bars_adjusted"].schema
    rows = adjusted.select("__at", *[F.col(c).cast(schema[c].dataType).alias(c) for c in schema.fieldNames() if c in adjusted.columns])
    return publish.publish(rows, root, keep, "date", layout=layout)


def gates(tolerance: float = 0.05):
    """The gates of a rebuild, for :func:`tideline.operators.publish.publish`."""
    presence = lambda now, was: quality.gate_presence(now, now.select("table"))
    rows = lambda now, was: quality.gate_row_regression(quality.compare_to_baseline(now, was), tolerance)
    dates = lambda now, was: quality.gate_date_regression(quality.compare_to_baseline(now, was))
    return presence, rows, dates


@dataclass
class FeedPlan:
    plan: DataFrame
    refresh: DataFrame
    report: DataFrame


def bulk_sync(subscription: DataFrame, listing: DataFrame, inventory: DataFrame, manifest: DataFrame, checks: DataFrame, limits: Mapping[str, int]) -> FeedPlan:
    """``listing(feed, file, modified, size)``: what is subscribed and there, what must be fetched and
    why, and a verdict for each feed."""
    refresh = feeds.needs_refresh(listing, inventory, manifest).where("reason is not null")
    fetched = listing.join(refresh.select("file"), "file", "left_semi").select("feed")
    report = feeds.feed_status_report(subscription, listing, fetched, feeds.latest_streaks(checks), limits)
    return FeedPlan(wl.plan_vs_listing(subscription, listing), refresh, report)


def bulk_rebuild(drop: DataFrame, root: str, date_col: str, keep: int = 2) -> str:
    """A drop rebuilt, gated and published; staleness doesn't block, damage does."""
    return publish.publish(quality.vendor_rules(drop), root, keep, date_col, gates())


def shares_by_calendar(shares: DataFrame, snapshots: DataFrame, calendar: DataFrame, source: str) -> DataFrame:
    """Snapshot rows ``(code, date, shares_outstanding)`` of trading days, stamped and merged; no rows
    at all is a failure."""
    rows = snapshots.join(calendar, "date", "left_semi")
    return upsert(shares, nz.stamp_source(quality.not_empty(rows, "share snapshots"), source), "shares_outstanding_history")
