"""The registry of queries and the views that their SQL shares."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: DuckDB versions of ``tideline.sources.views``.
VIEWS = {
    "v_ev": "SELECT *, lpad(user_id::VARCHAR, 6, '0') AS code, ts::DATE AS date, CAST(floor(value * 100) AS BIGINT) AS px FROM events",
    "v_bars": "SELECT code, date, arg_min(px, event_id) AS open, max(px) AS high, min(px) AS low, arg_max(px, event_id) AS close, count(*) AS volume, CAST(sum(px) AS BIGINT) AS trade_value FROM v_ev GROUP BY code, date",
    "v_long": "SELECT lpad(l_suppkey::VARCHAR, 6, '0') AS code, l_shipdate::DATE AS date, min(px) AS low, max(px) AS high, arg_max(px, (q, px)) AS close, CAST(sum(q) AS BIGINT) AS volume, CAST(sum(px) AS BIGINT) AS trade_value FROM (SELECT *, CAST(floor(l_extendedprice * 100) AS BIGINT) AS px, CAST(l_quantity AS BIGINT) AS q FROM lineitem) GROUP BY ALL",
    "v_facts": "SELECT o_custkey::VARCHAR AS code, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS period, o_orderdate::DATE AS knowledge_date, arg_max(o_totalprice, o_orderkey) AS value FROM orders GROUP BY ALL",
    "v_shares": "SELECT o_custkey::VARCHAR AS code, o_orderdate::DATE AS date, max(o_orderkey) + 1 AS shares FROM orders WHERE o_orderkey % 2 = 0 GROUP BY ALL",
    "v_share_bars": "SELECT o_custkey::VARCHAR AS code, o_orderdate::DATE AS date, max(CAST(floor(o_totalprice * 100) AS BIGINT)) AS close FROM orders WHERE o_orderkey % 2 = 1 GROUP BY ALL",
    "v_master": "SELECT lpad(s_suppkey::VARCHAR, 6, '0') AS code, s_name AS name, n_name AS market FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "v_checks": "SELECT event_type AS feed, event_id AS checked, ts::DATE::VARCHAR AS modified FROM events",
    "v_src": "SELECT *, CASE WHEN day(date) % 3 = 0 THEN 'backfill' ELSE 'primary' END AS source FROM v_bars",
    "v_raw": "SELECT code, event_id, px, CASE WHEN event_id % 13 = 0 THEN '' ELSE strftime(ts, '%Y%m%d') END AS dt, CASE WHEN event_id % 3 = 0 THEN '-' ELSE '+' END || px AS signed, CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE px::VARCHAR END AS maybe, date, (px // 100) || '.' || (px % 10) AS dec FROM v_ev",
}


def with_views(sql: str) -> str:
    """``sql`` with the views that it names, and those that these name, as CTEs before it."""
    need: list[str] = []

    def add(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in need:
                add(VIEWS[name])
                if name not in need:
                    need.append(name)

    add(sql)
    if not need:
        return sql
    ctes = ", ".join(f"{n} AS ({VIEWS[n]})" for n in need)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with SQL that gives the same rows."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = with_views(sql)
        return f

    return register
