import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import normalize as nz

D = dt.date


def test_bars_flow_short_credit(spark):
    raw = spark.createDataFrame([("q", "20310305", "+64", "-71", "+60", "-66", "-15", "+8"), ("q", "", "1", "1", "1", "1", "1", "1"), ("q", None, "1", "1", "1", "1", "1", "1")], "code string, dt string, open string, high string, low string, close string, volume string, trade_value string")
    assert [tuple(r) for r in nz.normalize_bars(raw).collect()] == [("q", D(2031, 3, 5), 64, 71, 60, 66, -15, 8)]
    short = raw.select("code", "dt", "close", "volume", *[F.col("high").alias(c) for c in ("short_qty", "short_balance", "short_ratio", "short_avg_price", "short_value")])
    row = nz.normalize_short(short).first()
    assert (row.close, row.short_qty, row.short_ratio, row.short_avg_price) == (66, -71, -71.0, -71)


def test_delisted_bars(spark):
    halted, above, worthless, large, below = (0.0, 0.0, 0.0, 77.0, 0.0), (8.0, 8.0, 8.0, 9.0, 3.0), (4.0, 4.0, 4.0, 0.0, 3.0), (1250.0, 1300.0, 1200.0, 1250.0, 4e6), (46.0, 47.0, 45.5, 45.0, 2.0)
    rows = [halted, above, worthless, large, below]
    df = spark.createDataFrame([("a", D(2020, 1, i + 1), *r) for i, r in enumerate(rows)], "code string, date date, open double, high double, low double, close double, volume double")
    got = [(r.open, r.high, r.low, r.close, r.trade_value) for r in nz.normalize_delisted_bars(df).orderBy("date").collect()]
    assert got == [(77, 77, 77, 77, 0), (8, 9, 8, 9, 0), (1250, 1300, 1200, 1250, 5000), (46, 47, 45, 45, 0)]


def test_partial_flow_keeps_unknown_null(spark):
    df = spark.createDataFrame([("a", D(2020, 1, 1), 5, 6, 7, 8), ("a", D(2020, 1, 2), 0, 6, 7, 8), ("a", D(2020, 1, 3), None, 6, 7, 8)], "code string, date date, close bigint, volume bigint, institution bigint, foreign_ bigint")
    (row,) = nz.normalize_partial_flow(df).collect()
    assert (row.individual, row.institution, row.foreign_, row.acc_trde_qty, row.source) == (None, 7, 8, 6, "backfill")


def test_consensus_and_estimate(spark):
    a = '{"consensusInfo": {"createDate": "2031-11-30", "recommMean": "3.25", "priceTargetMean": "81,400"}}'
    df = spark.createDataFrame([("a", a), ("b", "{}"), ("c", '{"consensusInfo": {"createDate": ""}}'), ("d", None)], "code string, payload string")
    got = {r.code: (r.target_mean, r.recomm_mean, r.base_date) for r in nz.extract_consensus(df).collect()}
    assert got == {"a": (81400.0, 3.25, "2031-11-30"), "b": (None,) * 3, "c": (None,) * 3, "d": (None,) * 3}
    years = [{"key": "203003", "isConsensus": "N"}, {"key": "203103", "isConsensus": "N"}, {"key": "203203", "isConsensus": "#"}, {"key": "203303", "isConsensus": "#"}]
    figures = {"203103": {"value": "1,020"}, "203203": {"value": "1,377"}, "203303": {"value": "9"}}
    text = json.dumps({"financeInfo": {"trTitleList": years, "rowList": [{"title": "BPS", "columns": {}}, {"title": "@", "columns": figures}]}})
    title = text.replace('"#"', '"%s"').replace('"@"', "%s").replace('"%s"', '"%(known)s"').replace("%s", "%(row)s")
    df = spark.createDataFrame([(k, title % {"known": y, "row": r}) for k, y, r in (("a", "Y", '"EPS"'), ("b", "N", '"EPS"'), ("c", "Y", '{"name": "EPS"}'), ("d", "Y", '"PER"'))] + [("e", "{}")], "code string, payload string")
    got = {r.code: (r.fwd_eps, r.prev_eps, r.est_year) for r in nz.extract_estimate(df).collect()}
    full, none = (1377.0, 1020.0, "203203"), (None, None, None)
    assert got == {"a": full, "b": none, "c": full, "d": none, "e": none}


def test_shares_payload(spark):
    lines = [(1, "000", 0, "우선주", "41", "2031-06-30", "x"), (1, "000", 1, "보통주", "3,000,000,017", "2031-06-30", "20310815000042"), (2, "000", 0, "보통주", "-", "2031-06-30", "20310816"), (3, "013", 0, "보통주", "58", "2031-06-30", "2031")]
    df = spark.createDataFrame(lines, "id int, status string, pos int, se string, istc_totqy string, stlm_dt string, rcept_no string")
    assert sorted(map(tuple, nz.extract_issued_shares(df).collect())) == [(1, 3000000017, D(2031, 6, 30)), (2, None, None), (3, None, None)]
    assert sorted(map(tuple, nz.extract_receipt_date(df).collect())) == [(1, D(2031, 8, 15)), (2, D(2031, 8, 16)), (3, None)]


def by_positions(rows, labels):
    """The figure and its prior value, by the positions of amounts."""
    fits = [i for i, (label, *_) in enumerate(rows) if label.strip() in labels]
    now = min((i for i in fits if rows[i][1] is not None), default=None)
    prior = max((i for i in fits if rows[i][2] is not None and (now is None or i <= now)), default=None)
    return (None if now is None else rows[now][1]), (None if prior is None else rows[prior][2])


def test_first_match_pick_equals_a_scan(spark):
    rng = random.Random(0)
    cases = {i: [(rng.choice([" 매출액 ", "영업수익", "기타"]), rng.choice([None, 1.0, 2.0, 3.0]), rng.choice([None, 4.0, 5.0])) for _ in range(rng.randint(1, 6))] for i in range(150)}
    lines = [(i, "000", p, a, None if b is None else str(b), None if c is None else str(c)) for i, rows in cases.items() for p, (a, b, c) in enumerate(rows)]
    df = spark.createDataFrame(lines, "id int, status string, pos int, account_nm string, thstrm_amount string, frmtrm_amount string")
    got = {r.id: (r.revenue, r.revenue_prior) for r in nz.financials_six(df, ["id"]).collect()}
    assert got == {i: by_positions(rows, nz.REVENUE) for i, rows in cases.items()}


def test_statement_values(spark):
    lines = [(1, "000", 0, "당기순이익", "31,415", "27,182"), (2, "000", 0, "당기순이익(손실)", "-88", ""), (3, "013", 0, "당기순이익", "1", "2")]
    df = spark.createDataFrame(lines, "id int, status string, pos int, account_nm string, thstrm_amount string, frmtrm_amount string")
    got = {r.id: (r.netinc, r.netinc_prior, r.revenue) for r in nz.financials_six(df, ["id"]).collect()}
    assert got == {1: (31415.0, 27182.0, None), 2: (-88.0, None, None), 3: (None, None, None)}


def test_earnings_rows_need_a_mode(spark):
    df = spark.createDataFrame([("a", 2018, 1, 5.0), ("b", 2018, 4, None)], "code string, year int, quarter int, netinc double")
    df = df.withColumns({c: F.lit(None).cast("double") for c in ("netinc_prior", "revenue", "revenue_prior", "op_income", "op_income_prior")})
    (row,) = nz.build_earnings_rows(df, "avail", F.current_date()).collect()
    assert (row.period, row.avail_date, row.knowledge_date) == ("2018Q1", D(2018, 5, 15), D(2018, 5, 15))
    assert nz.build_earnings_rows(df, "today", F.to_date(F.lit("2026-01-02"))).first().knowledge_date == D(2026, 1, 2)
    with pytest.raises(ValueError):
        nz.build_earnings_rows(df, "", F.current_date())


def test_cutoffs(spark):
    df = spark.createDataFrame([("a", D(2026, 1, d)) for d in (1, 9, 10)], "code string, date date")
    today = F.to_date(F.lit("2026-01-10"))
    assert [nz.cutoff_window(df, today, n, z).count() for n, z in ((0, True), (0, False), (1, True), (30, False))] == [3, 1, 2, 3]


def test_yearly_series(spark):
    rows = [("A", 2018, "11011", 100, D(2018, 12, 31), D(2019, 3, 1)), ("A", 2018, "11014", 99, D(2018, 9, 30), None), ("A", 2019, "11011", None, D(2019, 12, 31), None), ("A", 2019, "11014", 120, D(2019, 9, 30), None), ("A", 2020, "11012", 130, None, None)]
    df = spark.createDataFrame(rows, "code string, year int, report string, shares bigint, date date, receipt_date date")
    got = sorted(map(tuple, nz.first_success_per_year(df).collect()))
    assert got == [("A", D(2018, 12, 31), 100, D(2019, 3, 1)), ("A", D(2019, 9, 30), 120, D(2019, 9, 30))]
