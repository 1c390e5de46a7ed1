import datetime as dt

import pytest
from pyspark.sql import functions as F

from tideline.functions import scalars as fn

D = dt.date


def apply(spark, f, *values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    return [r.x for r in spark.createDataFrame(rows, f"i int, v {kind}").orderBy("i").select(f(F.col("v")).alias("x")).collect()]


@pytest.mark.parametrize(
    "f,values,want",
    [
        (fn.lenient_int, ("+322500", "-1979879", "", None, "abc", "12.5", " 7 ", "1+2", "9" * 30), [322500, -1979879, 0, 0, 0, 0, 7, 12, 0]),
        (fn.lenient_float, ("+7.86", "", None, "1d", "1e3", "NaN"), [7.86, 0.0, 0.0, 0.0, 1000.0, 0.0]),
        (fn.nullable_float, ("2,206,125", "", "-", None, "1d", "-.5", "0"), [2206125.0, None, None, None, None, -0.5, 0.0]),
        (fn.nullable_int, ("5,919,637,922", "-", "", "1.5", None, "0"), [5919637922, None, None, None, None, 0]),
        (fn.nullable_int_trunc, ('"5,969,782,550"', "-", "N/A", "", "12.9", "-12.9", None, "1e300"), [5969782550, None, None, None, 12, -12, None, None]),
        (fn.signed_int, ("+1,234", "-1,234", "", "x", None, "5802466"), [1234, -1234, None, None, None, 5802466]),
        (fn.parse_date, ("20260812", "2026-08-12", "2026.08.12", "2026/08/12", "2026-08.12", "20261301", "", None), [D(2026, 8, 12)] * 3 + [None] * 5),
        (fn.avail_date, ("2020Q1", "2020Q4", "2019Q3"), [D(2020, 5, 15), D(2021, 3, 31), D(2019, 11, 14)]),
        (fn.mask_dsn, ("postgresql://u:pw@h:5432/d", "no secret"), ["postgresql://u:***@h:5432/d", "no secret"]),
        (fn.mask_dsn, ("http://h:80/a@b", "jdbc+x://u:p:q@h", "://u:p@h", "a://u:@h", "x://u:p@y://v:q@h"), ["http://h:80/a@b", "jdbc+x://u:***@h", "://u:p@h", "a://u:@h", "x://u:***@y://v:***@h"]),
        (fn.mask_secrets, ("x?api_key=k81kk&page=2&of=9", "APIKEY=q TOKEN=z", None, "a://u:p@h"), ["x?api_key=***&page=2&of=9", "APIKEY=*** TOKEN=***", "", "a://u:***@h"]),
        (fn.mask_secrets, ("(token=ab\"& rest", "{'token=ab', 1}", 'token="ab"', "mytoken=ab"), ["(token=***\"& rest", "{'token=***', 1}", 'token="ab"', "mytoken=ab"]),
    ],
)
def test_text(spark, f, values, want):
    assert apply(spark, f, *values) == want


def test_numbers(spark):
    rows = spark.createDataFrame([(200.0, 100.0), (50.0, 100.0), (10.0, -20.0), (10.0, 0.0), (None, 100.0)], "a double, b double")
    assert [r.g for r in rows.select(fn.yoy_growth(F.col("a"), F.col("b")).alias("g")).collect()] == [1.0, -0.5, 1.5, None, None]
    rows = spark.createDataFrame([(50000, 2000000), (1, 500000), (1, 1500000)], "c int, v bigint")
    assert [r.x for r in rows.select(fn.approx_trade_value(F.col("c"), F.col("v")).alias("x")).collect()] == [100000, 0, 2]


def test_periods(spark):
    one = spark.range(1)
    assert one.select(fn.recent_quarters(F.to_date(F.lit("2026-07-11")), 5)).first()[0] == ["2026Q3", "2026Q2", "2026Q1", "2025Q4", "2025Q3"]
    assert one.select(fn.period_range(2019, 2020)).first()[0] == [f"{y}Q{q}" for y in (2019, 2020) for q in (1, 2, 3, 4)]


def test_options_and_staleness(spark):
    row = spark.range(1).select(fn.mask_options(F.array(*map(F.lit, ["x", "--db", "s", "--n", "--dsn", "t"]))).alias("a")).first()
    assert row.a == ["x", "--db", "***", "--n", "--dsn", "***"]
    limits = {"holdings": 8, "descriptions": 30}
    cases = [("stocks", 1, False), ("stocks", 2, True), ("holdings", 7, False), ("holdings", 8, True), ("descriptions", 29, False), ("other", 2, True), ("stocks", None, False)]
    frame = spark.createDataFrame(cases, "feed string, streak int, want boolean")
    assert frame.where(fn.is_stale(F.col("feed"), F.col("streak"), limits) != F.col("want")).count() == 0


def test_options_of_long_lists(spark):
    words = ["--db" if i % 7 == 0 else "--dsn" if i % 11 == 0 else f"w{i}" for i in range(100_000)]
    lists = spark.createDataFrame([(" ".join(words),)], "t string").select(fn.mask_options(F.split("t", " ")).alias("a"))
    assert lists._jdf.queryExecution().executedPlan().toString().count("split(") == 1  # not once more for each word
    assert lists.first().a == words[:1] + ["***" if before in ("--db", "--dsn") else x for before, x in zip(words, words[1:])]
    odd = [["--db"], [], None, ["--db", "--db", "x"], ["--dsn", None, "y"], [None, "--db", None, "z"], ["--db=x", "v"]]
    assert apply(spark, fn.mask_options, *odd, kind="array<string>") == [["--db"], [], None, ["--db", "***", "***"], ["--dsn", "***", "y"], [None, "--db", "***", "z"], ["--db=x", "v"]]
