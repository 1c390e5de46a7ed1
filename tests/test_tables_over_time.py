import datetime as dt
import random
import warnings

import pytest
from pyspark.sql import functions as F

from tideline.operators import asof, feeds, merge, publish, quality, worklists
from tideline.plans import jobs
from tideline.streaming import streams

D = dt.date
BARS = "code string, date date, close int, source string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_update_insert_only_and_laws(spark):
    base = spark.createDataFrame([("000020", D(2020, 1, 2), 5, "first")], BARS)
    new = spark.createDataFrame([("000020", D(2020, 1, 2), 9), ("000020", D(2020, 1, 3), 7)], "code string, date date, close int")
    key, fill = ["code", "date"], {"source": "d"}
    once = merge.merge_update(base, new, key, fill)
    assert rows(once) == [("000020", D(2020, 1, 2), 9, "first"), ("000020", D(2020, 1, 3), 7, "d")]
    assert rows(merge.merge_update(once, new, key, fill)) == rows(once)
    kept = merge.merge_insert_only(base, new, key, fill)
    assert rows(kept) == [("000020", D(2020, 1, 2), 5, "first"), ("000020", D(2020, 1, 3), 7, "d")]
    assert [merge.fresh_rows(t, new, key).count() for t in (base.where("false"), base, kept)] == [2, 1, 0]
    with pytest.raises(Exception, match="key twice"):
        merge.merge_update(base, new.union(new), key).collect()


def test_random_merges_equal_dicts(spark):
    rng = random.Random(1)
    base = {(rng.randint(0, 30), rng.randint(0, 3)): (rng.randint(0, 9), "b") for _ in range(60)}
    new = {(rng.randint(0, 40), rng.randint(0, 3)): rng.choice([None, 1, 2]) for _ in range(60)}
    b = spark.createDataFrame([(*k, *v) for k, v in base.items()], "k int, j int, v int, s string")
    n = spark.createDataFrame([(*k, v) for k, v in new.items()], "k int, j int, v int")
    want = {k: (new[k] if k in new else base[k][0], base[k][1] if k in base else "d") for k in base | new}
    assert {(r.k, r.j): (r.v, r.s) for r in merge.merge_update(b, n, ["k", "j"], {"s": "d"}).collect()} == want


def test_versions(spark):
    kind = "code string, period string, knowledge_date date, v double"
    base = spark.createDataFrame([("a", "2020Q1", D(2020, 5, 1), 6.6e12), ("b", "2020Q1", D(2020, 5, 1), None)], kind)
    new = spark.createDataFrame([("a", "2020Q1", D(2020, 6, 1), 6.4e12), ("b", "2020Q1", D(2020, 6, 1), None), ("c", "2020Q1", D(2020, 6, 1), 1.0)], kind)
    args = (["code", "period"], "knowledge_date", ["v"])
    out = merge.append_changed_versions(base, new, *args)
    assert out.count() == 4 and merge.append_changed_versions(out, new, *args).count() == 4
    same_day = spark.createDataFrame([("a", "2020Q1", D(2020, 5, 1), 7.0)], kind)
    assert rows(merge.append_changed_versions(base, same_day, *args)) == [("a", "2020Q1", D(2020, 5, 1), 7.0), ("b", "2020Q1", D(2020, 5, 1), None)]
    see = lambda d: {r.code: r.v for r in asof.asof_earnings(out, F.to_date(F.lit(d))).collect()}
    assert see("2020-05-31") == {"a": 6.6e12, "b": None} and see("2020-06-01") == {"a": 6.4e12, "b": None, "c": 1.0} and see("2019-01-01") == {}


def test_asof_joins_equal_naive(spark):
    rng = random.Random(2)
    date = lambda: D(2020, 1, 1) + dt.timedelta(rng.randint(0, 60))
    bars = {(rng.choice("abc"), date()) for _ in range(80)}
    shares = {(rng.choice("abcd"), date()): (rng.randint(1, 99), None if rng.random() < 0.3 else date()) for _ in range(60)}
    b = spark.createDataFrame([(c, d, 2) for c, d in bars], "code string, date date, close int")
    s = spark.createDataFrame([(c, d, n, k) for (c, d), (n, k) in shares.items()], "code string, date date, shares int, knowledge_date date")

    def naive(c, d, pit):
        fit = [(e, n) for (x, e), (n, k) in shares.items() if x == c and e <= d and (not pit or (k or e) <= d)]
        return max(fit)[1] if fit else None

    for days in (1, 5, 366):  # over the ends of many blocks, and within one
        assert {(r.code, r.date): r.shares for r in asof.asof_shares(b, s, days=days).collect()} == {x: naive(*x, False) for x in bars}
        assert {(r.code, r.date): r.shares for r in asof.asof_shares_pit(b, s, days=days).collect()} == {x: naive(*x, True) for x in bars}
    factors = {(c, d): rng.choice([0.5, 2.0]) for c, d in list(bars)[:30]}
    f = spark.createDataFrame([(c, d, x) for (c, d), x in factors.items()], "code string, date date, factor double")
    got = {(r.code, r.date): r.close for r in asof.back_adjust(b, f, ["close"], 3).collect()}
    assert got == {(r.code, r.date): r.close for r in asof.back_adjust(b, f, ["close"]).collect()}
    for c, d in bars:
        want = 2.0
        for (x, e), factor in factors.items():
            want *= factor if x == c and e > d else 1
        assert got[c, d] == want


def test_a_hot_code_is_many_groups(spark):
    """A code with most of the rows is dealt by blocks of days; nulls in code and date are values."""
    rows = [("a", D(2000, 1, 1) + dt.timedelta(k), k) for k in range(0, 4000, 3)] + [("b", D(2001, 1, 1), 1), (None, D(2002, 1, 1), 2), (None, None, 3)]
    bars = spark.createDataFrame(rows, "code string, date date, close int")
    shares = spark.createDataFrame([("a", D(2000, 1, 2), 5), ("a", D(2009, 1, 1), 6), (None, D(2001, 1, 1), 7)], "code string, date date, shares int")
    got = {(r.code, r.date): r.shares for r in asof.asof_shares(bars, shares).collect()}
    for c, d, _ in rows:
        want = None if d is None or c == "b" else 7 if c is None else 6 if d >= D(2009, 1, 1) else 5 if d > D(2000, 1, 1) else None
        assert got[c, d] == want, (c, d)
    plan = asof.asof_shares(bars, shares)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__k" in plan and plan.count("hashpartitioning(__k") == 4  # the rows once, their blocks three times


def test_batches_of_zero_padded_codes(spark):
    """Codes that all begin alike: the ranges are taken from what comes after, so no group holds most of them."""
    pending = spark.range(5000).selectExpr("lpad(id * 7, 12, '0') as code", "concat('202', id % 2, 'Q1') as period").unionByName(spark.createDataFrame([(None, "2020Q1"), ("", "2020Q1"), ("é", "2020Q1")], "code string, period string"))
    got = [(r.period, r.code or "", r.batch) for r in worklists.batch_worklist(pending, 100).collect()]
    for p in ("2020Q1", "2021Q1"):
        own = sorted((c.encode(), b) for q, c, b in got if q == p)
        assert [b for _, b in own] == [i // 100 for i in range(len(own))]
    plain = pending.where("code like '0%'")
    text = worklists.batch_worklist(plain, 100)
    assert text.count() == 5000 and worklists.batch_worklist(plain.where("false"), 100).count() == 0


def test_streaks(spark):
    rng = random.Random(3)
    seen = [(f, i, rng.choice(["x", "x", "x", "y", None])) for f in "ab" for i in range(40)]
    want, last = {}, {}
    for f, i, m in seen:
        n = last[f][1] + 1 if f in last and last[f][0] == m else 0
        want[f, i], last[f] = n, (m, n)
    df = spark.createDataFrame(seen, "feed string, checked bigint, modified string")
    for span in (1, 3, 7, 1000):
        assert {(r.feed, r.checked): r.streak for r in feeds.unchanged_streak(df, span).collect()} == want


def test_refresh_reasons(spark):
    listing = spark.createDataFrame([(x, "m", 5) for x in ("ok", "absent", "norec", "newer", "size", "hash", "nohash")], "file string, modified string, size bigint")
    inv = spark.createDataFrame([(x, 6 if x == "size" else 5, "h") for x in ("ok", "norec", "newer", "size", "hash", "nohash")], "file string, size bigint, sha256 string")
    man = spark.createDataFrame([(x, "old" if x == "newer" else "m", None if x == "nohash" else "z" if x == "hash" else "h") for x in ("ok", "absent", "newer", "size", "hash", "nohash")], "file string, modified string, sha256 string")
    assert dict(rows(feeds.needs_refresh(listing, inv, man))) == {"ok": None, "absent": "absent", "norec": "no record", "newer": "modified", "size": "size", "hash": "checksum", "nohash": None}


def test_report_lists_every_subscription(spark):
    names = [f"feed{i}" for i in range(14)]
    sub = spark.createDataFrame([(n,) for n in names], "feed string")
    listing = spark.createDataFrame([(n, 10) for n in names[1:]] + [("unknown", 1)], "feed string, size bigint")
    fetched = spark.createDataFrame([("feed1",)], "feed string")
    streaks = spark.createDataFrame([("feed2", 2), ("feed3", 1), ("feed4", 3)], "feed string, streak bigint")
    report = feeds.feed_status_report(sub, listing, fetched, streaks, {"feed4": 8})
    got = {r.feed: r.verdict for r in report.collect()}
    assert len(got) == 14 and (got["feed0"], got["feed1"], got["feed2"], got["feed3"], got["feed4"]) == ("not listed", "new", "stale", "current", "current")
    assert sum(r.feeds for r in quality.status_totals(report).collect()) == 14


def test_worklists(spark):
    bars = spark.createDataFrame([("A", D(2020, 1, 1), 1, "backfill"), ("B", D(2020, 1, 1), 1, "backfill"), ("B", D(2020, 2, 1), 1, "backfill"), ("C", D(2020, 1, 1), 1, "primary")], BARS)
    shares = spark.createDataFrame([("A",)], "code string")
    assert rows(worklists.shares_worklist(bars, shares, "backfill")) == [("B", D(2020, 1, 1), D(2020, 2, 1))]
    master = spark.createDataFrame([("000001", "m", None, None), ("000002", "m", D(2015, 1, 1), None), ("000003", "m", D(2021, 1, 1), D(2024, 1, 1)), ("00000K", "m", None, None), ("000005", "other", None, None)], "code string, market string, last_trade_date date, checked date")
    start = F.to_date(F.lit("2016-09-09"))
    todo = lambda again: [r.code for r in worklists.delisted_bars_worklist(master, bars, "backfill", start, ["m"], again).orderBy("code").collect()]
    assert todo(False) == ["000001"] and todo(True) == ["000001", "000003"]
    marked = merge.mark_checked(master, spark.createDataFrame([("000001",)], "code string"), F.to_date(F.lit("2024-02-02")))
    assert {r.code: r.checked for r in marked.collect()}["000001"] == D(2024, 2, 2)
    codes = spark.createDataFrame([("005930",)], "code string")
    periods = spark.createDataFrame([("2023Q1",), ("2023Q2",)], "period string")
    present = spark.createDataFrame([("005930", "2023Q1")], "code string, period string")
    assert rows(worklists.pending_periods(codes, periods, present)) == [("005930", "2023Q2")]
    assert rows(worklists.pending_periods(codes, periods.where("false"), present)) == []
    four = spark.createDataFrame([(c, "2023Q1") for c in "abc"], "code string, period string")
    assert [r.batch for r in worklists.batch_worklist(four, 2).orderBy("code").collect()] == [0, 0, 1]


def test_gates(spark):
    kind = "table string, rows bigint, newest date"
    was = spark.createDataFrame([("t", 100, D(2026, 8, 14))], kind)
    cases = [((99, D(2026, 8, 14)), 0, 0), ((80, D(2026, 8, 14)), 1, 0), ((100, D(2026, 8, 10)), 0, 1), ((95, D(2026, 8, 15)), 0, 0), ((100, None), 0, 1)]
    for (n, newest), shrank, back in cases:
        c = quality.compare_to_baseline(spark.createDataFrame([("t", n, newest)], kind), was)
        assert (quality.gate_row_regression(c).count(), quality.gate_date_regression(c).count()) == (shrank, back)
    none = quality.compare_to_baseline(was, was.where("false"))
    assert quality.gate_row_regression(none).count() == quality.gate_date_regression(none).count() == 0
    now = spark.createDataFrame([("t", 1, None), ("empty", 0, None), ("gone", None, None)], kind)
    assert rows(quality.gate_presence(now, now.select("table"))) == [("empty", "empty"), ("gone", "missing")]
    out = spark.createDataFrame([("a", "failed", 0)] + [(str(i), "done", 1) for i in range(4)], "code string, outcome string, rows int")
    assert quality.failure_rate_gate(out).count() == 0 and quality.failure_rate_gate(out, 0.1).count() == 1 and quality.failure_rate_gate(out.where("false")).count() == 0
    with pytest.raises(ValueError):
        quality.not_empty(out.where("false"), "x")
    pit = spark.createDataFrame([(D(2020, 1, 2), D(2020, 1, 1))] * 99 + [(D(2020, 1, 1), D(2020, 1, 2))], "known date, about date")
    assert quality.drop_pit_violations(pit, "known", "about").count() == 99
    with pytest.raises(ValueError):
        quality.drop_pit_violations(pit, "known", "about", 0.001)


def test_counts_of_tables_in_one_frame_equal_those_of_each(spark):
    df = spark.createDataFrame([("a", D(2020, 1, 1)), ("a", D(2021, 1, 1)), ("b", None), ("other", D(2030, 1, 1)), (None, None)], "t string, date date")
    own = lambda n: df.where(F.col("t") == n)
    want = quality.table_counts({"a": own("a"), "b": own("b"), "none": own("none"), "gone": None}, {n: "date" for n in ("a", "b", "none")})
    assert rows(quality.counts_by(df, F.col("t"), ("a", "b", "none"), ("gone",))) == rows(want)


def test_publish(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    assert publish.current(spark, root) is None
    make = lambda n, last=9: spark.range(n).select("id", F.to_date(F.lit(f"2026-01-0{last}")).alias("date"))
    names = [publish.publish(make(n), root, 1, "date", jobs.gates()) for n in (100, 99, 98)]
    held = publish.current(spark, root)
    assert held.count() == 98 and not (tmp_path / "t" / f"gen={names[0]}").exists() and (tmp_path / "t" / f"gen={names[1]}").exists()
    for bad in (make(50), make(100, 8), make(0)):
        with pytest.raises(publish.GateFailed):
            publish.publish(bad, root, 1, "date", jobs.gates())
    assert publish.current(spark, root).count() == 98
    publish.publish(make(100), root, 0, "date")
    assert sum(p.name.startswith("gen=") for p in (tmp_path / "t").iterdir()) == 1


def test_an_update_rewrites_only_the_parts_it_touches(spark, tmp_path):
    root, key, part = f"file://{tmp_path}/t", ["code", "date"], F.substring(F.col("date").cast("string"), 1, 4)
    make = lambda rows: spark.createDataFrame([(c, D(y, 1, 2) if y else None, n) for c, y, n in rows], "code string, date date, n int")
    step = lambda base, new: merge.merge_update(base, new, key)
    folders = lambda: {p.part: p.path for p in publish._parts(spark, root, publish.latest(spark, root).generation)}
    publish.update(make([("a", 2020, 1), ("b", 2020, 2), ("a", 2021, 3), (None, None, 4)]), root, part, step, 1, "date")
    first, held = folders(), publish.current(spark, root)
    assert set(first) == {"2020", "2021", ""}
    publish.update(make([("b", 2020, 9), ("c", 2022, 5)]), root, part, step, 1, "date")
    second = folders()
    assert {k for k in first if first[k] != second[k]} == {"2020"} and set(second) == {"2020", "2021", "2022", ""}
    want = [("a", D(2020, 1, 2), 1), ("a", D(2021, 1, 2), 3), ("b", D(2020, 1, 2), 9), ("c", D(2022, 1, 2), 5), (None, None, 4)]
    assert rows(publish.current(spark, root)) == sorted(want, key=str)
    assert held.count() == 4 and publish.generations(spark, root).orderBy(F.desc("number")).first()["rows"] == 5
    # a null key is merged like any other; a repeat changes nothing; what nothing names goes
    for _ in range(2):
        publish.update(make([(None, None, 6), ("a", 2021, 7)]), root, part, step, 1, "date")
    assert rows(publish.current(spark, root)) == sorted([w if w[0] else (None, None, 6) for w in want if w[:2] != ("a", D(2021, 1, 2))] + [("a", D(2021, 1, 2), 7)], key=str)
    left = {str(p) for p in tmp_path.glob("t/gen=*/__part=*")}
    assert len(left) == 4 + 2  # the current parts, and two of the generation before
    assert publish.generations(spark, root).orderBy(F.desc("number")).first()["newest"] == D(2022, 1, 2)


def test_an_update_of_a_table_that_was_published_whole(spark, tmp_path):
    root, part = f"file://{tmp_path}/t", F.col("k") % 2
    publish.publish(spark.range(4).selectExpr("id as k", "0 as v"), root)
    publish.update(spark.createDataFrame([(2, 5), (9, 6)], "k bigint, v int"), root, part, lambda base, new: merge.merge_update(base, new, ["k"]))
    assert rows(publish.current(spark, root)) == [(0, 0), (1, 0), (2, 5), (3, 0), (9, 6)]
    publish.update(spark.createDataFrame([(4, 1)], "k bigint, v int"), root, part, lambda base, new: merge.merge_insert_only(base, new, ["k"]))
    assert rows(publish.current(spark, root)) == [(0, 0), (1, 0), (2, 5), (3, 0), (4, 1), (9, 6)]


def test_null_keys_are_merged_once(spark):
    base = spark.createDataFrame([(None, 1, 5)], "k int, j int, v int")
    new = spark.createDataFrame([(None, 1, 6), (None, None, 7)], "k int, j int, v int")
    once = merge.merge_update(base, new, ["k", "j"])
    assert rows(once) == [(None, 1, 6), (None, None, 7)] == rows(merge.merge_update(once, new, ["k", "j"]))
    assert rows(merge.merge_insert_only(base, new, ["k", "j"])) == [(None, 1, 5), (None, None, 7)]


def test_streaks_in_batches_equal_those_of_the_whole(spark, tmp_path):
    rng = random.Random(4)
    seen = [(f, i, rng.choice(["x", "x", "x", "y", None])) for i in range(90) for f in ("a", "b", "c")[: 3 if i > 40 else 2]]
    df = spark.createDataFrame(seen, "feed string, checked bigint, modified string")
    path, root, out = f"{tmp_path}/in", f"file://{tmp_path}/last", f"file://{tmp_path}/out"
    for lo, hi in ((0, 7), (7, 8), (8, 60), (60, 90)):
        df.where(f"checked >= {lo} and checked < {hi}").write.mode("append").parquet(path)
        streams.stream_streaks(streams.files(spark, path, df.schema), root, out, f"{tmp_path}/state")
    got = {(r.feed, r.checked): r.streak for r in spark.read.parquet(out).collect()}
    assert got == {(r.feed, r.checked): r.streak for r in feeds.unchanged_streak(df).collect()}


def test_quantiles_and_batches_in_levels(spark):
    rng = random.Random(5)
    values = [rng.choice([rng.random(), float(rng.randint(0, 3))]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = quality.exact_quantiles(df, F.col("v"), {"low": 0.0, "mid": 0.5, "most": 0.951, "top": 1.0}, accuracy=50).first()
    ordered = sorted(values)

    def want(share):
        place = (len(ordered) - 1) * share
        lo = int(place)
        return ordered[lo] if lo == place else ordered[lo] * (lo + 1 - place) + ordered[lo + 1] * (place - lo)

    assert [got[k] for k in ("low", "mid", "most", "top")] == pytest.approx([want(x) for x in (0.0, 0.5, 0.951, 1.0)])
    for n in range(1, 60):  # few values, far fewer than the sketch can tell apart
        some = spark.range(n).select((F.col("id") * F.col("id")).cast("double").alias("v"))
        ordered = [float(i * i) for i in range(n)]
        if n % 7 in (1, 4):
            assert quality.exact_quantiles(some, F.col("v"), {"p95": 0.95}).first().p95 == pytest.approx(want(0.95))
    ordered = sorted(values)
    assert quality.exact_quantiles(df.where("false"), F.col("v"), {"mid": 0.5}).first().mid is None
    pending = spark.createDataFrame([(f"{rng.randint(0, 999999):06d}", p) for p in ("2020Q1", "2020Q2") for _ in range(400)], "code string, period string").distinct()
    got = [(r.period, r.code, r.batch) for r in worklists.batch_worklist(pending, 30).orderBy("period", "code").collect()]
    for p in ("2020Q1", "2020Q2"):
        assert [b for q, _, b in got if q == p] == [i // 30 for i in range(sum(q == p for q, *_ in got))]


def test_copying_tables_and_reports(spark):
    bars = spark.createDataFrame([("a", D(2026, 7, 1), 3), ("b", D(2026, 6, 1), 4)], "code string, date date, close int")
    have = jobs.typed(bars.where("false"), "daily_bars")
    schema = jobs.TABLES["daily_bars"].schema
    have = have.select(*[F.col(c) if c in have.columns else F.lit(None).cast(schema[c].dataType).alias(c) for c in schema.fieldNames()])
    master = spark.createDataFrame([("a", "A", "m", "s", "k")], jobs.TABLES["stocks"].schema)
    done = jobs.copy_tables({"daily_bars": bars, "stocks": master}, {"daily_bars": have, "stocks": master.where("false")}, 7, F.to_date(F.lit("2026-07-03")))
    assert [(r.code, r.close, r.source) for r in done["daily_bars"].collect()] == [("a", 3, "primary")] and done["stocks"].count() == 1
    every = jobs.copy_tables({"daily_bars": bars}, {"daily_bars": have}, None, F.to_date(F.lit("2026-07-03")))
    assert every["daily_bars"].count() == 2
    now = spark.createDataFrame([("t", 5, None), ("new", 5, None)], "table string, rows bigint, newest date")
    assert rows(quality.without_baseline(quality.compare_to_baseline(now, now.where("table = 't'")))) == [("new",)]
    dated = worklists.attach_last_trade_date(spark.createDataFrame([("a",), ("z",)], "code string"), bars)
    assert tuple(worklists.matched(dated).first()) == (1, 1)


def test_the_first_generation_warns_that_nothing_is_there_to_compare_with(spark, tmp_path):
    make = lambda: spark.range(3).select("id", F.to_date(F.lit("2026-01-01")).alias("date"))
    with pytest.warns(UserWarning, match="nothing to compare"):
        publish.publish(make(), f"file://{tmp_path}/t", 1, "date", jobs.gates())
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        publish.publish(make(), f"file://{tmp_path}/t", 1, "date", jobs.gates())
