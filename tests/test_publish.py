"""Tables in generations: writers that meet, empty results, later columns, zone maps, orphans, streams."""

import datetime as dt
import threading
import time

import pytest
from pyspark.sql import functions as F

from tideline.operators import merge, publish
from tideline.plans import jobs
from tideline.streaming import streams

D = dt.date
KEY = ["code", "date"]
BAR = "code string, date date, n int"


def part():
    return F.substring(F.col("date").cast("string"), 1, 4)


def step(base, new):
    return merge.merge_update(base, new, KEY, extend=True)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}/t"


def make(spark, found, kind=BAR):
    return spark.createDataFrame([(c, D(y, 1, 2), *n) for c, y, *n in found], kind)


def test_an_empty_update_publishes_the_parts_as_they_were(spark, root):
    none = make(spark, [])
    publish.update(none, root, part(), step)
    assert publish.current(spark, root).count() == 0 and publish.current(spark, root).columns == ["code", "date", "n"]
    publish.update(make(spark, [("a", 2020, 1), ("b", 2021, 2)]), root, part(), step, date_col="date")
    before = publish.latest(spark, root)
    done = publish.update(none, root, part(), step, date_col="date")
    after = publish.latest(spark, root)
    assert (done.rows, done.newest, after.number) == (2, D(2021, 1, 2), before.number + 1)
    assert [p.path for p in publish._parts(spark, root, after.generation)] == [p.path for p in publish._parts(spark, root, before.generation)]
    assert rows(publish.current(spark, root)) == [("a", D(2020, 1, 2), 1), ("b", D(2021, 1, 2), 2)]
    jobs.merge_into(make(spark, [], "code string, date date, close int"), root + "2", "daily_bars")
    jobs.merge_into(make(spark, [("a", 2020, 5)], "code string, date date, close int"), root + "2", "daily_bars")
    jobs.merge_into(make(spark, [], "code string, date date, close int"), root + "2", "daily_bars")
    assert [(r.code, r.close, r.source) for r in publish.current(spark, root + "2").collect()] == [("a", 5, "primary")]


def test_all_rows_of_a_part_may_go(spark, root):
    publish.update(make(spark, [("a", 2020, 1), ("b", 2021, 2)]), root, part(), step)
    publish.update(make(spark, [("a", 2020, 1)]), root, part(), lambda base, new: base.where("false"))
    assert rows(publish.current(spark, root)) == [("b", D(2021, 1, 2), 2)]


def test_a_row_must_stay_in_its_part(spark, root):
    publish.update(make(spark, [("a", 2020, 1)]), root, part(), step)
    with pytest.raises(Exception, match="left its partition"):
        publish.update(make(spark, [("a", 2020, 1)]), root, part(), lambda base, new: new.withColumn("date", F.date_add("date", 400)))
    assert rows(publish.current(spark, root)) == [("a", D(2020, 1, 2), 1)]


def test_a_later_column_is_there_for_all_parts_and_rewrites_none(spark, root):
    publish.update(make(spark, [("a", 2020, 1), ("b", 2021, 2)]), root, part(), step)
    path = {p.part: p.path for p in publish._parts(spark, root, publish.latest(spark, root).generation)}
    wider = make(spark, [("c", 2021, 3, "x"), ("d", 2021, 4, None)], BAR + ", source string")
    publish.update(wider, root, part(), step, defaults={"source": "old"})
    assert rows(publish.current(spark, root)) == [("a", D(2020, 1, 2), 1, "old"), ("b", D(2021, 1, 2), 2, None), ("c", D(2021, 1, 2), 3, "x"), ("d", D(2021, 1, 2), 4, None)]
    assert {p.part: p.path for p in publish._parts(spark, root, publish.latest(spark, root).generation)}["2020"] == path["2020"]
    # a delta without the column leaves it in the parts it touches; another column by a commit alone
    publish.update(make(spark, [("a", 2020, 7), ("e", 2022, 8)]), root, part(), step)
    held = publish.latest(spark, root).generation
    publish.add_columns(spark, root, {"grade": ("int", 5)})
    now = publish.latest(spark, root).generation
    assert [p.path for p in publish._parts(spark, root, now)] == [p.path for p in publish._parts(spark, root, held)]
    got = {r.code: (r.n, r.source, r.grade) for r in publish.current(spark, root).collect()}
    assert got == {"a": (7, "old", 5), "b": (2, None, 5), "c": (3, "x", 5), "d": (4, None, 5), "e": (8, None, 5)}  # the step has written e without a source
    publish.update(make(spark, [("e", 2022, 9, None)], BAR + ", grade int"), root, part(), step)
    assert {r.code: r.grade for r in publish.current(spark, root).collect()} == {"a": 5, "b": 5, "c": 5, "d": 5, "e": None}


def test_types_widen_or_fail(spark, root):
    publish.update(make(spark, [("a", 2020, 1)]), root, part(), step)
    publish.update(make(spark, [("b", 2021, 1 << 40)], "code string, date date, n bigint"), root, part(), lambda base, new: new)
    assert dict(publish.current(spark, root).dtypes)["n"] == "bigint"
    assert {r.code: r.n for r in publish.current(spark, root).collect()} == {"a": 1, "b": 1 << 40}
    with pytest.raises(ValueError, match="can't change"):
        publish.update(make(spark, [("c", 2022, "x")], "code string, date date, n string"), root, part(), lambda base, new: new)


def meanwhile(spark, root, found, seen):
    """A step during which, once, another writer publishes."""

    def run(base, new):
        if not seen:
            seen.append(1)
            publish.update(make(spark, found), root, part(), step)
        return step(base, new)

    return run


def test_of_two_writers_both_changes_survive(spark, root):
    publish.update(make(spark, [("a", 2020, 1), ("b", 2021, 2)]), root, part(), step)
    seen = []  # other parts: the step runs once
    publish.update(make(spark, [("a", 2020, 5)]), root, part(), meanwhile(spark, root, [("b", 2021, 6), ("c", 2022, 7)], seen), date_col="date")
    assert {r.code: r.n for r in publish.current(spark, root).collect()} == {"a": 5, "b": 6, "c": 7}
    assert publish.latest(spark, root).number == 3 and publish.latest(spark, root).rows == 3
    seen = []  # the same part: it runs again, on what the other has written
    publish.update(make(spark, [("a", 2020, 8)]), root, part(), meanwhile(spark, root, [("z", 2020, 9)], seen))
    assert {r.code: r.n for r in publish.current(spark, root).collect()} == {"a": 8, "b": 6, "c": 7, "z": 9}
    with pytest.raises(publish.Conflict):
        publish.update(make(spark, [("a", 2020, 0)]), root, part(), meanwhile(spark, root, [("z", 2020, 1)], []), attempts=1)
    assert {r.code: r.n for r in publish.current(spark, root).collect()} == {"a": 8, "b": 6, "c": 7, "z": 1}


def test_whole_tables_conflict_by_name(spark, root):
    publish.publish(make(spark, [("a", 2020, 1)]), root)

    def gate(now, was):
        publish.publish(make(spark, [("b", 2020, 2)]), root)
        return now.where("false")

    with pytest.raises(publish.Conflict, match="was published while"):
        publish.publish(make(spark, [("c", 2020, 3)]), root, gates=(gate,))
    assert rows(publish.current(spark, root)) == [("b", D(2020, 1, 2), 2)]
    assert publish.clean(spark, root, 2, grace=0) == []  # the one that failed has left nothing


def test_only_one_writer_gets_a_number(spark, root):
    got = []
    threads = [threading.Thread(target=lambda k=k: got.append(publish.put_if_absent(spark, f"{root}/n.json", {"k": k}))) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [False] * 7 + [True] and "k" in publish._read(spark, f"{root}/n.json")
    assert publish._names(spark, root) == ["n.json"]


def test_a_month_of_many_years_opens_one_part(spark, root):
    days = spark.range(30).selectExpr("cast(make_date(cast(1990 + id as int), 6, 15) as date) as date", "lpad(id, 6, '0') as code", "cast(id as int) as close")
    jobs.merge_into(days, root, "daily_bars")
    june = publish.current(spark, root, {"date": (D(2001, 6, 1), D(2001, 6, 30))})
    assert [r.close for r in june.collect()] == [11] and len(june.inputFiles()) == 1
    assert len(publish.current(spark, root, {"code": ("000003", "000004")}).inputFiles()) == 2
    assert publish.current(spark, root, {"date": (D(2100, 1, 1), None)}).count() == 0
    assert len(publish.current(spark, root).inputFiles()) >= 30
    done = jobs.copy_recent(spark, root, root + "-copy", "daily_bars", D(2018, 1, 1))
    assert (done.rows, done.newest) == (2, D(2019, 6, 15))


def test_counts_are_measured_while_writing(spark, root):
    kind = "code string, date date, close int"
    first = jobs.insert_into(make(spark, [("a", 2020, 1), ("b", 2021, 2)], kind), root, "daily_bars")
    again = jobs.insert_into(make(spark, [("a", 2020, 9), ("c", 2020, 3), ("d", 2022, 4)], kind), root, "daily_bars")
    none = jobs.insert_into(make(spark, [("a", 2020, 9)], kind), root, "daily_bars")
    assert [(g.tally["inserted"], g.rows) for g in (first, again, none)] == [(2, 2), (2, 4), (0, 4)]
    assert again.newest == D(2022, 1, 2) and {r.code: r.close for r in publish.current(spark, root).collect()} == {"a": 1, "b": 2, "c": 3, "d": 4}
    parts = publish._parts(spark, root, publish.latest(spark, root).generation)
    assert [(p.part, p.rows, p.low["code"], p.high["code"], p.low["date"]) for p in parts] == [("2020", 2, "a", "c", "2020-01-02"), ("2021", 1, "b", "b", "2021-01-02"), ("2022", 1, "d", "d", "2022-01-02")]


def test_what_a_killed_writer_has_left_goes_after_a_time(spark, root, tmp_path):
    publish.update(make(spark, [("a", 2020, 1), ("b", 2021, 2)]), root, part(), step, keep=1)
    name = publish._begin(spark, root)  # killed while its folder was written
    make(spark, [("x", 2020, 1)]).write.parquet(f"{root}/gen={name}")
    stray = f"{root}/gen=stray"
    make(spark, [("x", 2020, 1)]).write.parquet(stray)
    held = publish.current(spark, root)
    publish.update(make(spark, [("a", 2020, 3)]), root, part(), step, keep=1)
    assert publish.exists(spark, f"{root}/gen={name}") and not publish.exists(spark, stray)
    assert held.count() == 2  # an older reader's folders are there
    time.sleep(0.01)
    assert set(publish.clean(spark, root, 1, grace=0)) == {f"gen={name}"}
    assert rows(publish.current(spark, root)) == [("a", D(2020, 1, 2), 3), ("b", D(2021, 1, 2), 2)]
    assert not list((tmp_path / "t" / "intents").glob("[!.]*"))


RAW = "code string, date date, n int, at int"


def land(spark, path, found):
    spark.createDataFrame([(c, D(y, m, 2), n, at) for c, y, m, n, at in found], RAW).coalesce(1).write.mode("append").parquet(path)


def upsert(spark, path, root, state):
    streams.stream_upsert(streams.files(spark, path, RAW), root, KEY, "at", state, part())


def test_a_stream_onto_a_table_that_holds_rows(spark, root, tmp_path):
    publish.update(make(spark, [("a", 2020, 1), ("b", 2021, 2)]), root, part(), step)
    path, other = f"{tmp_path}/in", f"{tmp_path}/other"
    land(spark, path, [("a", 2020, 1, 5, 1), ("c", 2020, 1, 6, 1)])
    upsert(spark, path, root, f"{tmp_path}/state")
    assert {r.code: r.n for r in publish.current(spark, root).collect()} == {"a": 5, "b": 2, "c": 6}
    # a merge by hand, then a second stream into the table, then the first goes on; a replay of all is harmless
    publish.update(make(spark, [("d", 2020, 7)]), root, part(), step)
    land(spark, other, [("e", 2022, 1, 8, 1)])
    upsert(spark, other, root, f"{tmp_path}/state2")
    land(spark, path, [("b", 2021, 1, 9, 2)])
    upsert(spark, path, root, f"{tmp_path}/state")
    want = {"a": 5, "b": 9, "c": 6, "d": 7, "e": 8}
    assert {r.code: r.n for r in publish.current(spark, root).collect()} == want
    upsert(spark, path, root, f"{tmp_path}/state3")  # a new stream over the same files
    assert {r.code: r.n for r in publish.current(spark, root).collect()} == want and len(publish.latest(spark, root).ledger) == 3


@pytest.mark.parametrize("before", [True, False])
def test_a_crash_around_the_switch(spark, root, tmp_path, monkeypatch, before):
    path, state = f"{tmp_path}/in", f"{tmp_path}/state"
    land(spark, path, [("a", 2020, 1, 1, 1)])
    upsert(spark, path, root, state)
    publish.update(make(spark, [("z", 2020, 3)]), root, part(), step)
    land(spark, path, [("a", 2020, 1, 2, 2), ("b", 2021, 1, 2, 2)])
    real = publish.put_if_absent

    def broken(*args):
        if not before:
            real(*args)
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(publish, "put_if_absent", broken)
    with pytest.raises(Exception, match="lost the driver"):
        upsert(spark, path, root, state)
    monkeypatch.setattr(publish, "put_if_absent", real)
    number = publish.latest(spark, root).number
    assert number == (2 if before else 3)
    upsert(spark, path, root, state)
    assert publish.latest(spark, root).number == 3
    assert {r.code: r.n for r in publish.current(spark, root).collect()} == {"a": 2, "b": 2, "z": 3}


def test_a_batch_of_late_rows_only(spark, root, tmp_path):
    path, late = f"{tmp_path}/in", f"{tmp_path}/late"
    run = lambda: streams.stream_late_window(streams.files(spark, path, RAW), root, late, KEY, "at", 10, f"{tmp_path}/state", part())
    for found in ([("a", 2021, 5, 1, 1)], [("a", 2021, 1, 2, 2), ("b", 2020, 1, 3, 2)], [("a", 2021, 5, 4, 3)]):
        land(spark, path, found)
        run()
    assert rows(publish.current(spark, root)) == [("a", D(2021, 5, 2), 4)]
    assert sorted((r.code, r.n) for r in spark.read.parquet(late).collect()) == [("a", 2), ("b", 3)]


VERSIONS = "code string, period string, day date, v int"


def test_corrections_that_arrive_late_give_the_rows_of_the_whole_table(spark, root, tmp_path):
    """Readings out of order over batches, a restart from the checkpoint before each."""
    import random

    rng = random.Random(6)
    days = sorted(rng.sample(range(300), 90))
    seen = [(rng.choice("ab"), "2020Q1", D(2020, 1, 1) + dt.timedelta(d), rng.randint(0, 2)) for d in days]
    arrival = sorted(range(len(seen)), key=lambda k: days[k] + rng.uniform(0, 25))
    path, state, sizes = f"{tmp_path}/in", f"{tmp_path}/state", []
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        run = lambda: streams.stream_versions(streams.files(spark, path, VERSIONS), root, ["code", "period"], "day", ["v"], state, F.substring("period", 1, 4), lateness="30 days")
        for k in range(0, len(seen), 15):
            spark.createDataFrame([seen[i] for i in arrival[k : k + 15]], VERSIONS).coalesce(1).write.mode("append").parquet(path)
            query = run()
            sizes.append(max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]))
        spark.createDataFrame([("c", "2021Q1", D(2021, 6, 1), 1)], VERSIONS).write.mode("append").parquet(path)
        run()
        want, last = [], {}
        for c, p, d, v in seen:
            if last.get(c) != v:
                want.append((c, p, d, v))
            last[c] = v
        assert rows(publish.current(spark, root)) == sorted(want, key=str)
        assert max(sizes) < 40  # readings of the last thirty days and of a batch, not of all time
        spark.createDataFrame([("a", "2020Q1", D(2020, 1, 1), 1)], VERSIONS).write.mode("append").parquet(path)
        with pytest.raises(ValueError, match="late"):
            run()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_restated_earnings_become_versions(spark):
    kind = "code string, period string, status string, pos int, account_nm string, thstrm_amount string, frmtrm_amount string"
    line = lambda n: spark.createDataFrame([("1", "2020Q1", "000", 0, jobs.nz.NET_INCOME[0], n, "50")], kind)
    codes = spark.createDataFrame([("1",)], "code string")
    day = lambda t: F.to_date(F.lit(t))
    empty = spark.createDataFrame([], jobs.TABLES["earnings"].schema)
    figures = lambda df: sorted((str(r.knowledge_date), r.netinc) for r in df.collect())
    one = jobs.earnings_increment(empty, codes, 4, line("100"), day("2020-08-01"), "today")
    same = jobs.earnings_increment(one, codes, 4, line("100"), day("2020-08-02"), "today")
    two = jobs.earnings_increment(same, codes, 4, line("90"), day("2020-08-03"), "today")
    assert figures(one) == figures(same) == [("2020-08-01", 100.0)] and figures(two) == [("2020-08-01", 100.0), ("2020-08-03", 90.0)]
    assert figures(jobs.earnings_increment(one, codes, 4, line("90"), day("2020-08-03"), "today", pending_only=True)) == figures(one)


def test_commits_on_a_file_system_without_links(spark, tmp_path):
    """A mount table stands for any file system but the local one: commits are renamed without overwriting."""
    (tmp_path / "store").mkdir()
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.test-store.link./t", f"file://{tmp_path}/store")
    root = "viewfs://test-store/t"
    assert publish.put_if_absent(spark, f"{root}/a/n.json", {"k": 1}) and not publish.put_if_absent(spark, f"{root}/a/n.json", {"k": 2})
    assert publish._read(spark, f"{root}/a/n.json") == {"k": 1} and publish._names(spark, f"{root}/a") == ["n.json"]
    publish.update(make(spark, [("a", 2020, 1), ("b", 2021, 2)]), root, part(), step, keep=0)
    publish.update(make(spark, [("a", 2020, 3)]), root, part(), step, keep=0)
    assert {r.code: r.n for r in publish.current(spark, root).collect()} == {"a": 3, "b": 2} and publish.latest(spark, root).number == 2


def test_a_day_into_tables_by_year(spark, root):
    raw = spark.createDataFrame([("a", "20240102", "-5", "9", "1", "6", "7", "8")], "code string, dt string, open string, high string, low string, close string, volume string, trade_value string")
    flow = spark.createDataFrame([("a", "20240102", "-6", "0.5", "7", *["+1"] * 11)], "code string, dt string, close string, flu_rt string, acc_trde_qty string, " + ", ".join(f"{x} string" for x in jobs.nz.INVESTORS))
    outcomes = spark.createDataFrame([("a", "done", 1)], "code string, outcome string, rows int")
    jobs.merge_into(make(spark, [("a", 2023, 1)], "code string, date date, close int"), f"{root}/daily_bars", "daily_bars")
    for _ in range(2):  # a day that is repeated changes nothing
        done = jobs.daily_ingest_into(root, raw, flow, raw.withColumn("name", F.lit("x")), outcomes)
    assert {k: v.rows for k, v in done.items()} == {"daily_bars": 2, "supply_demand": 1, "sector_index": 1}
    assert sorted((str(r.date), r.open, r.close) for r in publish.current(spark, f"{root}/daily_bars").collect()) == [("2023-01-02", None, 1), ("2024-01-02", 5, 6)]
    with pytest.raises(RuntimeError, match="too many"):
        jobs.daily_ingest_into(root, raw, flow, raw, outcomes.withColumn("outcome", F.lit("failed")))
