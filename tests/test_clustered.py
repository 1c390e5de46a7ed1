"""Tables kept clustered: the same rows as the plain operators give, and the table's side without an exchange."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import asof, clustered, merge, publish
from tideline.operators.clustered import Layout
from tideline.plans import jobs

D = dt.date
KEY = ["code", "date"]
BAR = "code string, date date, close int, note string"
AS = Layout(3, 100)


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def some(rng, n, codes=7, years=(2019, 2020, 2021)):
    keys = {(rng.choice([None, *map(str, range(codes))]), D(rng.choice(years), rng.randint(1, 12), rng.randint(1, 28))) for _ in range(n)}
    return [(*k, rng.choice([None, rng.randint(1, 9)]), rng.choice([None, "a", "b"])) for k in sorted(keys, key=str)]


def by_year():
    return F.substring(F.col("date").cast("string"), 1, 4)


def moved(df):
    """The scans of clustered files whose rows pass an exchange before any aggregate, and all such scans."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    above, met, scans = [], [], []
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        above = [(d, t) for d, t in above if d < depth]
        text = line.lstrip(" :+-*()0123456789")
        if text.startswith("FileScan") and "Bucketed: true" in text:
            scans.append(text)
            for _, t in reversed(above):
                if t.startswith(("SortAggregate", "HashAggregate", "ObjectHashAggregate")):
                    break
                if t.startswith(("Exchange", "BroadcastExchange")):
                    met.append(text)
                    break
        elif text.startswith("FileScan") and "__cluster" in text:
            met.append(text)
        above.append((depth, text))
    return met, scans


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}/t"


def make(spark, root, found, layout=AS):
    step = lambda base, new: merge.merge_update(base, new, KEY, extend=True)
    publish.update(spark.createDataFrame(found, BAR), root, by_year(), step, date_col="date", layout=layout)
    return publish.clustered(spark, root)


def test_merges_equal_those_of_plain_tables(spark, root):
    rng = random.Random(3)
    found, later = some(rng, 150), [r[:3] for r in some(rng, 90)]
    base, layout = make(spark, root, found)
    new = spark.createDataFrame(later, "code string, date date, close int").withColumn("more", F.lit(5))
    plain = spark.createDataFrame(found, BAR)
    fill = {"note": "d", "more": 4}
    got = clustered.merge_update(base, new, layout, KEY, fill, extend=True)
    assert rows(got.drop("__at")) == rows(merge.merge_update(plain, new, KEY, fill, extend=True))
    kept = clustered.merge_insert_only(base, new.drop("more"), layout, KEY, fill)
    assert rows(kept.drop("__at")) == rows(merge.merge_insert_only(plain, new.drop("more"), KEY, fill))
    for df in (got, kept):
        met, scans = moved(df)
        assert scans and not met
        assert "Exchange hashpartitioning" in df._jdf.queryExecution().executedPlan().toString()  # the new rows are dealt
    with pytest.raises(Exception, match="new rows hold a key twice"):
        clustered.merge_update(base, new.union(new), layout, KEY).collect()


def test_scans_over_codes_equal_those_of_plain_tables(spark, root):
    rng = random.Random(4)
    found = some(rng, 200)
    base, layout = make(spark, root, found)
    plain = spark.createDataFrame(found, BAR)
    counts = {(rng.choice([None, *map(str, range(9))]), D(rng.choice((2018, 2019, 2020)), rng.randint(1, 12), rng.randint(1, 28))) for _ in range(60)}
    shares = spark.createDataFrame([(*k, rng.randint(1, 99), rng.choice([None, D(2020, rng.randint(1, 12), 1)])) for k in sorted(counts, key=str)], "code string, date date, shares int, knowledge_date date")
    factors = shares.select("code", "date", F.when(F.col("shares") % 2 == 0, 2.0).otherwise(0.5).alias("factor"))
    for got, want in [
        (asof.market_cap_asof(base, shares, layout), asof.market_cap_asof(plain, shares)),
        (asof.asof_shares_pit(base, shares, layout=layout), asof.asof_shares_pit(plain, shares)),
        (asof.back_adjust(base, factors, ["close"], layout=layout), asof.back_adjust(plain, factors, ["close"])),
    ]:
        met, scans = moved(got)
        assert scans and not met
        assert rows(got.drop("__at")) == rows(want)


def test_a_clustered_table_stays_so(spark, root, tmp_path):
    """Two merges, one with a later column: one file for each bucket of a part, other years where they were."""
    rng = random.Random(5)
    found = [(c or "x", d, v, "s") for c, d, v, _ in some(rng, 120)]
    first = spark.createDataFrame(found, "code string, date date, close int, source string")
    later = first.where("year(date) = 2020").select("code", "date", F.lit(7).alias("close"), F.lit(1).alias("more"))
    other = root + "-plain"
    jobs.merge_into(first, root, "daily_bars", layout=AS)
    before = {p.part: p.path for p in publish._parts(spark, root, publish.latest(spark, root).generation)}
    jobs.merge_into(first, other, "daily_bars")
    for r in (root, other):
        jobs.merge_into(later, r, "daily_bars")
    assert rows(publish.current(spark, root)) == rows(publish.current(spark, other))
    df, layout = publish.clustered(spark, root)
    assert layout == AS and rows(df.drop("__at")) == rows(publish.current(spark, other))
    parts = publish._parts(spark, root, publish.latest(spark, root).generation)
    assert [p.part for p in parts if p.path == before[p.part]] == ["2019", "2021"]
    for p in parts:
        files = [f.name for f in (tmp_path / "t" / p.path).glob("*.parquet")]
        assert len(files) == len({f.split("_")[-1] for f in files}) <= AS.buckets
    inserted = [(jobs.insert_into(first.withColumn("date", F.add_months("date", 12)), r, "daily_bars")).tally for r in (root, other)]
    assert inserted[0] == inserted[1] and rows(publish.current(spark, root)) == rows(publish.current(spark, other))
    jobs.merge_into(first.where("false"), root, "daily_bars")
    one, _ = publish.clustered(spark, root, {"date": (D(2022, 1, 1), None)})
    assert rows(one.drop("__at")) == rows(publish.current(spark, root).where("date >= '2022-01-01'"))
    with pytest.raises(ValueError, match="kept as"):
        jobs.merge_into(first, root, "daily_bars", layout=Layout(5))


def test_any_step_keeps_a_table_clustered(spark, root, tmp_path):
    """A plain merge, as streams run it, onto a clustered table: new rows get their bucket too."""
    rng = random.Random(8)
    found, later = some(rng, 80), some(rng, 80)
    make(spark, root, found)
    publish.update(spark.createDataFrame(later, BAR), root, by_year(), lambda base, new: merge.merge_update(base, new, KEY), writer=("stream", 0))
    df, layout = publish.clustered(spark, root)
    assert rows(df.drop("__at")) == rows(merge.merge_update(spark.createDataFrame(found, BAR), spark.createDataFrame(later, BAR), KEY))
    assert df.where(~F.col("__at").eqNullSafe(layout.at())).count() == 0
    for p in publish._parts(spark, root, publish.latest(spark, root).generation):
        files = [f.name for f in (tmp_path / "t" / p.path).glob("*.parquet")]
        assert len(files) == len({f.split("_")[-1] for f in files})


def test_a_result_is_published_as_it_is_dealt(spark, root):
    """Adjusted bars of a clustered table become another one without moving, and old generations go from the catalog."""
    base, layout = make(spark, root, some(random.Random(6), 150))
    factors = spark.createDataFrame([("1", D(2020, 6, 1), 2.0)], "code string, date date, factor double")
    adjusted = asof.back_adjust(base, factors, ["close"], layout=layout)
    for _ in range(3):
        done = publish.publish(adjusted, root + "-adjusted", 1, "date", layout=layout)
        again, _ = publish.clustered(spark, root + "-adjusted")
        assert rows(again) == rows(adjusted) and done.rows == base.count()
    met, scans = moved(again.groupBy("__at", "code").count())
    assert scans and not met
    noted = [t.tableName for t in spark.sql("SHOW TABLES LIKE 'tideline_*'").collect()]
    kept = {g.generation for g in publish.generations(spark, root + "-adjusted").orderBy(F.desc("number")).limit(2).collect()}
    gone = {g.generation for g in publish.generations(spark, root + "-adjusted").collect()} - kept
    assert gone and not any(g in t for t in noted for g in gone)
    with pytest.raises(ValueError, match="not kept clustered"):
        publish.publish(factors, root + "-plain")
        publish.clustered(spark, root + "-plain")


def test_a_hot_code_lies_in_many_buckets(spark, root):
    found = [("hot", D(1990, 1, 1) + dt.timedelta(days=i), 1, None) for i in range(0, 10000, 5)] + [(str(i), D(2000, 1, 3), 1, None) for i in range(4000)]
    df, layout = make(spark, root, found, Layout(16))
    per = [r["count"] for r in df.groupBy(F.pmod(F.hash("__at"), F.lit(layout.buckets))).count().collect()]
    assert len(per) == 16 and max(per) < 2.5 * len(found) / 16
