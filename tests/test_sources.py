import datetime as dt
import hashlib
import itertools
import json

import pytest
from pyspark.sql import functions as F

from tideline.operators import publish
from tideline.plans import queries_read
from tideline.sources import tables


def test_explode_payload(spark):
    rows = [("a", json.dumps({"list": [{"x": "1"}, {"x": None}]})), ("b", '{"list": null}'), ("c", "{}"), ("d", "not json"), ("e", None)]
    got = tables.explode_payload(spark.createDataFrame(rows, "code string, body string"), "body", "list", "x string").collect()
    assert sorted((r.code, r.pos, r.x) for r in got) == [("a", 0, "1"), ("a", 1, None)]


def test_snapshot_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"code","name","listed"\n"005930","x","5,969,782,550"\n"000660","y","728002365"\n"1","z","-"\n"2","w",""\n', encoding="utf-8")
    got = tables.read_snapshot_csv(spark, str(tmp_path / "a.csv"), "2026-08-12", "code", "listed").collect()
    assert sorted((r.code, r.shares_outstanding) for r in got) == [("000660", 728002365), ("005930", 5969782550)]
    assert tables.read_snapshot_csv(spark, str(tmp_path / "a.csv"), "2026-08-12", "code", "gone").count() == 0


def test_array_text(spark):
    body = 'x = [["day", "open"],\n["20200102", 100, 110, 90, 105, 7, 0.5],["20200103", 0, 0, 0, 2410, 0, 1]\n]'
    got = tables.parse_array_text(spark.createDataFrame([("a", body), ("b", "nothing")], "code string, body string")).collect()
    assert [(r.code, r.pos, r.date, r.open, r.close, r.volume) for r in got] == [("a", 0, dt.date(2020, 1, 2), 100.0, 105.0, 7.0), ("a", 1, dt.date(2020, 1, 3), 0.0, 2410.0, 0.0)]


def test_flow_html(spark):
    cells = lambda *xs: "".join(f'<td><span class="n"> {x} </span></td>' for x in xs)
    page = f"<table><tr><th>date</th></tr><tr>\n{cells('2026.08.12', '255,500', '-3,500', '-1.35%', '27,102,479', '+776,871', '5,802,466', '9')}</tr><tr>{cells('2026.08.11', '1', '2', '3', '4', '5')}</tr></table>"
    got = tables.parse_flow_html(spark.createDataFrame([("a", page), ("b", None)], "code string, html string")).collect()
    assert [(r.date, r.close, r.change, r.volume, r.institution, r.foreign_) for r in got] == [(dt.date(2026, 8, 12), 255500, -3500, 27102479, 776871, 5802466)]


def test_inventory_and_control(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.bin").write_bytes(b"abc")
    row = tables.file_inventory(spark, str(tmp_path / "f")).first()
    assert (row["size"], row.sha256) == (3, hashlib.sha256(b"abc").hexdigest())
    assert tables.file_inventory(spark, str(tmp_path / "f"), checksum=False).columns == ["path", "size"]
    assert tables.read_control(spark, str(tmp_path / "none"), "k string").count() == 0
    (tmp_path / "c.json").write_text('{"k": "a", "n": 1}\nbroken\n[1]\n')
    assert [r.k for r in tables.read_control(spark, str(tmp_path / "c.json"), "k string, n bigint").collect()] == ["a"]


def test_checksums_in_pieces(spark, tmp_path):
    want = {}
    for k, n in enumerate((1, 999, 4096, 100_000)):
        content = bytes(i * k % 251 for i in range(n))
        (tmp_path / "in" / str(k)).mkdir(parents=True)
        (tmp_path / "in" / str(k) / f"a b%{k}é.bin").write_bytes(content)
        want[k] = (n, hashlib.sha256(content).hexdigest())
    for piece in (7, 1000, 1 << 20):
        got = tables.file_inventory(spark, f"file://{tmp_path}/in", piece=piece).collect()
        assert {int(r.path.split("%")[1][0]): (r["size"], r.sha256) for r in got} == want
    assert [tables._arrow_uri(x) for x in ("file:/a b", "s3a://k/v w", "hdfs://h:8020/a%b")] == ["file:///a%20b", "s3://k/v%20w", "hdfs://h:8020/a%25b"]


def test_snapshots_of_several_encodings_and_headers(spark, tmp_path):
    """One folder: each file in an encoding and with an order of columns of its own."""
    code, shares, name = "종목코드", "상장주식수", "종목명"
    files = {
        "2026-08-10.csv": (f'"{code}","{name}","{shares}"\n"005930","삼성","5,969,782,550"\n"1","z","-"\n', "euc-kr"),
        "2026-08-11.csv": (f"{shares},{name},{code}\n728002365,뷁펲,000660\n,x,2\n", "cp949"),
        "20260812.csv": (f"{name},{code},{shares}\ny,000020,7.9\nshort,1\n", "utf-8-sig"),
        "2026-08-13.csv": (f"{code},{shares}\n000040,9\n", "utf-8"),
        "2026-08-14.csv": (f"{code},other\n000050,9\n", "utf-8"),
        "2026-08-15.csv": ("", "utf-8"),
    }
    for file, (text, encoding) in files.items():
        (tmp_path / file).write_bytes(text.encode(encoding))
    (tmp_path / "2026-08-16.csv").write_bytes(b"\xff\xfe\x00\x81,\xff\n")  # broken
    got = tables.read_snapshots(spark, str(tmp_path), code, shares)
    assert sorted(map(tuple, got.collect()), key=str) == [("000020", dt.date(2026, 8, 12), 7), ("000040", dt.date(2026, 8, 13), 9), ("000660", dt.date(2026, 8, 11), 728002365), ("005930", dt.date(2026, 8, 10), 5969782550)]


@pytest.mark.parametrize("name", ["12345678-ab12-4cd3-8ef4-0123456789ab", "4c7b66a6-018a-4c17-b722-a272460575c8", "20250101-018a-4c17-b722-ab20250102cd"])
def test_a_snapshots_day_is_not_taken_from_the_id_of_a_part_file(spark, tmp_path, name):
    """Spark's part files carry a UUID, whose digits may look like a day or are none."""
    for day in ("2026-08-10", "2026-08-11"):
        (tmp_path / f"date={day}").mkdir()
        (tmp_path / f"date={day}" / f"part-00000-{name}.c000.txt").write_text(f"code,shares\n{day[-2:]},7\n", encoding="utf-8")
    got = tables.read_snapshots(spark, str(tmp_path), "code", "shares")
    assert sorted(map(tuple, got.collect())) == [("10", dt.date(2026, 8, 10), 7), ("11", dt.date(2026, 8, 11), 7)]


def test_days_in_paths(spark):
    want = {
        "file:/a/2026-08-10/20260811.csv": dt.date(2026, 8, 11),
        "file:/a/20260811/2026-08-10.csv": dt.date(2026, 8, 10),
        "file:/a/listed20260812_v2.csv": dt.date(2026, 8, 12),
        "file:/a/2026-08-12/part-00012345.csv": dt.date(2026, 8, 12),  # eight digits, no day
        "file:/a/2026-08-12/2026-02-30.csv": dt.date(2026, 8, 12),
        "file:/a/2026-08-12/1786520250101.csv": dt.date(2026, 8, 12),  # a longer number
        f"file:/a/2026-08-12/{'ab20250101' * 4}.csv": dt.date(2026, 8, 12),  # a hash
        "file:/snapshots-1a2b3c4d20250101aaaabbbbccccdddd/x.csv": None,
        "file:/a/x.csv": None,
    }
    got = spark.createDataFrame([(x,) for x in want], "path string").select("path", tables.path_day(F.col("path"))).collect()
    assert dict(map(tuple, got)) == want


def test_control_is_replaced_but_keeps_local_facts(spark):
    seen = spark.createDataFrame([("a", 1, "x"), (None, 3, "z")], "feed string, n int, local string")
    later = spark.createDataFrame([("a", None), (None, 4)], "feed string, n int")
    assert sorted(map(tuple, tables.merge_control(seen, later, "feed").collect()), key=str) == [("a", None, "x"), (None, 4, "z")]
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "feed string, n int, local string")
    new = spark.createDataFrame([("a", 5), ("c", 6)], "feed string, n int")
    assert sorted(map(tuple, tables.merge_control(old, new, "feed").collect())) == [("a", 5, "x"), ("b", 2, "y"), ("c", 6, None)]


def test_control_is_written_whole(spark, tmp_path):
    root, kind = f"file://{tmp_path}/control", "feed string, n int, local string"
    tables.write_control(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], kind), root, "feed")
    held = publish.current(spark, root)
    tables.write_control(spark.createDataFrame([("a", 5), ("c", 6)], "feed string, n int"), root, "feed")
    want = [("a", 5, "x"), ("b", 2, "y"), ("c", 6, None)]
    assert sorted(map(tuple, publish.current(spark, root).collect())) == want
    assert sorted(map(tuple, held.collect())) == [("a", 1, "x"), ("b", 2, "y")]  # a reader keeps what it resolved
    broken = spark.createDataFrame([("d", 1)], "feed string, n int").withColumn("local", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.write_control(broken, root, "feed")
    assert sorted(map(tuple, publish.current(spark, root).collect())) == want


def test_array_text_takes_whole_numbers_only(spark):
    body = '["20310102", 1.5, 2, -3, 4.25, 5], ["20310103", 1.2.3, 2, 3, 4, 5], ["20310104", 1, 2, 3, 4., 5], ["20310105", 7, 7, 7, 7, 7]'
    got = tables.parse_array_text(spark.createDataFrame([("a", body)], "code string, body string")).collect()
    assert [(r.date.day, r.open, r.low, r.volume) for r in got] == [(2, 1.5, -3.0, 5.0), (5, 7.0, 7.0, 7.0)]


def test_csv_append_and_resume(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([("a", None, 1), ("b", "", 2)], "code string, v string, n int")
    tables.append_csv(rows.where("n = 1"), path, ("n", "code", "v"))
    tables.append_csv(rows.where("n = 2"), path, ("n", "code", "v"))
    done = tables.done_from_csv(spark, path, ["code"], "n int, code string, v string")
    assert sorted(r.code for r in done.collect()) == ["a", "b"]


def test_bulk_plan_and_window(spark):
    m = spark.createDataFrame([("stocks", "full", "p1"), ("holdings_ticker", "full", "p2"), ("daily", "delta", "p3"), ("daily", "full", "p4")], "feed string, history string, path string")
    assert sorted(map(tuple, tables.bulk_plan(m).collect())) == [("daily", "p4"), ("institutions", "p2"), ("prices", "p1")]
    rows = spark.createDataFrame([("a", "20260701"), ("b", "2026-06-20"), ("c", "bad")], "code string, date string")
    assert [tuple(r) for r in tables.copy_window(rows, 7, "2026-07-03").collect()] == [("a", dt.date(2026, 7, 1))]
    assert tables.copy_window(rows, None, "2026-07-03").count() == 3


@pytest.mark.parametrize("name", ["daily_bars", "earnings"])
def test_declared_schema(spark, tmp_path, name):
    from tideline.sources.schemas import TABLES

    spark.createDataFrame([], TABLES[name].schema).write.parquet(str(tmp_path / name))
    assert tables.read_table(spark, str(tmp_path / name), name=name).schema == TABLES[name].schema


def test_a_code_with_many_events_is_several_payloads(spark, tmp_path, monkeypatch):
    events = spark.range(25_000).selectExpr("id as event_id", "if(id % 3 = 0, 1L, id % 50) as user_id", "concat('{\"k\": ', id % 7, '}') as props")
    events = events.selectExpr("event_id", "timestamp '2024-01-01' as ts", "user_id", "'view' as event_type", "1.0D as value", "props")
    events.unionAll(events.selectExpr("event_id + 25000", "ts", "1L", "event_type", "value", "props")).write.parquet(f"{tmp_path}/events.parquet")
    sizes, explode = [], tables.explode_payload
    monkeypatch.setattr(tables, "explode_payload", lambda df, *rest: (sizes.extend(len(json.loads(r.body)["list"]) for r in df.select("body").collect()), explode(df, *rest))[1])
    got = sorted((r.code, r.pos, int(r.id), r.k) for r in queries_read.src_2_explode_payload(spark, str(tmp_path)).collect())
    assert max(sizes) <= 10_000 and sum(sizes) == len(got) == 50_000
    for code, rows in itertools.groupby(got, lambda r: r[0]):
        rows = list(rows)
        assert [r[1] for r in rows] == list(range(len(rows))) and [r[2] for r in rows] == sorted(r[2] for r in rows)
        assert all(k == str(i % 25_000 % 7) for _, _, i, k in rows)
