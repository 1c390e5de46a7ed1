import hashlib

from pyspark.sql import functions as F

from tideline.llm import warc


def test_keys():
    assert warc.surt("HTTP://www.Example.COM:80/A?b=1#c") == "com,example)/a?b=1"
    assert warc.surt("https://a.b:8443") == "b,a:8443)/"
    assert warc.surt(None) == "-" and warc.surt("") == "-" and warc.surt("not a url") == "not a url"
    assert warc.surt("http://[bad") == "http://[bad"


def test_round_trip_and_lookup(spark):
    big, small = "<p>é</p>\r\n\r\n" * 200, "<p>"
    pages = [(i, f"http://h{i % 3}.example.com/{i % 40}", big if i % 5 == 0 else f"{small}{i}" * (300 if i % 2 else 1)) for i in range(130)]
    pages += [(500, None, None), (501, "http://x.org/\tq", ""), (502, "http://x.org/", None), (None, "http://n.org/", big)]
    frame = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id bigint, url string, html string, digest string, length int")
    root = warc.shared_dir(spark, "warc")
    captures = warc.write_archives(frame, f"{root}/a")
    directory = warc.build_index(captures, f"{root}/i", block=7)
    rows = {r.page_id: r for r in warc.read_back(frame, directory).collect()}
    assert len(rows) == len(pages)
    for page, _, html in pages:
        data = (html or "").encode()
        same = [p for p, _, h in pages if h == html and p is not None]
        revisit = len(data) >= 1000 and page != max(same)
        r = rows[page]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", max(same)) if revisit else ("response", None))
    found = warc.Directory.load(directory)
    for url in {u for _, u, _ in pages if u}:
        assert {p for p, *_ in found.find(url)} == {p for p, u, _ in pages if u and warc.surt(u) == warc.surt(url)}
        for head, body in found.fetch(url):
            if head["WARC-Type"] == "response":
                assert hashlib.sha1(body).hexdigest() == head["WARC-Payload-Digest"].removeprefix("sha1:")
    assert found.find("http://nowhere.example/") == []
    some = warc.Directory.load(directory, key=warc.surt("http://h1.example.com/1"))
    assert 0 < len(some.first) < len(found.first) and some.find("http://h1.example.com/1")
    assert warc.round_trip(spark, frame.where("false")).count() == 0
    # the result comes through the index: captures that it lacks are not read
    part = warc.build_index(captures.where("page_id % 2 = 0"), f"{root}/part", block=7)
    assert {r.page_id for r in warc.read_back(frame, part).collect()} == {p for p, *_ in pages if p is not None and p % 2 == 0}


def test_one_archive_and_one_url_are_read_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 4096)
    pages = spark.range(600).select(F.col("id").alias("page_id"), F.lit("http://one.example/").alias("url"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).alias("html"))
    root = warc.shared_dir(spark, "warc")
    captures = warc.write_archives(pages.coalesce(1), f"{root}/a")
    directory = warc.build_index(captures, f"{root}/i", block=9)
    read = warc.read_captures(warc.stored(warc.look_up(warc.keyed(pages.select("url")), directory), "found"))
    sizes = [r.n for r in read.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 600 and len(sizes) > 2 and max(sizes) < 400


def test_archives_index_and_look_up_are_dealt_over_tasks(spark, monkeypatch):
    """One URL with most of the captures: its archives, its index files and the blocks of its look-up are many."""
    monkeypatch.setattr(warc, "ARCHIVE", 1 << 16)
    monkeypatch.setattr(warc, "LINES", 150)
    monkeypatch.setattr(warc, "KEYS", 5)
    pages = spark.range(900).coalesce(1).select(
        F.col("id").alias("page_id"), F.when(F.col("id") % 3 > 0, "http://one.example/").otherwise(F.concat(F.lit("http://h"), "id", F.lit(".example/"))).alias("url"), F.repeat(F.sha2((F.col("id") % 700).cast("string"), 256), 20).alias("html")
    )
    root = warc.shared_dir(spark, "warc")
    captures = warc.write_archives(pages, f"{root}/a")
    files = [r.n for r in captures.groupBy("file").agg(F.count("*").alias("n")).collect()]
    assert sum(files) == 900 and len(files) >= 12 and max(files) < 200
    directory = warc.build_index(captures, f"{root}/i", block=10)
    lines = [r.n for r in directory.groupBy("file").agg(F.sum("n").alias("n")).collect()]
    assert sum(lines) == 900 and len(lines) == 6 and max(lines) < 400
    more = pages.select("url").unionByName(spark.range(50).select(F.concat(F.lit("http://gone"), "id", F.lit(".example/")).alias("url")))
    found = warc.look_up(warc.keyed(more), directory)
    sizes = [r.n for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 900 == found.distinct().count() and len(sizes) >= 3 and max(sizes) < 600
    rows = {r.page_id: r for r in warc.read_back(pages, directory).collect()}
    assert len(rows) == 900 and all((rows[k].record_type, rows[k].refers_to) == (("revisit", k + 700) if k < 200 else ("response", None)) for k in rows)


def test_repeated_rows_are_records_of_their_own(spark):
    big, other = "x" * 2000, "y" * 2000
    pages = [(1, "http://a/", big), (1, "http://a/", big), (2, "http://b/", big), (2, "http://b/", big), (2, "http://b/", other), (3, "http://c/", other), (None, "http://d/", big), (None, None, None)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in warc.round_trip(spark, frame).collect())
    assert got == [(0, 0, "response", 0), (0, 2000, "revisit", 2), (1, 2000, "revisit", 2), (1, 2000, "revisit", 2), (2, 2000, "response", 0), (2, 2000, "response", 0), (2, 2000, "revisit", 3), (3, 2000, "response", 0)]
