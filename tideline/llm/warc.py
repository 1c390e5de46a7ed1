"""WARC archives of pages with a two-level capture index.

Writing: every page becomes one gzip-compressed record of an archive file.  Payloads that were
stored elsewhere are written as revisit records that carry no payload.  Each task writes one file;
pages are dealt by page id and digest over as many tasks as their bytes ask for, so files are even
whatever the hosts.

The index: one line per capture, keyed by the URL with its host reversed, sorted over all files by
range partitions (as many as there are lines for), packed into gzip blocks of ``BLOCK`` lines.  The second level is a sparse
directory with the first key of each block, its file, offset and size.  A look-up binary-searches
the directory, reads the range of one block (or of a few), and then the range of each capture.

:class:`Directory` looks single URLs up.  :func:`look_up` does it for a table of URLs: keys are
sorted by ranges over tasks, each of which takes the stretch of the directory that its keys span and finds
the blocks they can be in; these blocks are dealt over all tasks, whatever key they are for, read as
ranges and searched; and the captures that turn up are read by byte ranges, dealt by place and not by
file.  So neither a single archive nor a single URL is read by one task, and nothing but a row for
each file of the directory is held on the driver.

Files are written below ``spark.checkpoint.dir`` through the file system that its URI names, under
a name of their own for each attempt and then moved in place, so a task that runs again does no harm.
"""

from __future__ import annotations

import gzip
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import shared_dir, stored

BLOCK = 300  # index lines in a block
CHUNK = 4 << 20  # bytes of an archive that a task reads in one go, about
ARCHIVE = 256 << 20  # bytes of payloads in an archive, about
LINES = 1_000_000  # lines in an index file, about
KEYS = 20_000  # keys that a task looks for in the directory in one go
LEAST = 1000  # bytes from which equal payloads are stored once


def surt(url: str | None) -> str:
    """The sort key of a URL: host reversed, scheme, ``www.`` and default port dropped, lower-case,
    fragment dropped.  A URL without a host is its own key; null gives ``-``."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        host, port = "", None
    if not host:
        return url.strip().lower().replace("\t", "%09").replace("\n", "%0a").replace("\r", "%0d") or "-"
    host = host.removeprefix("www.")
    away = "" if port in (None, {"http": 80, "https": 443}.get(parts.scheme)) else f":{port}"
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return (",".join(reversed(host.split("."))) + away + ")" + tail).lower().replace(" ", "%20").replace("\t", "%09")


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC/1.1 record, not compressed.  A revisit names the digest and the record it refers to
    and has no payload."""
    revisit = refers_to is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0d').replace(chr(10), '%0a')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    body = b"" if revisit else payload
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    n = int(headers["Content-Length"])
    if len(rest) < n:
        raise ValueError("a record is cut short")
    return headers, rest[:n]


def _number(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def write_archives(pages: DataFrame, root: str) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` below ``root``; returns a table of what was written:
    ``(file, page_id, url, offset, size)``.

    Of pages with equal payloads of at least 1000 bytes, the one with the largest page_id is the
    response, the others revisit it; smaller ones are all responses.  The payload is the html in
    UTF-8 (null: empty).  Rows that repeat a page_id are records of their own; if they hold the
    payload under its largest id, all of them are responses.  A null page_id is smaller than any.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    own = own.withColumn("digest", F.sha1("payload")).withColumn("length", F.octet_length("payload").cast("bigint"))
    light = stored(own.select("page_id", "digest", "length"), "digests")
    # only payloads that are there twice are joined: (page_id, digest) rows, without payloads
    large = light.where(F.col("length") >= LEAST)
    twice = large.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("holder")).where("n > 1 and holder is not null").drop("n")
    refers = large.join(twice, "digest").where("page_id is null or page_id != holder").select("page_id", "digest", "holder").distinct()
    # a page's reference comes just before its records, so payloads are dealt once and not joined
    tasks = max(pages.sparkSession.sparkContext.defaultParallelism, (light.agg(F.sum("length")).first()[0] or 0) // ARCHIVE)
    records = own.select("page_id", "digest", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("bigint").alias("holder"))
    notes = refers.select("page_id", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "holder")
    dealt = records.unionByName(notes).repartition(tasks, "page_id", "digest").sortWithinPartitions("page_id", "digest", "kind")

    names = ["file", "page_id", "url", "offset", "size"]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(root)
        name = f"{uuid.uuid4().hex}.warc.gz"
        out, at, note = None, 0, None
        for batch in batches:
            rows: list[tuple] = []
            for page, digest, kind, url, body, holder in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if not kind:
                    note = page, digest, holder
                    continue
                refers_to = note[2] if note and note[:2] == (page, digest) else None
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/.{name}", compression=None)
                data = gzip.compress(record(page, url, body, digest, refers_to), 6, mtime=0)
                out.write(data)
                rows.append((f"{root}/{name}", page, url, at, len(data)))
                at += len(data)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names)
        if out is not None:
            out.close()
            store.move(f"{base}/.{name}", f"{base}/{name}")

    return stored(dealt.mapInArrow(run, "file string, page_id bigint, url string, offset bigint, size bigint"), "captures")


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with the sort key of their ``url`` as ``key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([surt(u) for u in b.column("url").to_pylist()], type=pa.string()), *b.columns], ["key", *b.schema.names])

    return rows.mapInArrow(run, f"key string, {rows.schema.toDDL()}")


def build_index(captures: DataFrame, root: str, block: int = BLOCK) -> DataFrame:
    """Writes the capture lines of ``captures(file, page_id, url, offset, size)`` in key order as
    compressed blocks below ``root`` and returns the directory
    ``(first_key, last_key, file, offset, size, n)``, one row per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(root)
        name = f"{uuid.uuid4().hex}.idx.gz"
        out, at, rows, held = None, 0, [], []

        def flush() -> None:
            nonlocal out, at
            if not held:
                return
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/.{name}", compression=None)
            data = gzip.compress("\n".join("\t".join(x) for x in held).encode(), 6, mtime=0)
            out.write(data)
            rows.append((held[0][0], held[-1][0], f"{root}/{name}", at, len(data), len(held)))
            at += len(data)
            held.clear()

        for b in batches:
            for key, file, page, offset, size in zip(*(b.column(c).to_pylist() for c in ("key", "file", "page_id", "offset", "size"))):
                held.append((key, "" if page is None else str(page), file, str(offset), str(size)))
                if len(held) == block:
                    flush()
        flush()
        if out is not None:
            out.close()
            store.move(f"{base}/.{name}", f"{base}/{name}")
            types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], ["first_key", "last_key", "file", "offset", "size", "n"])

    lines = stored(keyed(captures).select("key", "file", "page_id", "offset", "size"), "lines")
    # range partitions by key, the page id breaking up runs of one key
    count = lines.count()
    files = max(min(captures.sparkSession.sparkContext.defaultParallelism, count // block), count // LINES, 1)
    ordered = lines.repartitionByRange(files, "key", "page_id", "file", "offset").sortWithinPartitions("key", "page_id", "file", "offset")
    return stored(ordered.mapInArrow(run, "first_key string, last_key string, file string, offset bigint, size bigint, n bigint"), "directory")


@dataclass
class Directory:
    """The sparse second level in memory: a row for ``BLOCK`` captures."""

    first: list[str]
    last: list[str]
    blocks: list[tuple[str, int, int]]

    @classmethod
    def load(cls, directory: DataFrame, key: str | None = None, most: int = 5_000_000) -> Directory:
        """All blocks, or those that can hold ``key``, which Spark picks by the statistics of the
        directory's files.  More than ``most`` blocks are refused: give a key then."""
        if key is not None:
            directory = directory.where((F.col("first_key") <= key) & (F.col("last_key") >= key))
        if directory.count() > most:
            raise ValueError(f"the directory has more than {most} blocks")
        rows = directory.orderBy("first_key", "last_key", "file", "offset").collect()
        return cls([r["first_key"] for r in rows], [r["last_key"] for r in rows], [(r["file"], r["offset"], r["size"]) for r in rows])

    def find(self, url: str) -> list[tuple[int | None, str, int, int]]:
        """``(page_id, file, offset, size)`` of all captures of a URL: a binary search, then a range
        read of each block that can hold the key."""
        key = surt(url)
        a, b = bisect_left(self.last, key), bisect_right(self.first, key)
        out = []
        for uri, offset, size in self.blocks[a:b]:
            for line in gzip.decompress(read_range(uri, offset, size)).decode().split("\n"):
                k, page, file, at, n = line.split("\t")
                if k == key:
                    out.append((int(page) if page else None, file, int(at), int(n)))
        return out

    def fetch(self, url: str) -> list[tuple[dict[str, str], bytes]]:
        """Headers and stored payload of all captures of a URL."""
        return [parse(gzip.decompress(read_range(file, at, n))) for _, file, at, n in self.find(url)]


def read_range(uri: str, offset: int, size: int) -> bytes:
    store, path = opened(uri)
    with store.open_input_file(path) as f:
        f.seek(offset)
        return f.read(size)


def look_up(keys: DataFrame, directory: DataFrame) -> DataFrame:
    """All captures whose key is one of ``keys.key``: ``(file, page_id, offset, size)``.  ``directory``
    is the stored table that :func:`build_index` has returned."""
    tops = directory.groupBy(F.input_file_name().alias("uri")).agg(F.min("first_key").alias("lo"), F.max("last_key").alias("hi")).orderBy("lo", "hi").collect()
    uris, lows, highs = ([r[c] for r in tops] for c in ("uri", "lo", "hi"))

    def hits(asked: list[str]) -> Iterator[pa.RecordBatch]:
        """The blocks that can hold some of the keys, which are sorted, with these."""
        for uri in uris[bisect_left(highs, asked[0]) : bisect_right(lows, asked[-1])]:
            store, path = opened(uri)
            spans = (ds.field("first_key") <= asked[-1]) & (ds.field("last_key") >= asked[0])
            for b in ds.dataset(path, filesystem=store, format="parquet").to_batches(columns=["first_key", "last_key", "file", "offset", "size"], filter=spans):
                for first, last, file, at, size in zip(*(c.to_pylist() for c in b.columns)):
                    own = asked[bisect_left(asked, first) : bisect_right(asked, last)]
                    if own:
                        n = len(own)
                        yield pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array([at] * n, pa.int64()), pa.array([size] * n, pa.int64()), pa.array(own)], ["index", "at", "length", "key"])

    def where(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for batch in batches:
            held += batch.column(0).to_pylist()
            if len(held) >= KEYS:
                yield from hits(held)
                held = []
        if held:
            yield from hits(held)

    names, types = ["file", "page_id", "offset", "size"], [pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, lines = None, {}
        for batch in batches:
            rows = []
            for file, at, size, key in zip(*(c.to_pylist() for c in batch.columns)):
                if block != (file, at):
                    block, lines = (file, at), {}
                    for line in gzip.decompress(read_range(file, at, size)).decode().split("\n"):
                        k, page, uri, offset, n = line.split("\t")
                        lines.setdefault(k, []).append((uri, int(page) if page else None, int(offset), int(n)))
                rows += lines.get(key, ())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names)

    blocks = directory.count()
    tasks = max(min(keys.sparkSession.sparkContext.defaultParallelism, blocks), blocks // 1000, 1)
    asked = stored(keys.select("key").distinct(), "asked")
    sent = asked.repartitionByRange(tasks, "key").sortWithinPartitions("key").mapInArrow(where, "index string, at bigint, length bigint, key string")
    dealt = sent.repartition(tasks, "index", "at").sortWithinPartitions("index", "at")
    return dealt.mapInArrow(search, "file string, page_id bigint, offset bigint, size bigint")


def read_captures(found: DataFrame) -> DataFrame:
    """The records at ``found(file, offset, size)``:
    ``(file, offset, size, page_id, url, record_type, refers_to, digest, length, payload)``.

    Rows are dealt by ranges of their file, and records that lie side by side are read together.
    """
    names = ["file", "offset", "size", "page_id", "url", "record_type", "refers_to", "digest", "length", "payload"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def row(uri: str, offset: int, size: int, data: bytes) -> tuple:
        h, body = parse(gzip.decompress(data))
        return (uri, offset, size, _number(h["WARC-Record-ID"]), h["WARC-Target-URI"], h["WARC-Type"], _number(h.get("WARC-Refers-To")), h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"]), body)

    def spans(rows: list[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
        held: list[tuple[str, int, int]] = []
        for r in rows:
            if held and (held[-1][0] != r[0] or held[-1][1] + held[-1][2] != r[1] or r[1] + r[2] - held[0][1] > CHUNK):
                yield held
                held = []
            held.append(r)
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span in spans(list(zip(*(batch.column(i).to_pylist() for i in range(3))))):
                begin, end = span[0][1], span[-1][1] + span[-1][2]
                data, out, total = read_range(span[0][0], begin, end - begin), [], 0
                for uri, offset, size in span:
                    out.append(row(uri, offset, size, data[offset - begin : offset - begin + size]))
                    total += len(out[-1][-1])
                    if total > CHUNK or offset + size == end:
                        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), types)], names)
                        out, total = [], 0

    total = found.agg(F.sum("size")).first()[0] or 0
    tasks = max(found.sparkSession.sparkContext.defaultParallelism, min(1 << 16, total // (4 * CHUNK)))
    dealt = found.select("file", "offset", "size").repartition(tasks, "file", F.floor(F.col("offset") / CHUNK)).sortWithinPartitions("file", "offset")
    schema = "file string, offset bigint, size bigint, page_id bigint, url string, record_type string, refers_to bigint, digest string, length bigint, payload binary"
    return dealt.mapInArrow(run, schema)


def checked(read: DataFrame) -> DataFrame:
    """Per record of :func:`read_captures` the digest columns; a response whose payload doesn't
    match its own digest and length fails."""
    bad = (F.col("record_type") == "response") & ((F.sha1("payload") != F.col("digest")) | (F.octet_length("payload") != F.col("length")))
    fine = F.when(bad, F.raise_error(F.lit("a payload differs from its digest"))).otherwise(F.col("digest"))
    return read.select("page_id", F.col("length").alias("payload_bytes"), fine.alias("payload_digest"), "record_type", "refers_to")


def read_back(pages: DataFrame, directory: DataFrame) -> DataFrame:
    """Every record that the index of ``directory`` has for the URLs of ``pages``, read through it:
    ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``."""
    urls = keyed(pages.select(F.col("url").cast("string").alias("url")).distinct())
    return checked(read_captures(stored(look_up(urls, directory), "found")))


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as archives with their index in the shared folder, then looks every URL up
    in the index and reads all its captures back:
    ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``."""
    root = shared_dir(spark, "warc")
    directory = build_index(write_archives(pages, f"{root}/archive"), f"{root}/index")
    return read_back(pages, directory)
