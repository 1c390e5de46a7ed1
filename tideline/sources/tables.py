"""Reading and writing landed data, control tables and tables in generations."""

from __future__ import annotations

import csv
import hashlib
import io
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tideline.functions import scalars as fn
from tideline.operators import publish
from tideline.sources.schemas import TABLES


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.  Where that is unset, a session on one machine gets
    a temporary one; on a cluster, whose hosts don't share it, that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tideline-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None, name: str | None = None) -> DataFrame:
    """A typed scan: the schema is declared, never inferred; pass it or the name of a known table."""
    declared = TABLES[name].schema if name else schema
    return spark.read.schema(declared).parquet(path)


def explode_payload(df: DataFrame, payload: str, list_key: str, row_schema: StructType | str) -> DataFrame:
    """One row per element of the list under ``list_key`` of a JSON text, with its place as ``pos``
    (from 0).  A missing or null list, and text that isn't JSON, give no rows."""
    row = StructType.fromDDL(row_schema) if isinstance(row_schema, str) else row_schema
    parsed = F.from_json(F.col(payload), StructType().add(list_key, ArrayType(row)))[list_key]
    rest = [c for c in df.columns if c != payload]
    return df.select(*rest, F.posexplode(parsed).alias("pos", "__row")).select(*rest, "pos", "__row.*")


def read_snapshot_csv(spark: SparkSession, path: str, day: str | Column, code_col: str, shares_col: str, encoding: str = "UTF-8") -> DataFrame:
    """``(code, date, shares_outstanding)`` of a CSV with a header, whose columns are found by name.
    Rows without a code or a share count are left out; if a column is missing there are no rows.
    Encodings beyond Spark's own list, such as EUC-KR, need ``spark.sql.legacy.javaCharsets``."""
    raw = spark.read.option("header", True).option("encoding", encoding).csv(path)
    date = F.to_date(F.lit(day)) if isinstance(day, str) else day
    if code_col not in raw.columns or shares_col not in raw.columns:
        return spark.createDataFrame([], "code string, date date, shares_outstanding bigint")
    rows = raw.select(F.trim(F.col(f"`{code_col}`")).alias("code"), date.alias("date"), fn.nullable_int_trunc(F.col(f"`{shares_col}`")).alias("shares_outstanding"))
    return rows.where("code != '' and shares_outstanding is not null")


#: Encodings in which snapshots arrive, in the order in which they are tried.
ENCODINGS = ("euc-kr", "cp949", "utf-8-sig", "utf-8")


def snapshot_rows(content: bytes, code_col: str, shares_col: str) -> list[tuple[str, str]]:
    """``(code, shares)`` as text of one file, decoded by the first encoding that fits all of it, its columns
    found by its own header, whatever their order; none if a column is missing or nothing fits."""
    text = None
    for encoding in ENCODINGS:
        try:
            text = content.decode(encoding)
            break
        except UnicodeDecodeError:
            continue
    lines = csv.reader(io.StringIO((text or "").strip()))
    names = [x.strip().strip('"') for x in next(lines, [])]
    if code_col not in names or shares_col not in names:
        return []
    code, shares = names.index(code_col), names.index(shares_col)
    return [(row[code].strip().strip('"'), row[shares]) for row in lines if len(row) > max(code, shares)]


#: A day in a path, which is no part of a longer number.
PATH_DAY = r"(?<!\d)(\d{4}-\d{2}-\d{2}|\d{8})(?!\d)"
#: UUIDs and hashes in a path, such as that in the names of Spark's part files: their digits are no day.
PATH_ID = r"(?i)(?<![0-9a-z])(?:[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}|[0-9a-f]{32,})(?![0-9a-z])"


def path_day(path: Column) -> Column:
    """The last ``YYYY-MM-DD`` or ``YYYYMMDD`` in a path that is a day of the calendar, UUIDs and hashes aside;
    null if there is none."""
    found = F.regexp_extract_all(F.regexp_replace(path, PATH_ID, " "), F.lit(PATH_DAY), F.lit(1))
    return F.try_element_at(F.filter(F.transform(found, fn.parse_date), lambda day: day.isNotNull()), F.lit(-1))


def read_snapshots(spark: SparkSession, path: str, code_col: str, shares_col: str, day_of: Column | None = None) -> DataFrame:
    """``(code, date, shares_outstanding)`` of all files of a folder, each with an encoding and a header of its
    own.  ``day_of`` gives the date from ``path``; by default it is the last one there (:func:`path_day`).
    Rows without a code or a share count are left out, and a file that can't be read gives no rows.
    A file is read by one task, as one snapshot: a few thousand rows."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    day = path_day(F.col("path")) if day_of is None else day_of

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for date, content in zip(batch.column(0), batch.column(1)):
                found = snapshot_rows(content.as_py(), code_col, shares_col)
                columns = [pa.array(x, pa.string()) for x in ([c for c, _ in found], [n for _, n in found])]
                yield pa.RecordBatch.from_arrays([columns[0], pa.array([date.as_py()] * len(found), pa.date32()), columns[1]], ["code", "date", "shares"])

    out = files.select(day.alias("date"), "content").mapInArrow(rows, "code string, date date, shares string")
    shares = fn.nullable_int_trunc(F.col("shares"))
    return out.select("code", "date", shares.alias("shares_outstanding")).where("code != '' and shares_outstanding is not null")


NUMBER = r"-?\d+(?:\.\d+)?"
#: A row of array text: a day in quotation marks, then five numbers at least.
BAR_TEXT = r'\[\s*"(\d{8})"' + 5 * rf"\s*,\s*({NUMBER})(?![\d.])"


def parse_array_text(df: DataFrame, body: str = "body") -> DataFrame:
    """Rows ``["date", open, high, low, close, volume, ...]`` in a script's array text, one output
    row each, with its place as ``pos``; numbers stay doubles."""
    names = ("date", "open", "high", "low", "close", "volume")
    parts = [F.regexp_extract_all(F.col(body), F.lit(BAR_TEXT), F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
    rest = [c for c in df.columns if c != body]
    rows = df.select(*rest, F.posexplode(F.arrays_zip(*parts)).alias("pos", "r"))
    return rows.select(*rest, "pos", fn.parse_date(F.col("r.date")).alias("date"), *[F.col(f"r.{n}").try_cast("double").alias(n) for n in names[1:]])


FLOW_ROW = r"(?s)<tr[^>]*>(.*?)</tr>"
FLOW_DATE = r">\s*(\d{4}\.\d{2}\.\d{2})\s*<"
FLOW_NUMBER = r">\s*([+-]?\d[\d,]*)\s*<"


def parse_flow_html(df: DataFrame, html: str = "html") -> DataFrame:
    """Rows of an HTML table that hold a date and six whole-number cells at least, of which the
    first five count by position: close, change, volume, institution and foreign.  Rows with fewer
    would shift the values, so they are left out."""
    rest = [c for c in df.columns if c != html]
    rows = df.select(*rest, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(FLOW_ROW), F.lit(1))).alias("pos", "row"))
    cells = rows.select(
        *rest, "pos", F.regexp_extract("row", FLOW_DATE, 1).alias("day"), F.regexp_extract_all(F.col("row"), F.lit(FLOW_NUMBER), F.lit(1)).alias("cells")
    ).where("day != '' and size(cells) >= 6")
    names = ("close", "change", "volume", "institution", "foreign_")
    return cells.select(*rest, "pos", fn.parse_date(F.col("day")).alias("date"), *[fn.signed_int(F.col("cells")[i]).alias(n) for i, n in enumerate(names)])


#: Names of bulk feeds that differ from those of the tables.
BULK_NAMES = {"stocks": "prices", "holdings_ticker": "institutions"}


def bulk_name(feed: Column) -> Column:
    """The table that a bulk feed fills."""
    names = F.create_map(*[F.lit(x) for kv in BULK_NAMES.items() for x in kv])
    return F.coalesce(F.try_element_at(names, feed), feed)


def bulk_plan(manifest: DataFrame) -> DataFrame:
    """Of a manifest ``(feed, history, path)`` the full-history drops: ``(table, path)``."""
    return manifest.where("history = 'full'").select(bulk_name(F.col("feed")).alias("table"), "path")


def read_bulk_drop(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A landed CSV drop (plain or gzip), with a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def file_inventory(spark: SparkSession, path: str, checksum: bool = True, piece: int = 8 << 20) -> DataFrame:
    """``(path, size[, sha256])`` of the files of a folder that hold anything (Spark lists no empty ones).
    Without a checksum no content is read.

    With one, a task takes a file through the file system that its URI names and hashes it in pieces of
    ``piece`` bytes, so that its size doesn't matter; only where pyarrow has no such file system do contents go
    through Spark's reader, which can hold files of up to 2 GB."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    listed = files.select("path", F.col("length").alias("size"))
    if not checksum:
        return listed
    try:
        fs.FileSystem.from_uri(_arrow_uri(spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).getUri().toString() + "/"))
    except (pa.ArrowInvalid, OSError, ImportError):
        return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for uri in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(_arrow_uri(uri))
                digest = hashlib.sha256()
                with store.open_input_stream(name) as stream:
                    while block := stream.read(piece):
                        digest.update(block)
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.string())], ["path", "size", "sha256"])

    return listed.repartition("path").mapInArrow(hashed, "path string, size bigint, sha256 string")


def _arrow_uri(path: str) -> str:
    """A Hadoop path as a URI that pyarrow takes: two slashes, ``s3`` for ``s3a``, blanks and the like encoded."""
    scheme, _, rest = path.partition(":")
    host, slash, name = rest[2:].partition("/") if rest.startswith("//") else ("", "/", rest.lstrip("/"))
    return f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{host}{slash}{quote(name)}"


def read_control(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A JSON-lines control table; a missing path, corrupt lines and lines of another shape give no
    rows."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    try:
        rows = spark.read.schema(declared).option("mode", "DROPMALFORMED").json(path)
        return rows.na.drop("all")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], declared)


def merge_control(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The new record of each key whole, nulls included, else the old one; facts that only the old one holds
    stay."""
    o, n = old.withColumn("__old", F.lit(True)).alias("o"), new.withColumn("__new", F.lit(True)).alias("n")
    replaced = F.col("__new").isNotNull()

    def column(c: str) -> Column:
        if c == key:
            return F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c)
        if c not in new.columns:
            return F.col(f"o.{c}").alias(c)
        return F.when(replaced, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}") if c in old.columns else F.lit(None)).alias(c)

    joined = o.join(n, F.col(f"o.{key}").eqNullSafe(F.col(f"n.{key}")), "full")
    return joined.select(*[column(c) for c in dict.fromkeys([*old.columns, *new.columns])])


def write_control(df: DataFrame, root: str, key: str, keep: int = 2) -> None:
    """Makes ``df`` the control table below ``root``: its records replace those with their key whole,
    facts that only the old ones hold stay, and readers see the old table or the new one, never a part
    (:func:`tideline.operators.publish.publish`)."""
    old = publish.current(df.sparkSession, root)
    publish.publish(df if old is None else merge_control(old, df, key), root, keep)


def append_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Appends in a fixed column order; null becomes an empty field."""
    df.select(*columns).write.mode("append").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def done_from_csv(spark: SparkSession, path: str, keys: Sequence[str], schema: StructType | str) -> DataFrame:
    """The different keys already in an output CSV."""
    return read_bulk_drop(spark, path, schema).select(*keys).distinct()


def copy_window(src: DataFrame, days: int | None, today: str | Column, date_col: str = "date") -> DataFrame:
    """Rows whose date (as text in any known form, or a date) is at most ``days`` before today; all
    rows if ``days`` is None.  The date column comes out typed."""
    date = fn.parse_date(F.col(date_col)) if dict(src.dtypes)[date_col] == "string" else F.col(date_col).cast("date")
    rows = src.withColumn(date_col, date)
    if days is None:
        return rows
    now = F.to_date(F.lit(today)) if isinstance(today, str) else today
    return rows.where(F.col(date_col) >= F.date_sub(now, days))
