"""Publishing a table in generations: build aside, gate, commit, keep some old ones.

A generation is a folder of its own, or a list of folders where a table is kept in parts, by year for
example.  What makes it current is a numbered commit: a small file that is created only if nobody has
created that number before, so that of two writers one comes first and the other sees it.  A commit
holds the schema of the table with the defaults of its columns, the figures measured while its rows were
written, the parts it touched, and the last batch of every stream that wrote to the table.

:func:`publish` writes a whole table.  :func:`update` merges rows into one that is kept in parts, of which
only those touched are read and written.  :func:`current` reads a generation, each part with the columns
it was written with, and only the parts that a range can match.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
import time
import uuid
import warnings
from collections.abc import Callable, Iterable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, LongType, StringType, StructType, TimestampType

from tideline.operators.clustered import Layout

STATS = "generation string, number bigint, rows bigint, newest date, parts boolean"
#: A writer that was killed leaves a folder; it goes when its intent is older than this.
GRACE_SECONDS = 24 * 3600


class GateFailed(RuntimeError):
    """A gate found something, so nothing was published."""


class Conflict(RuntimeError):
    """Another writer has published what this one was built on."""


class Generation(str):
    """The name of a published generation, with its number and what was measured while it was written."""

    number: int
    rows: int
    newest: dt.date | None
    tally: dict


@dataclass
class Part:
    """A folder of a generation: ``low`` and ``high`` are the least and greatest values of zone columns."""

    part: str
    path: str
    rows: int
    schema: str
    low: dict = field(default_factory=dict)
    high: dict = field(default_factory=dict)


@dataclass
class Commit:
    number: int
    generation: str
    rows: int
    newest: str | None
    parts: bool
    schema: str
    defaults: dict = field(default_factory=dict)
    ledger: dict = field(default_factory=dict)
    #: Names of the parts that were written anew; None if all were.
    touched: list | None = None
    tally: dict = field(default_factory=dict)
    #: How the files of all parts are bucketed, if the table is clustered.
    layout: dict | None = None

    def clustering(self) -> Layout | None:
        return Layout(**self.layout) if self.layout else None


# --- small files, through the file system that a URI names ---


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _read(spark: SparkSession, path: str) -> dict | list:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode())
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, value: object) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(value).encode()))
    finally:
        out.close()


def put_if_absent(spark: SparkSession, path: str, value: object) -> bool:
    """Writes a small file that nobody sees before it is whole, unless there is one already.

    The file is written under another name and then given its own: by a hard link on a local disk,
    elsewhere by a rename that doesn't overwrite, which HDFS and stores with atomic renames do in one step."""
    folder, _, name = path.rpartition("/")
    aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    _write(spark, aside, value)
    fs, source = _fs(spark, aside)
    target, jvm = _fs(spark, path)[1], spark._jvm
    try:
        if fs.getScheme() == "file":
            local = lambda p: jvm.java.nio.file.Path.of(p.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
            jvm.java.nio.file.Files.createLink(local(target), local(source))
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, none)
    except Exception:
        if fs.exists(target):
            return False
        raise
    finally:
        fs.delete(source, False)
    return True


# --- commits ---


def _commit_path(root: str, number: int) -> str:
    return f"{root}/commits/{number:020d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[:20]) for n in _names(spark, f"{root}/commits") if not n.startswith("."))


def _commit(spark: SparkSession, root: str, number: int) -> Commit:
    return Commit(**_read(spark, _commit_path(root, number)))


def latest(spark: SparkSession, root: str) -> Commit | None:
    """The newest commit of a table; None before the first."""
    numbers = _numbers(spark, root)
    return _commit(spark, root, numbers[-1]) if numbers else None


def generations(spark: SparkSession, root: str) -> DataFrame:
    """All published generations ``(generation, number, rows, newest, parts)``; none before the first."""
    if not _numbers(spark, root):
        return spark.createDataFrame([], STATS)
    return spark.read.schema(STATS).json(f"{root}/commits")


def retain_generations(gens: DataFrame, keep: int) -> DataFrame:
    """``gens(generation, number)`` with what becomes of each: the newest is current, the ``keep``
    before it are kept, the rest go.  There is a row for each time the table was published, so one task numbers them."""
    n = F.row_number().over(Window.orderBy(F.desc("number")))
    state = F.when(n == 1, "current").when(n <= keep + 1, "kept").otherwise("delete")
    return gens.select("generation", "number", state.alias("state"))


def batch_done(spark: SparkSession, root: str, writer: tuple[str, int]) -> bool:
    """Whether a batch ``(stream, batch id)`` is in the table, whoever else has written to it since."""
    last = latest(spark, root)
    return last is not None and last.ledger.get(writer[0], -1) >= writer[1]


def _parts(spark: SparkSession, root: str, generation: str) -> list[Part]:
    """The parts of a generation, one for each partition."""
    return [Part(**p) for p in _read(spark, f"{root}/parts/{generation}.json")]


# --- reading ---


def _schema(text: str) -> StructType:
    return StructType.fromJson(json.loads(text))


def _plain(v: object) -> object:
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v


def _meets(part: Part, between: Mapping[str, tuple]) -> bool:
    for column, (low, high) in between.items():
        if column not in part.low:
            continue
        if part.low[column] is None:  # nulls only
            return False
        if low is not None and part.high[column] < _plain(low) or high is not None and part.low[column] > _plain(high):
            return False
    return True


def _filled(df: DataFrame, schema: StructType, defaults: Mapping[str, object], *further: Column) -> DataFrame:
    """``df`` with the columns of ``schema``; those it was written without hold their defaults."""
    return df.select(*further, *[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name) for f in schema])


def _read_parts(spark: SparkSession, root: str, parts: Iterable[Part], schema: StructType, defaults: Mapping[str, object], layout: Layout | None = None) -> DataFrame:
    """The rows of some parts: one scan for all that were written with the same columns, or with a
    ``layout`` one for each, which are dealt alike."""
    if layout:
        # under another name than in the files: what Spark knows of a column's dealing outlives the union so
        each = [_filled(_bucketed(spark, root, p, layout), schema, defaults, F.col("__cluster").alias("__at")) for p in parts]
        return functools.reduce(DataFrame.unionByName, each) if each else spark.createDataFrame([], StructType([*schema.fields]).add("__at", LongType()))
    alike: dict[str, list[str]] = {}
    for p in parts:
        alike.setdefault(p.schema, []).append(f"{root}/{p.path}")
    out = None
    for kind, paths in alike.items():
        df = _filled(spark.read.schema(_schema(kind)).parquet(*paths), schema, defaults)
        out = df if out is None else out.unionByName(df)
    return spark.createDataFrame([], schema) if out is None else out


def current(spark: SparkSession, root: str, between: Mapping[str, tuple] | None = None) -> DataFrame | None:
    """The current generation, or None.  The commit is resolved once.

    ``between`` gives bounds (either may be None) for columns: rows outside them, and nulls, are left out, and
    of a table in parts only those folders are opened whose least and greatest values meet them."""
    last = latest(spark, root)
    return None if last is None else _read_commit(spark, root, last, between)


def _read_commit(spark: SparkSession, root: str, commit: Commit, between: Mapping[str, tuple] | None = None, layout: Layout | None = None) -> DataFrame:
    schema, between = _schema(commit.schema), between or {}
    parts = [p for p in _parts(spark, root, commit.generation) if _meets(p, between)]
    df = _read_parts(spark, root, parts, schema, commit.defaults, layout)
    for column, (low, high) in between.items():
        df = df.where(F.col(column).isNotNull())
        df = df if low is None else df.where(F.col(column) >= F.lit(low))
        df = df if high is None else df.where(F.col(column) <= F.lit(high))
    return df


def clustered(spark: SparkSession, root: str, between: Mapping[str, tuple] | None = None) -> tuple[DataFrame, Layout] | None:
    """The current generation of a table that is kept clustered, with its layout: as :func:`current`, but the
    frame carries ``__at`` and Spark knows how it is dealt.  None before the first generation."""
    last = latest(spark, root)
    if last is None:
        return None
    if not last.layout:
        raise ValueError(f"{root}: not kept clustered")
    return _read_commit(spark, root, last, between, last.clustering()), last.clustering()


def _table_name(path: str) -> str:
    """The name under which Spark knows the files of a part as bucketed."""
    return "tideline_" + "_".join(x.partition("=")[2] for x in path.split("/"))


def _bucketed(spark: SparkSession, root: str, part: Part, layout: Layout) -> DataFrame:
    """The rows of a clustered part.  Only tables of the catalog can be bucketed, so its folder is noted there
    as an external one; ``clean`` takes it out again."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(part.schema))
    place = f"{root}/{part.path}".replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_table_name(part.path)} ({columns}, __cluster BIGINT) USING parquet CLUSTERED BY (__cluster) INTO {layout.buckets} BUCKETS LOCATION '{place}'")
    return spark.table(_table_name(part.path))


# --- writing ---

WIDER = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _merged(old: StructType, new: StructType) -> StructType:
    """The columns of ``old`` and those that ``new`` adds.  A numeric column may become wider; any other
    change of a type is an error."""
    out = StructType()
    for f in old:
        kind = new[f.name].dataType if f.name in new.names else f.dataType
        if kind != f.dataType:
            a, b = f.dataType.simpleString(), kind.simpleString()
            if a not in WIDER or b not in WIDER:
                raise ValueError(f"column {f.name} can't change from {a} to {b}")
            kind = kind if WIDER.index(b) > WIDER.index(a) else f.dataType
        out.add(f.name, kind)
    for f in new:
        if f.name not in old.names:
            out.add(f.name, f.dataType)
    return out


def _zones(schema: StructType, date_col: str | None) -> list[str]:
    """Columns whose least and greatest values are kept for each part."""
    fits = lambda c: isinstance(schema[c].dataType, (DateType, StringType, IntegralType, TimestampType))
    return [c for c in dict.fromkeys(("date", "code", *([date_col] if date_col else []))) if c in schema.names and fits(c)]


def _measured(df: DataFrame, names: list[str], at: Column | None, zones: list[str], date_col: str | None, tally: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with figures taken while it is written: for each of the parts ``names`` (of which ``at`` gives a
    row's place) its rows and the bounds of zone columns, the newest date, and ``tally``."""
    newest = F.max(F.col(date_col).cast("date") if date_col else F.lit(None).cast("date"))
    found = [F.count(F.lit(1)).alias("rows"), newest.alias("newest")]
    for k in range(len(names)):
        here = F.lit(True) if at is None else at == k
        found.append(F.count_if(here).alias(f"rows_{k}"))
        for z in zones:
            found += [F.min(F.when(here, F.col(z))).alias(f"low_{k}_{z}"), F.max(F.when(here, F.col(z))).alias(f"high_{k}_{z}")]
    found += [c.alias(f"tally_{n}") for n, c in tally.items()]
    seen = Observation(uuid.uuid4().hex)
    return df.observe(seen, *found), seen


def _begin(spark: SparkSession, root: str) -> str:
    """A name for a new generation, noted as being built so that nobody collects its folder."""
    name = uuid.uuid4().hex
    _write(spark, f"{root}/intents/{name}.json", {"began": time.time()})
    return name


def _save(df: DataFrame, path: str, by: tuple[str, ...], layout: Layout | None) -> None:
    """Writes a generation's folder.  With a ``layout``, under which ``df`` is dealt, each bucket of each part
    is one file, sorted; the hash is taken from the rows themselves."""
    if layout is None:
        df.write.partitionBy(*by).parquet(path)
        return
    name = "tideline_" + uuid.uuid4().hex
    order = [c for c in ("code", "date") if c in df.columns]
    rows = df.drop("__at").withColumn("__cluster", layout.at())
    rows.write.partitionBy(*by).bucketBy(layout.buckets, "__cluster").sortBy("__cluster", *order).option("path", path).saveAsTable(name, format="parquet")
    df.sparkSession.sql(f"DROP TABLE {name}")  # the folder stays


def _abandon(spark: SparkSession, root: str, name: str) -> None:
    delete(spark, f"{root}/gen={name}")
    delete(spark, f"{root}/parts/{name}.json")
    delete(spark, f"{root}/intents/{name}.json")


def _finish(spark: SparkSession, root: str, commit: Commit, keep: int) -> Generation:
    delete(spark, f"{root}/intents/{commit.generation}.json")
    clean(spark, root, keep)
    out = Generation(commit.generation)
    out.number, out.rows, out.tally = commit.number, commit.rows, commit.tally
    out.newest = dt.date.fromisoformat(commit.newest) if commit.newest else None
    return out


def publish(
    df: DataFrame,
    root: str,
    keep: int = 2,
    date_col: str | None = None,
    gates: tuple[Callable[[DataFrame, DataFrame], DataFrame], ...] = (),
    partition_by: tuple[str, ...] = (),
    writer: tuple[str, int] | None = None,
    defaults: Mapping[str, object] | None = None,
    layout: Layout | None = None,
) -> Generation:
    """Writes ``df`` aside, runs the gates on (its stats, the current stats), commits, and deletes
    what is beyond ``keep`` previous generations.  The stats are measured while it is written.
    Without current stats to compare with, a warning says so.  If another writer commits meanwhile,
    this one fails with :class:`Conflict` and leaves nothing.  With a ``layout`` the table is kept clustered;
    rows that come from a table of that layout (with ``__at``) are written as they are dealt."""
    spark, last = df.sparkSession, latest(df.sparkSession, root)
    if layout and partition_by:
        raise ValueError("a clustered table is kept in parts by update")
    if layout and "__at" not in df.columns:
        df = layout.deal(df)
    kept = df.drop("__at") if layout else df
    name = _begin(spark, root)
    measured, seen = _measured(df, ["all"], None, _zones(kept.schema, date_col), date_col, {})
    _save(measured, f"{root}/gen={name}", partition_by, layout)
    stats = seen.get
    row = lambda rows, newest: [(root, rows, newest)]
    kind = "table string, rows bigint, newest date"
    now = spark.createDataFrame(row(stats["rows"], stats["newest"]), kind)
    was = spark.createDataFrame([] if last is None else row(last.rows, last.newest and dt.date.fromisoformat(last.newest)), kind)
    if gates and last is None:
        warnings.warn(f"{root}: no generation before, so nothing to compare with", stacklevel=2)
    for gate in gates:
        if found := gate(now, was).limit(5).collect():
            _abandon(spark, root, name)
            raise GateFailed(f"{root}: {found}")
    whole = _part_of(stats, 0, "", f"gen={name}", kept.schema, _zones(kept.schema, date_col))
    _write(spark, f"{root}/parts/{name}.json", [asdict(whole)])
    ledger = {**(last.ledger if last else {}), **({writer[0]: writer[1]} if writer else {})}
    commit = Commit((last.number if last else 0) + 1, name, stats["rows"], _plain(stats["newest"]), False, kept.schema.json(), {k: _plain(v) for k, v in (defaults or {}).items()}, ledger, layout=layout and asdict(layout))
    if not put_if_absent(spark, _commit_path(root, commit.number), asdict(commit)):
        _abandon(spark, root, name)
        other = _commit(spark, root, commit.number)
        raise Conflict(f"{root}: generation {other.generation} was published while {name} was built")
    return _finish(spark, root, commit, keep)


def _part_of(stats: Mapping, k: int, part: str, path: str, schema: StructType, zones: list[str]) -> Part:
    pick = lambda side: {z: _plain(stats[f"{side}_{k}_{z}"]) for z in zones}
    return Part(part, path, stats[f"rows_{k}"], schema.json(), pick("low"), pick("high"))


def update(
    new: DataFrame,
    root: str,
    part: Column,
    step: Callable[[DataFrame, DataFrame], DataFrame],
    keep: int = 2,
    date_col: str | None = None,
    writer: tuple[str, int] | None = None,
    defaults: Mapping[str, object] | None = None,
    tally: Mapping[str, Column] | None = None,
    attempts: int = 5,
    layout: Layout | None = None,
    in_place: bool = False,
) -> Generation | None:
    """Publishes a generation in which only the partitions that ``new`` touches are written anew.

    ``part`` gives a row's partition (such as a year, as text) in ``new`` and in the table alike.
    ``step(base, new)`` gets the touched partitions of the table and returns their next state; a row
    must stay in its partition.  The new generation names the folders of the others where they are,
    so what is read and written grows with the touched partitions and not with the table.  A null
    partition is one like any other.  The names of partitions are held on the driver: choose them as
    coarse as years or months.

    Columns that the step adds become columns of the table: parts that aren't touched are read with
    their ``defaults``, else with nulls, and stay where they are.  An empty ``new`` publishes the parts as
    they were.  ``tally`` are aggregates over what the step returns, in which columns that begin with two
    underscores serve only for them; the result carries their values, measured while writing.

    If others commit meanwhile and touched the same parts, the step runs again on what is there now, at
    most ``attempts`` times before :class:`Conflict`; if they touched others, both changes are kept.  With a
    ``writer`` (stream, batch id) the batch is noted in the commit, and None is returned if it is there already.

    With a ``layout`` a new table is kept clustered, and so it stays without naming it again: whatever a step
    returns is dealt that way.  A step that leaves rows where they are says so by ``in_place``: its ``base``
    carries ``__at`` as that of :func:`clustered`, and its state, carrying it too, is written without an exchange.
    """
    spark, new = new.sparkSession, new.drop("__at")
    text = F.coalesce(part.cast("string"), F.lit(""))
    fixed = {k: _plain(v) for k, v in (defaults or {}).items()}
    wanted = None
    for _ in range(attempts):
        last = latest(spark, root)
        if writer and last and last.ledger.get(writer[0], -1) >= writer[1]:
            return None
        fixed_now = {**(last.defaults if last else {}), **fixed}
        was = last.clustering() if last else None
        if layout and last and last.parts and layout != was:
            raise ValueError(f"{root}: kept as {was}, not as {layout}")
        kept_as = layout or was
        table = _schema(last.schema) if last else None
        held = {p.part: p for p in _parts(spark, root, last.generation)} if last and last.parts else {}
        if wanted is None:
            wanted = sorted(r["p"] for r in new.select(text.alias("p")).distinct().collect())
        if last and not last.parts:  # published whole before: all of it goes into parts
            base, touched = _read_commit(spark, root, last), None
            names = sorted({*wanted, *(r["p"] for r in base.select(text.alias("p")).distinct().collect())})
        else:
            names, touched = wanted, wanted
            base = _read_parts(spark, root, [held[p] for p in names if p in held], table, fixed_now, was if in_place else None) if last else spark.createDataFrame([], new.schema)
        name = _begin(spark, root)
        state = step(base, new)
        kept = [c for c in state.columns if not c.startswith("__")]
        own = state.select(*kept).schema
        schema = _merged(table, own) if table else own
        own = StructType([schema[c] for c in kept])
        zones = _zones(own, date_col)
        place = F.array_position(F.array(*map(F.lit, names)).cast("array<string>"), text) - 1
        place = F.when(place < 0, F.raise_error(F.concat(F.lit("a row left its partition for "), text)).cast("bigint")).otherwise(place)
        if kept_as and not (in_place and was and "__at" in state.columns):
            state = kept_as.deal(state)
        dealt = state.select(*[F.col(c).cast(schema[c].dataType).alias(c) if c in kept else F.col(c) for c in state.columns]).withColumn("__part", place)
        dealt, seen = _measured(dealt, names, F.col("__part"), zones, date_col if date_col in kept else None, tally or {})
        _save(dealt.select(*kept, "__part"), f"{root}/gen={name}", ("__part",), kept_as)
        stats = seen.get
        fresh = [_part_of(stats, k, p, f"gen={name}/__part={k}", own, zones) for k, p in enumerate(names)]
        fresh = [p for p in fresh if p.rows]
        counted = {n: stats[f"tally_{n}"] for n in tally or {}}
        done = _commit_parts(spark, root, name, last, fresh, touched, schema, fixed_now, date_col, writer, counted, kept_as)
        if done:
            return _finish(spark, root, done, keep)
        _abandon(spark, root, name)
    raise Conflict(f"{root}: parts {wanted} were written by others in {attempts} attempts")


def _commit_parts(spark, root, name, base, fresh, touched, schema, defaults, date_col, writer, tally, layout) -> Commit | None:
    """Commits parts built on ``base``, after whatever others have committed since to other parts; None
    if they touched the same ones, or the batch has been committed by another run."""
    last = base
    while True:
        held = _parts(spark, root, last.generation) if last and last.parts else []
        kept = [p for p in held if touched is not None and p.part not in touched]
        table = sorted(kept + fresh, key=lambda p: p.part)
        merged = _merged(_schema(last.schema), schema) if last else schema
        days = [str(p.high[date_col])[:10] for p in table if p.high.get(date_col)] if date_col else [last.newest] if last and last.newest else []
        ledger = {**(last.ledger if last else {}), **({writer[0]: writer[1]} if writer else {})}
        commit = Commit((last.number if last else 0) + 1, name, sum(p.rows for p in table), max(days, default=None), True, merged.json(), {**(last.defaults if last else {}), **defaults}, ledger, touched, tally, layout and asdict(layout))
        _write(spark, f"{root}/parts/{name}.json", [asdict(p) for p in table])
        if put_if_absent(spark, _commit_path(root, commit.number), asdict(commit)):
            return commit
        other = _commit(spark, root, commit.number)
        both = touched is None or other.touched is None or set(touched) & set(other.touched)
        if both or writer and other.ledger.get(writer[0], -1) >= writer[1]:
            return None
        last = other


def add_columns(spark: SparkSession, root: str, added: Mapping[str, tuple[str | DataType, object]], keep: int = 2, attempts: int = 5) -> Generation:
    """Adds columns ``{name: (type, default)}`` to a table without touching a folder: rows written before
    are read with the default, later ones with what they hold, null included."""
    for _ in range(attempts):
        last = latest(spark, root)
        if last is None:
            raise ValueError(f"{root}: nothing was published")
        schema = StructType(_schema(last.schema).fields)
        for column, (kind, _) in added.items():
            if column not in schema.names:
                schema.add(column, StructType.fromDDL(f"c {kind}")["c"].dataType if isinstance(kind, str) else kind)
        name = uuid.uuid4().hex
        _write(spark, f"{root}/parts/{name}.json", [asdict(p) for p in _parts(spark, root, last.generation)])
        commit = Commit(last.number + 1, name, last.rows, last.newest, last.parts, schema.json(), {**last.defaults, **{k: _plain(v) for k, (_, v) in added.items() if k not in last.defaults}}, last.ledger, [], layout=last.layout)
        if put_if_absent(spark, _commit_path(root, commit.number), asdict(commit)):
            return _finish(spark, root, commit, keep)
        delete(spark, f"{root}/parts/{name}.json")
    raise Conflict(f"{root}: others committed in {attempts} attempts")


def clean(spark: SparkSession, root: str, keep: int, grace: float = GRACE_SECONDS) -> list[str]:
    """Deletes the folders that no kept generation names, those of old generations and those that a
    killed writer has left.  What is being built stays for ``grace`` seconds after its intent was noted.
    Commits stay, so that no number is given twice.  Returns what was deleted."""
    # a folder is there after its intent, and an intent goes after its commit: listed in this order, none is missed
    folders = [n for n in _names(spark, root) if n.startswith("gen=")]
    lists = [n.removesuffix(".json") for n in _names(spark, f"{root}/parts") if not n.startswith(".")]
    building = set()
    for intent in (n for n in _names(spark, f"{root}/intents") if not n.startswith(".")):
        if not exists(spark, f"{root}/intents/{intent}"):  # committed just now
            building.add(intent.removesuffix(".json"))
        elif time.time() - _read(spark, f"{root}/intents/{intent}")["began"] <= grace:
            building.add(intent.removesuffix(".json"))
        else:
            delete(spark, f"{root}/intents/{intent}")
    commits = [_commit(spark, root, n) for n in _numbers(spark, root)[-keep - 1 :]]
    kept, clustered_too = {c.generation for c in commits}, any(c.layout for c in commits)
    used = {p.path for g in kept for p in _parts(spark, root, g)}
    gone = [f"parts/{g}.json" for g in lists if g not in kept | building]
    for folder in (f for f in folders if f not in used and f.removeprefix("gen=") not in building):
        inside = [f"{folder}/{n}" for n in _names(spark, f"{root}/{folder}") if n.startswith("__part=")]
        unused = [x for x in inside if x not in used]
        gone += [folder] if len(unused) == len(inside) else unused
    for path in gone:
        delete(spark, f"{root}/{path}")
        if clustered_too and path.startswith("gen="):
            noted = spark.sql(f"SHOW TABLES LIKE '{_table_name(path)}|{_table_name(path)}_*'").collect()
            for t in noted:
                spark.sql(f"DROP TABLE IF EXISTS {t.tableName}")
    return gone
