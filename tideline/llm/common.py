"""Helpers shared by the operators: shared folders, lineage cuts, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``.

    The setting is read from the session.  Where it is unset, a session on one machine gets a
    temporary folder; on a cluster, where that would scatter the data over its hosts, it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            base = held.get()
        elif spark.sparkContext.master.startswith("local"):
            base = "file://" + tempfile.mkdtemp(prefix="tideline-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that a lost executor costs no rerun
    of what lies before it."""
    shared_dir(df.sparkSession, "")
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again (columnar and compressed, so
    smaller than a checkpoint for wide rows)."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of ``batch`` whose texts in ``column`` total at most ``most`` bytes (or one row)."""
    at = batch.schema.get_field_index(column)
    sizes = pc.binary_length(batch.column(at)).fill_null(0).to_pylist()
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores before those that ``df`` has as columns (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def joined_on(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which is stored and has for each ``key`` one narrow row that counts, as
    ``n``, the rows of ``left`` with that key.  Keys with more than a thousandth of all those rows, of which there
    are at most a thousand, go to every task; so no key's rows meet in one."""
    often = F.col("n") * 1000 > (right.agg(F.sum("n")).first()[0] or 0)
    hot, rare = F.broadcast(right.where(often).drop("n")), right.where(~often).drop("n")
    # the rows of hot keys don't go through the exchange of the others
    others = left.join(F.broadcast(right.where(often).select(key)), key, "left_anti")
    return left.join(hot, key, how).unionByName(others.join(rare, key, how))


def components(edges: DataFrame, values: DataFrame | None = None) -> DataFrame:
    """Connected components of an undirected graph: ``edges(a, b)`` to ``(node, component)``.

    ``component`` is the smallest of the nodes' values in ``values(node, value)``, which names every
    node once, nulls not counted; without ``values`` it is the smallest node.  Every round each node
    moves to the neighbour (or itself) whose id has the least hash under that round's seed, and the
    graph is contracted.  About half of the nodes that still have edges vanish in a round, so there
    are about log2(n) rounds whatever the diameter; nothing is collected.  The least value goes
    along, and when no edge is left the moves are followed back, from the smallest graph to the
    largest: rows are dealt by node only, never by component, so that a giant component isn't one
    key.  Nodes without an edge do not appear.  Nulls and self loops are ignored.
    """
    edges = cut(
        edges.where("a is not null and b is not null and a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    least = nodes.select("node", F.col("node").alias("value")) if values is None else nodes.join(values, "node", "left").select("node", "value")
    moves: list[tuple[DataFrame, DataFrame]] = []
    while not edges.isEmpty():
        seed = len(moves) + 1
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(seed), c).alias("h"), c.alias("n"))
        hop = cut(
            both.groupBy("a")
            .agg(F.min(rank(F.col("b"))).alias("m"))
            .select(F.col("a").alias("node"), F.least("m", rank(F.col("a")))["n"].alias("new"))
        )
        least = cut(hop.join(least, "node").groupBy("new").agg(F.min("value").alias("value")).select(F.col("new").alias("node"), "value"))
        moves.append((hop, least))
        left = hop.select(F.col("node").alias("a"), F.col("new").alias("x"))
        right = hop.select(F.col("node").alias("b"), F.col("new").alias("y"))
        edges = cut(
            edges.join(left, "a")
            .join(right, "b")
            .where("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
    found = nodes.select("node", F.col("node").alias("component")) if values is None else least.select("node", F.col("value").alias("component"))
    for at, (hop, least) in reversed(list(enumerate(moves))):
        last = at == len(moves) - 1
        target = least.select("node", F.col("value").alias("component")) if last else least.join(found, "node", "left").select("node", F.coalesce("component", "value").alias("component"))
        found = hop.join(target.withColumnRenamed("node", "new"), "new").select("node", "component")
        if at % 4 == 3:
            found = cut(found)
    return found
