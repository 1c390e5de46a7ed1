"""The trie of conversation prefixes, built by halving depths.

Sequences of turns are cut at half their depth, again and again (a van Emde Boas recursion), and the
cut prefixes are named: a prefix of length d, cut at level k where 2**k is the largest power of two
that divides d, is named by a hash of the name of the prefix 2**k turns shorter and of the block of
turns between.  Blocks are hashed in pairs from below and prefixes are named from above, so upper
tries and all lower forests are made side by side, in as many rounds as the depth has halvings.
Totals are grafted upward along the same cuts: first those of a piece into its upper half, level by
level, then those of whole subtrees onto the nodes at which they were cut off.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import cut, stored

#: Halvings that are made within one row: a row holds up to 2**LEVELS turns of a conversation.
LEVELS = 10
#: The name of the textless root.
ROOT = bytes(16)
TOTALS = ("n_leaves", "saved_tokens")
PIECE = 1 << 20


def _hash(*parts: Column) -> Column:
    """The first half of SHA-256 of the parts' bytes."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def rebuilt(conversations: DataFrame, span: int = 1 << LEVELS) -> tuple[DataFrame, DataFrame]:
    """``convs(conv_id, total)`` and their turns ``(conv_id, at, unit, n_bytes, total)`` as the trie takes
    them: the first h turns of conversation c - c % 5, then the conversation's own after its first h.

    ``unit`` is a hash of role and text; texts aren't shuffled.  Turns are numbered in two levels, by
    ranges of ``span`` turn numbers and by the sizes of the ranges, so that a long conversation isn't
    sorted in one task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    unit = _hash(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    first = F.lit(-(1 << 62))
    turns = stored(
        conversations.where("conv_id is not null").select(
            F.col("conv_id").cast("bigint").alias("conv_id"),
            F.col("turn").cast("bigint").alias("turn"),
            F.coalesce(F.floor(F.col("turn") / span).cast("bigint"), first).alias("range"),
            unit.alias("unit"),
            F.octet_length(text).cast("bigint").alias("n_bytes"),
        ),
        "turns",
    )
    sizes = cut(turns.groupBy("conv_id", "range").agg(F.count("*").alias("n")))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    length = sizes.groupBy("conv_id").agg(F.sum("n").alias("length"))
    base = length.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    convs = length.select("conv_id", "length", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base")).join(base, "base", "left")
    head = F.least("h", F.coalesce("base_length", F.lit(0)))
    total = head + F.greatest(F.col("length") - F.col("h"), F.lit(0))
    convs = cut(convs.select("conv_id", "base", "h", head.alias("head"), total.alias("total")))
    ranges = sizes.select("conv_id", "range", before.alias("before")).join(convs.drop("base"), "conv_id")
    own = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy(F.asc_nulls_first("turn"), "unit")) - 1
    numbered = stored(turns.withColumn("own", own).join(ranges, ["conv_id", "range"]).withColumn("own", F.col("own") + F.col("before")).drop("turn", "range", "before"), "numbered")
    kept = numbered.where("own >= h").select("conv_id", (F.col("head") + F.col("own") - F.col("h")).alias("at"), "unit", "n_bytes", "total")
    heads = numbered.where("own < 8 and conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.col("own").alias("at"), "unit", "n_bytes")
    lent = convs.where("head > 0").join(heads, "base").where("at < head").select("conv_id", "at", "unit", "n_bytes", "total")
    return convs.select("conv_id", "total"), kept.unionByName(lent)


def named(turns: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``turns(conv_id, at, unit, ...)`` with ``name``, that of the prefix which ends with the turn, and
    ``ups``: the names of the prefixes 1, 2, 4, ... turns shorter, up to the largest power of two that
    divides the prefix's length.

    Up to 2**levels turns of a conversation share a row, in which all halvings of that depth are made.  Longer
    conversations are a sequence of such full rows, which are named in the same way, as turns of a
    trie of 1/2**levels of the depth.
    """
    width = 1 << levels
    rest = [c for c in turns.columns if c not in ("conv_id", "at", "unit")]
    blocks = turns.withColumn("block", F.shiftright("at", levels)).groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("at", "unit", *rest))).alias("u"))
    blocks = stored(blocks, "blocks")

    def halved(df: DataFrame) -> DataFrame:
        """With ``b0``, ``b1``, ...: hashes of the blocks of 1, 2, 4, ... turns that are whole."""
        df = df.withColumn("b0", F.transform("u", lambda x: x["unit"]))
        for k in range(levels):
            last = F.size(f"b{k}")
            lefts = F.filter(f"b{k}", lambda x, i: (i % 2 == 0) & (i + 1 < last))
            df = df.withColumn(f"b{k + 1}", F.transform(lefts, lambda x, i: _hash(x, F.get(f"b{k}", 2 * i + 1))))
        return df

    full = blocks.where(F.size("u") == width)
    if full.isEmpty():
        rooted = blocks.select("*", F.lit(ROOT).alias("root"), F.lit(None).cast("binary").alias("end"), F.array().cast("array<binary>").alias("further"))
    else:
        upper = named(halved(full).select("conv_id", F.col("block").alias("at"), F.element_at(f"b{levels}", 1).alias("unit")), levels)
        upper = cut(upper.select("conv_id", F.col("at").alias("block"), F.col("name").alias("end"), F.slice("ups", 2, 64).alias("further")))
        roots = upper.select("conv_id", (F.col("block") + 1).alias("block"), F.col("end").alias("root"))
        rooted = blocks.join(upper, ["conv_id", "block"], "left").join(roots, ["conv_id", "block"], "left")
        rooted = rooted.withColumns({"root": F.coalesce("root", F.lit(ROOT)), "further": F.coalesce("further", F.array().cast("array<binary>"))})
    # p_k: the names of the prefixes of 0, 2**k, 2 * 2**k, ... turns of the row
    df = halved(rooted).withColumn(f"p{levels}", F.when(F.size("u") == width, F.array("root", "end")).otherwise(F.array("root")))
    for k in reversed(range(levels)):
        above, block = f"p{k + 1}", f"b{k}"
        name = lambda i: F.when(i % 2 == 0, F.get(above, F.shiftright(i, 1))).otherwise(_hash(F.get(above, F.shiftright(i, 1)), F.get(block, i - 1)))  # noqa: B023, E731
        df = df.withColumn(f"p{k}", F.transform(F.sequence(F.lit(0), F.shiftright(F.size("u"), k)), name))
    df = df.select("conv_id", "p0", "further", F.posexplode("u").alias("i", "x")).withColumn("length", F.col("i") + 1)
    halvings = F.filter(F.array(*[F.lit(1 << k) for k in range(levels + 1)]), lambda s: F.col("length") % s == 0)
    near = F.transform(halvings, lambda s: F.element_at("p0", F.col("length") - s + 1))
    ups = F.when(F.col("length") == width, F.concat(near, F.col("further"))).otherwise(near)
    return df.select("conv_id", "x.*", F.element_at("p0", F.col("length") + 1).alias("name"), ups.alias("ups"))


def grafted(nodes: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """``(name, *sums)``: totals over all nodes below each of ``nodes(name, depth, ups, ...)``, the root
    among them, itself not counted.

    Upward, totals of pieces of depth 1, 2, 4, ...: each node gives the total of its piece to itself or, if
    a piece of twice the depth begins above it, to the node there.  Then from long pieces to short
    ones, the totals of whole subtrees go to the nodes at which their pieces were cut off.  A node is
    dealt once per level, on levels of half, a quarter, ... of the nodes.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    names = list(sums)
    total = [F.sum(c).alias(c) for c in names]
    zero = {c: F.lit(0).cast("bigint") for c in names}
    up = F.get("ups", F.lit(0))
    given = F.array(
        F.struct(F.col("name"), F.col("depth"), F.col("ups"), *[z.alias(c) for c, z in zero.items()]),
        F.struct(up.alias("name"), F.lit(None).cast("bigint").alias("depth"), F.lit(None).cast("array<binary>").alias("ups"), *[v.cast("bigint").alias(c) for c, v in sums.items()]),
    )
    level = nodes.select(F.explode(given).alias("g")).select("g.*").where("name is not null")
    pieces, k = [], 0
    while True:
        held = F.max(F.when(F.col("depth").isNotNull(), F.struct("depth", "ups"))).alias("at")
        level = cut(level.groupBy("name").agg(held, *total).select("name", "at.depth", "at.ups", *names))
        pieces.append(level)
        if 1 << k > deepest:
            break
        k += 1
        stays = F.col("depth") % (1 << k) == 0
        level = level.select(F.when(stays, F.col("name")).otherwise(F.get("ups", F.lit(k - 1))).alias("name"), F.when(stays, F.col("depth")).alias("depth"), F.when(stays, F.col("ups")).alias("ups"), *names)
    whole = pieces.pop()  # the root alone
    for k in reversed(range(len(pieces))):
        short = pieces[k].where(F.col("depth") % (1 << k + 1) != 0)
        below = whole.where("depth > 0").select(F.get("ups", F.lit(k)).alias("name"), F.lit(None).cast("bigint").alias("depth"), F.lit(None).cast("array<binary>").alias("ups"), *names)
        held = F.max(F.when(F.col("depth").isNotNull(), F.struct("depth", "ups"))).alias("at")
        found = short.unionByName(below).groupBy("name").agg(held, *total).select("name", "at.depth", "at.ups", *names)
        whole = whole.unionByName(cut(found))
    return whole.select("name", *names)


def ends_hashed(ends: DataFrame) -> DataFrame:
    """``ends(name, conv_id)`` to ``(name, ends_sha256)``: the hash of the ids in order, comma-joined.

    Sorted by ranges of (name, id), a large name runs through many tasks, each of which joins its own
    ids to strings.  What lies within a task is hashed there.  Only names at the edges of a task go on
    as strings of up to a megabyte, which are hashed in order, one at a time: a SHA-256 can't be
    computed in any other way, but this reads a few bytes for an id and holds one string.
    """
    kind = "name binary, at bigint, sha string, text binary"
    names = [c.split()[0] for c in kind.split(", ")]
    types = [pa.binary(), pa.int64(), pa.string(), pa.binary()]
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, list[int]]]:
        """Names in order with some of their ids."""
        for b in batches:
            who, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            i = 0
            while i < len(who):
                j = i
                while j < len(who) and who[j] == who[i]:
                    j += 1
                yield who[i], ids[i:j]
                i = j

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, at, text, edge, out = None, None, b"", True, []

        def close(last: bool) -> list[tuple]:
            if name is None:
                return []
            return [(name, at, None, text)] if edge or last else [(name, at, hashlib.sha256(text).hexdigest(), None)]

        for who, ids in runs(batches):
            if who != name:
                out += close(False)
                edge = name is None
                name, at, text = who, ids[0], b""
            elif len(text) > PIECE:  # a large name goes on in pieces
                out.append((name, at, None, text))
                at, text, edge = ids[0], b"", True
            text += (b"," if text else b"") + ",".join(map(str, ids)).encode()
            if len(out) >= 4096 or sum(len(x[3] or b"") for x in out) > PIECE:
                yield batch(out)
                out = []
        if out := out + close(True):
            yield batch(out)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for b in batches:
            out = []
            for who, text in zip(b.column(0).to_pylist(), b.column(3).to_pylist()):
                if who != name:
                    if state is not None:
                        out.append((name, None, state.hexdigest(), None))
                    name, state = who, hashlib.sha256(text)
                else:
                    state.update(b"," + text)
            if out:
                yield batch(out)
        if state is not None:
            yield batch([(name, None, state.hexdigest(), None)])

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = stored(ends.repartitionByRange(n, "name", "conv_id").sortWithinPartitions("name", "conv_id").mapInArrow(own, kind), "ends")
    second = first.where("text is not null").repartition("name").sortWithinPartitions("name", "at").mapInArrow(across, kind)
    return first.where("sha is not null").unionByName(second).select("name", F.col("sha").alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, from the textless root: smallest member,
    depth, parent's smallest member, members, children, leaves below (itself if it has no child),
    tokens saved below by storing it once, and a hash of the conversations that end there.

    ``c - c % 5`` takes the sign of c for the remainder, as SQL does: -3 goes with 0.
    Turns go by ``turn`` (null first); rows of one turn in the order of a hash of role and text, repeated rows
    are turns of their own.  Null roles and texts are empty.  Rows without a ``conv_id`` belong to no
    conversation.  An empty table has no root and gives no rows.  Further columns make no difference.
    """
    convs, turns = rebuilt(conversations, 1 << levels)
    turns = named(turns, levels).withColumn("depth", F.col("at") + 1)
    turns = stored(turns.select("conv_id", "depth", "name", "ups", "n_bytes", (F.col("depth") == F.col("total")).alias("ends")), "named")
    attributes = [F.min("conv_id").alias("conv_id"), F.any_value("depth").alias("depth"), F.any_value("ups").alias("ups"), F.any_value("n_bytes").alias("n_bytes"), F.count("*").alias("n_convs")]
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("name"), "conv_id", F.lit(0).cast("bigint").alias("depth"), F.array().cast("array<binary>").alias("ups"), F.lit(0).cast("bigint").alias("n_bytes"), "n_convs")
    nodes = turns.groupBy("name").agg(*attributes).unionByName(root)
    kids = turns.select(F.get("ups", F.lit(0)).alias("parent"), "name").distinct().groupBy("parent").agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids.withColumnRenamed("parent", "name"), "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("bigint"), "saved_tokens": (F.col("n_convs") - 1) * F.col("n_bytes")}), "nodes")
    below = grafted(nodes, {c: F.col(c) for c in TOTALS}).select("name", *[F.col(c).alias(f"{c}_below") for c in TOTALS])
    ends = turns.where("ends").select("name", "conv_id").unionByName(convs.where("total = 0").select(F.lit(ROOT).alias("name"), "conv_id"))
    out = nodes.join(below, "name", "left").join(ends_hashed(ends), "name", "left")
    # a parent of more than a thousandth of all nodes goes to where they are; there are at most a thousand
    count = nodes.count()
    parents = nodes.where("n_children > 0").select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), (F.col("n_children") * 1000 > count).alias("large"))
    out = out.withColumn("parent", F.get("ups", F.lit(0)))
    large = parents.where("large").select("parent", F.col("parent_conv_id").alias("large_parent"))
    out = out.join(F.broadcast(large), "parent", "left")
    out = out.withColumn("rare", F.when(F.col("large_parent").isNull(), F.coalesce("parent", "name")).otherwise(F.col("name")))
    out = out.join(parents.where("not large").select(F.col("parent").alias("rare"), F.col("parent_conv_id").alias("rare_parent")), "rare", "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("large_parent", "rare_parent"))
    return out.select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children",
        *[(F.col(c) + F.coalesce(f"{c}_below", F.lit(0))).alias(c) for c in TOTALS],
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
