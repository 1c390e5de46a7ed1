"""Embedding near-duplicates by NN-descent.

1. Equal vectors become one node with a number of copies.
2. A first neighbour graph comes from a few random-hyperplane tables: nodes of a bucket are
   compared, and each keeps its ``k`` nearest.
3. NN-descent: the neighbours and reverse neighbours of every node are joined and compared with
   each other, and closer ones replace those in the lists, until links stop turning up.
4. A list that holds nothing but links is saturated: it may be too short.  Such lists, and no
   others, are made four times as long, up to ``WIDEST``, and refilled by a round around their nodes.
5. Links (cosine at least the threshold, in double precision) give components.  Nodes whose lists
   hold nothing but links even so are compared, in double precision and in tiles of bounded size, with those
   of every other component that its angles don't rule out, and components that meet are joined;
   and within their component with all members, which yields counts and no pairs.  Members of
   components of at most ``SMALL`` nodes are all compared; the links of others are those in the
   lists.
6. Recall is audited against brute force over all rows, for a bounded sample of the nodes that
   have links and one of those that have none; below the aim, lists are doubled and the descent
   goes on, and where that doesn't help all nodes are compared like those of saturated lists.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tideline.llm.common import components, cut, stored

BUCKET = 64  # nodes in a bucket of a hyperplane table, about
BLOCK = 96  # most nodes that are joined around one center at once, about
TILE = 512  # nodes in a side of a tile, about
WIDEST = 40  # neighbours in the longest list
ROUNDS = 2  # most rounds that refill lists made longer
SMALL = 4 * TILE  # nodes of a component that are all compared with each other
AUDIT = 128  # nodes with links, and as many without, whose neighbours are searched by brute force
CENTERS = 2048  # components in a side of a tile of centers, about
SLACK = 1e-4  # of a cosine in single precision


def _matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def usable(embedding: Column) -> Column:
    """Whether a vector can link: not null, not zero, no null or non-finite component, and a norm
    that a double can hold."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate(embedding, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.coalesce(embedding.isNotNull() & ~bad & (norm > 0) & (norm < float("inf")), F.lit(False))


def _unit(embedding: Column) -> Column:
    norm = F.sqrt(F.aggregate(embedding, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.transform(embedding, lambda x: x.cast("double") / norm)


def _groups(count: int, per: int) -> int:
    return max(1, -(-count // per))


def _split(rows: DataFrame, center: str, member: str, most: int, seed: int) -> DataFrame:
    """``rows`` with centers of more than ``most`` members split by a hash of the member."""
    size = rows.groupBy(center).agg(F.count("*").alias("__n")).where(F.col("__n") > most)
    parts = F.coalesce(F.ceil(F.col("__n") / most), F.lit(1))
    part = F.pmod(F.xxhash64(member, F.lit(seed)), parts).cast("int")
    return rows.join(size, center, "left").withColumn("part", part).drop("__n")


def _tables(nodes: DataFrame, dim: int, bits: int, tables: int, seed: int) -> DataFrame:
    """``(center, node, unit)``: the bucket of each node in each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(seed).standard_normal((tables, dim, bits)).astype(np.float32)
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column("unit"), np.float32)
            for t in range(tables):
                code = ((x @ planes[t]) > 0) @ weights + (np.int64(t) << 40)
                yield pa.RecordBatch.from_arrays([pa.array(code), batch.column("node")], ["center", "node"])

    return nodes.select("node", "unit").mapInArrow(run, "center bigint, node bigint")


def _compare(rows: DataFrame, k: int, groups: int) -> DataFrame:
    """Local joins: ``rows(center, part, node, kth, unit)`` to candidates ``(node, sim, nbr)`` that
    beat the k-th neighbour a node has."""

    def run(table: pa.Table) -> pa.Table:
        center, part, node = (table.column(c).to_numpy() for c in ("center", "part", "node"))
        kth, x = table.column("kth").to_numpy(), _matrix(table.column("unit"), np.float32)
        order = np.lexsort((node, part, center))
        center, part, node, kth, x = center[order], part[order], node[order], kth[order], x[order]
        turn = np.flatnonzero((center[1:] != center[:-1]) | (part[1:] != part[:-1])) + 1
        own, sim, nbr = [], [], []
        for a, b in zip(np.append(0, turn), np.append(turn, len(node))):
            if b - a < 2:
                continue
            s = x[a:b] @ x[a:b].T
            s[node[a:b, None] == node[None, a:b]] = -3
            s[s <= kth[a:b, None]] = -3
            if b - a > k + 1:
                s[s < np.partition(s, -k, axis=1)[:, -k, None]] = -3
            i, j = np.nonzero(s > -3)
            own.append(node[a + i]), sim.append(s[i, j]), nbr.append(node[a + j])
        if not own:
            own, sim, nbr = [np.empty(0, np.int64)], [np.empty(0, np.float32)], [np.empty(0, np.int64)]
        return pa.table({"node": np.concatenate(own), "sim": np.concatenate(sim).astype(np.float32), "nbr": np.concatenate(nbr)})

    dealt = rows.withColumn("__g", F.pmod(F.xxhash64("center", "part"), F.lit(groups)))
    return dealt.groupBy("__g").applyInArrow(lambda t: run(t), "node bigint, sim float, nbr bigint")


def _lists(candidates: DataFrame, k: int, most: DataFrame | None = None) -> DataFrame:
    """``(node, nbrs, kth, most)``: the nearest different candidates of each node, at most ``most`` of
    them, which is ``k`` unless ``most(node, most)`` says otherwise."""
    once = candidates.groupBy("node", "nbr").agg(F.max("sim").alias("sim"))
    lists = once.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("sim", "nbr")), asc=False).alias("nbrs"))
    lists = lists.withColumn("most", F.lit(k)) if most is None else lists.join(most, "node", "left").withColumn("most", F.greatest(F.coalesce("most", F.lit(k)), F.lit(k)))
    lists = lists.withColumn("nbrs", F.slice("nbrs", F.lit(1), F.col("most")))
    kth = F.when(F.size("nbrs") < F.col("most"), F.lit(-2.0)).otherwise(F.element_at("nbrs", -1)["sim"])
    return lists.select("node", "nbrs", kth.cast("float").alias("kth"), "most")


def _edges(lists: DataFrame) -> DataFrame:
    return lists.select("node", F.explode("nbrs").alias("n")).select("node", "n.nbr", "n.sim")


def _round(nodes: DataFrame, lists: DataFrame, k: int, groups: int, seed: int, some: DataFrame | None = None, widest: int = 0, grown: bool = False) -> DataFrame:
    """One round of NN-descent, around all nodes or around those of ``some`` and their neighbours;
    ``grown`` says whether some lists are longer than ``k``."""
    e = _edges(lists).select("node", "nbr")
    around = e.select(F.col("node").alias("center"), F.col("nbr").alias("node")).union(e.select(F.col("nbr").alias("center"), "node"))
    around = around.union(nodes.select(F.col("node").alias("center"), "node")).distinct()
    if some is not None:
        near = e.join(some, "node", "left_semi").select(F.col("nbr").alias("center")).union(some.select(F.col("node").alias("center"))).distinct()
        around = around.join(near, "center", "left_semi")
    around = _split(around, "center", "node", BLOCK, seed)
    full = nodes.select("node", "unit").join(lists.select("node", "kth"), "node", "left").withColumn("kth", F.coalesce("kth", F.lit(-2.0).cast("float")))
    found = _compare(around.join(full, "node").select("center", "part", "node", "kth", "unit"), max(k, widest), groups)
    return _lists(found.unionByName(_edges(lists)), k, lists.select("node", "most") if grown else None)


def _enlarged(nodes: DataFrame, lists: DataFrame, k: int, groups: int, threshold: float) -> DataFrame:
    """``lists`` with the saturated ones made longer till they hold something else than links or are
    ``WIDEST`` long."""
    size = k
    while size < WIDEST:
        size = min(WIDEST, 4 * size)
        short = (F.col("kth") >= threshold - SLACK) & (F.col("most") < size)
        some = stored(lists.where(short).select("node"), "saturated")
        if some.isEmpty():
            break
        lists = lists.withColumns({"most": F.when(short, F.lit(size)).otherwise(F.col("most")), "kth": F.when(short, F.lit(-2.0).cast("float")).otherwise(F.col("kth"))})
        before = -1
        for turn in range(ROUNDS):
            lists = stored(_round(nodes, lists, k, groups, ROUNDS * size + turn, some, size, True), "lists")
            now = lists.join(some, "node", "left_semi").agg(F.sum(F.size(F.filter("nbrs", lambda x: x["sim"] >= threshold)))).first()[0] or 0
            if now <= before * 1.002:
                break
            before = now
    return lists


def _verified(links: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """``links(a, b, sim)`` found in single precision: those near the threshold are checked again in
    double precision."""
    sure = links.where(F.col("sim") >= threshold + SLACK).select("a", "b")
    unsure = links.where(F.col("sim").between(threshold - SLACK, threshold + SLACK))
    left, right = nodes.select(F.col("node").alias("a"), F.col("full").alias("x")), nodes.select(F.col("node").alias("b"), F.col("full").alias("y"))
    dot = F.aggregate(F.zip_with("x", "y", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return sure.union(unsure.join(left, "a").join(right, "b").where(dot >= threshold).select("a", "b"))


def _counts(members: DataFrame, threshold: float) -> DataFrame:
    """``members(component, node, full, copies, dim, size, heavy)`` to ``(node, links)``: how many
    vectors of its component, copies counted, each node of ``heavy`` links with, its own copies left
    out."""
    rows = members.withColumn("sides", F.ceil(F.col("size") / TILE).cast("int"))
    side = lambda seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col("sides")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("sides") - 1))
    held = ["component", "i", "j", "left", "node", "full", "copies", "dim"]
    left = rows.where("heavy").select("*", side(5).alias("i"), every.alias("j"), F.lit(True).alias("left")).select(held)
    right = rows.select("*", side(6).alias("j"), every.alias("i"), F.lit(False).alias("left")).select(held)
    # small components share a group, each tile of a large one is a group of its own
    groups = _groups(members.count(), TILE)
    tiles = left.union(right).withColumn("__g", F.pmod(F.xxhash64("component", "i", "j"), F.lit(groups * 8)))

    def run(table: pa.Table) -> pa.Table:
        comp, i, j, node, copies = (table.column(c).to_numpy() for c in ("component", "i", "j", "node", "copies"))
        first = table.column("left").to_numpy(zero_copy_only=False)
        x = _matrix(table.column("full"), np.float64)
        order = np.lexsort((node, ~first, j, i, comp))
        comp, i, j, first, node, copies, x = comp[order], i[order], j[order], first[order], node[order], copies[order], x[order]
        own, links = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a, b in _runs(comp, i, j):
            mid = a + int(first[a:b].sum())
            for at in range(a, mid, TILE):  # a tile may be larger than meant, its sides are hashed
                rows = np.arange(at, min(at + TILE, mid))
                near = (x[rows] @ x[mid:b].T >= threshold) & (node[rows, None] != node[None, mid:b])
                own.append(node[rows]), links.append(near @ copies[mid:b])
        return pa.table({"node": np.concatenate(own), "links": np.concatenate(links).astype(np.int64)})

    found = tiles.groupBy("dim", "__g").applyInArrow(lambda t: run(t), "node bigint, links bigint")
    return found.groupBy("node").agg(F.sum("links").alias("links"))


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows that agree in all ``columns``, which are sorted."""
    turn = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
    return list(zip(np.append(0, turn).tolist(), np.append(turn, len(columns[0])).tolist()))


def _near_components(centers: DataFrame, count: int, threshold: float) -> DataFrame:
    """``centers(component, center, radius)`` to the pairs ``(a, b)`` of components that may hold a
    link: their centers are no farther apart than both radii and a link's angle."""
    sides = _groups(count, CENTERS)
    reach = float(np.arccos(np.clip(threshold, -1, 1))) + 1e-6
    held = centers.withColumn("side", F.pmod(F.xxhash64("component", F.lit(7)), F.lit(sides)).cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(sides - 1))))
    tiles = held.select(F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "component", "center", "radius")

    def run(table: pa.Table) -> pa.Table:
        side, comp, radius = (table.column(c).to_numpy() for c in ("side", "component", "radius"))
        i, j, x = table.column("i")[0].as_py(), table.column("j")[0].as_py(), _matrix(table.column("center"), np.float64)
        left = np.flatnonzero(side == i)
        right = left if i == j else np.flatnonzero(side == j)
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for at in range(0, len(left), TILE):
            rows = left[at : at + TILE]
            most = np.minimum(radius[rows, None] + radius[None, right] + reach, np.pi)
            near = (x[rows] @ x[right].T >= np.cos(most) - 1e-9) & (comp[rows, None] != comp[None, right])
            if i == j:
                near &= comp[rows, None] < comp[None, right]
            p, q = np.nonzero(near)
            a.append(comp[rows[p]]), b.append(comp[right[q]])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return tiles.groupBy("i", "j").applyInArrow(lambda t: run(t), "a bigint, b bigint")


def _bridges(members: DataFrame, threshold: float) -> DataFrame:
    """``members(component, node, full)`` to the pairs ``(a, b)`` of components of which a member of
    one links with a member of the other, by exact comparison."""
    least = members.groupBy("component").agg(F.min(F.struct("node", "full")).alias("m"), F.count("*").alias("size"))
    least = stored(least.select("component", "size", F.col("m.full").alias("center")), "centers")
    count = least.count()
    dot = F.aggregate(F.zip_with("full", "center", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    far = members.join(least, "component").groupBy("component").agg(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.min(dot)))).alias("radius"))
    pairs = stored(_near_components(least.join(far, "component").select("component", "center", "radius"), count, threshold), "near")
    size = least.select("component", F.ceil(F.col("size") / TILE).cast("int").alias("n"))
    pairs = pairs.join(size.select(F.col("component").alias("a"), F.col("n").alias("m")), "a").join(size.select(F.col("component").alias("b"), "n"), "b")
    part = lambda n: F.pmod(F.xxhash64("node", F.lit(9)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    node = members.select("component", "node", "full")
    left = pairs.join(node.withColumnRenamed("component", "a"), "a").select("a", "b", part("m").alias("i"), every("n").alias("j"), F.lit(0).alias("side"), "full")
    right = pairs.join(node.withColumnRenamed("component", "b"), "b").select("a", "b", every("m").alias("i"), part("n").alias("j"), F.lit(1).alias("side"), "full")
    groups = _groups(members.count(), TILE) * 8
    tiles = left.union(right).withColumn("__g", F.pmod(F.xxhash64("a", "b", "i", "j"), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        a, b, i, j, side = (table.column(c).to_numpy() for c in ("a", "b", "i", "j", "side"))
        order = np.lexsort((side, j, i, b, a))
        a, b, i, j, side, x = a[order], b[order], i[order], j[order], side[order], _matrix(table.column("full"), np.float64)[order]
        met = []
        for lo, hi in _runs(a, b, i, j):
            mid = lo + int((side[lo:hi] == 0).sum())
            if any((x[at : min(at + TILE, mid)] @ x[mid:hi].T >= threshold).any() for at in range(lo, mid, TILE) if mid < hi):
                met.append(lo)
        return pa.table({"a": a[met], "b": b[met]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return tiles.groupBy("__g").applyInArrow(lambda t: run(t), "a bigint, b bigint").distinct()


def _joined(placed: DataFrame, met: DataFrame) -> DataFrame:
    """``placed(node, component)`` with the components that meet made one."""
    found = components(met).select(F.col("node").alias("component"), F.col("component").alias("into"))
    return cut(placed.join(found, "component", "left").select("node", F.coalesce("into", "component").alias("component")))


def _all_pairs(nodes: DataFrame, placed: DataFrame, threshold: float) -> DataFrame:
    """``placed`` with all links between all nodes of different components: exact, for data on which
    the descent fails."""
    every = cut(nodes.select("node").join(placed, "node", "left").select("node", F.coalesce("component", "node").alias("component")))
    every = _joined(every, _bridges(every.join(nodes.select("node", "full"), "node"), threshold))
    several = every.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    return cut(every.join(several, "component", "left_semi").select("node", "component"))


def _audit(nodes: DataFrame, placed: DataFrame, heavy: DataFrame, links: DataFrame, threshold: float) -> float:
    """The share of true links, of bounded samples of the nodes with and without links, that are
    found: both ends lie in one component, which is small, or the sampled node is compared with all of
    it, or the link is in a list.  1.0 if the samples have no true link: then none that was found can be
    missed by them, and of nodes without links the sample says that few can have one."""
    some = lambda rows: rows.select("node").orderBy(F.xxhash64("node", F.lit(11)), "node").limit(AUDIT)
    picked = some(placed).union(some(nodes.join(placed.select("node"), "node", "left_anti")))
    sample = nodes.select("node", "full").join(picked, "node").collect()
    ids, x = np.array([r["node"] for r in sample]), np.array([r["full"] for r in sample], dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, y = batch.column("node").to_numpy(), _matrix(batch.column("full"), np.float64)
            i, j = np.nonzero((y @ x.T >= threshold) & (node[:, None] != ids[None, :]))
            yield pa.RecordBatch.from_arrays([pa.array(ids[j]), pa.array(node[i])], ["a", "b"])

    true = nodes.select("node", "full").mapInArrow(run, "a bigint, b bigint")
    size = placed.groupBy("component").agg(F.count("*").alias("size"))
    mine = picked.join(placed, "node").join(size, "component").join(heavy.select("node", F.lit(True).alias("heavy")), "node", "left")
    mine = mine.select(F.col("node").alias("a"), F.col("component").alias("x"), (F.coalesce("heavy", F.lit(False)) | (F.col("size") <= SMALL)).alias("whole"))
    listed = links.join(picked.select(F.col("node").alias("a")), "a", "left_semi").select("a", "b", F.lit(True).alias("listed"))
    theirs = placed.select(F.col("node").alias("b"), F.col("component").alias("y"))
    seen = true.join(F.broadcast(mine), "a", "left").join(theirs, "b", "left").join(listed, ["a", "b"], "left")
    hit = (F.col("x") == F.col("y")) & (F.col("whole") | F.col("listed"))
    r = seen.agg(F.count("*").alias("n"), F.count_if(hit).alias("hit")).first()
    return r["hit"] / r["n"] if r["n"] else 1.0


def _search(nodes: DataFrame, dim: int, count: int, threshold: float, k: int, tables: int, rounds: int, aim: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Components ``(node, component)`` of the nodes that have links; the nodes of saturated lists;
    and the links ``(a, b)`` of the lists, each in both directions."""
    bits = max(1, min(36, int(np.ceil(np.log2(max(2, count / BUCKET))))))
    groups = _groups(count, 512)
    start = _split(_tables(nodes, dim, bits, tables, 3), "center", "node", 2 * BUCKET, 1)
    full = start.join(nodes.select("node", "unit"), "node").withColumn("kth", F.lit(-2.0).cast("float"))
    lists = stored(_lists(_compare(full, k, groups * 2), k), "lists")
    done, before, grown = 0, -1, False
    while True:
        while done < rounds:
            now = _edges(lists).where(F.col("sim") >= threshold).count()
            if done >= 2 and now <= before * 1.002:
                break
            before, done = now, done + 1
            lists = stored(_round(nodes, lists, k, groups, done, grown=grown), "lists")
        lists, grown = _enlarged(nodes, lists, k, groups, threshold), True
        found = _edges(lists).where(F.col("sim") >= threshold - SLACK)
        found = found.select(F.least("node", "nbr").alias("a"), F.greatest("node", "nbr").alias("b"), "sim").groupBy("a", "b").agg(F.max("sim").alias("sim"))
        once = stored(_verified(found, nodes, threshold), "links")
        placed = cut(components(once))
        links = once.union(once.select("b", "a"))
        # full or not, a list of nothing but links knows nothing of what lies beyond them
        heavy = stored(lists.where(F.element_at("nbrs", -1)["sim"] >= threshold - SLACK).select("node"), "saturated")
        if heavy.join(placed, "node").select("component").distinct().limit(2).count() > 1:
            full = heavy.join(placed, "node").join(nodes.select("node", "full"), "node")
            placed = _joined(placed, _bridges(stored(full.select("component", "node", "full"), "full"), threshold))
        if _audit(nodes, placed, heavy, links, threshold) >= aim:
            return placed, heavy, links
        if k >= 64:
            return _all_pairs(nodes, placed, threshold), nodes.select("node"), links
        k, rounds = 2 * k, done + 2
        before = -1


def embedding_groups(
    rows: DataFrame, threshold: float = 0.95, k: int = 10, tables: int = 6, rounds: int = 6, aim: float = 0.97
) -> DataFrame:
    """Per vector ``(vec_id, n_links, component_id, kept)``.

    Two vectors of the same dimension link if their cosine, in double precision, is at least
    ``threshold``.  ``n_links`` counts the other vectors it links with, ``component_id`` is the
    smallest vec_id that links reach, ``kept`` says whether that is its own.  Links are searched by
    NN-descent, one search for each dimension there is, so a few may be missed, but not because a list
    was full; none is reported below the threshold.  Vectors that are null, empty, zero, or hold null
    or non-finite components link with nothing, nor do rows without a vec_id, whose component is null
    and which aren't kept.  Repeated rows are vectors of their own, with one id.  Equal vectors are
    told by two 64-bit hashes.
    """
    kind = rows.schema["embedding"].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    base = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"))
    base = base.withColumn("fine", usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    one, two = F.xxhash64("embedding"), F.xxhash64(F.lit(1), "embedding")
    base = base.select("vec_id", F.when(F.col("fine"), one).alias("one"), F.when(F.col("fine"), two).alias("two"), "embedding")
    groups = base.where("one is not null").groupBy("one", "two").agg(F.first("embedding").alias("embedding"), F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    full = _unit(F.col("embedding"))
    # numbered as they are stored
    nodes = stored(groups.select(F.monotonically_increasing_id().alias("node"), "one", "two", "least", "copies", full.alias("full"), full.cast("array<float>").alias("unit"), F.size("embedding").alias("dim")), "nodes")
    searched = []
    sizes = nodes.groupBy("dim").agg(F.count("*").alias("nodes"), F.sum("copies").alias("rows")).orderBy("dim").collect()
    for r in sizes:
        if r["nodes"] > 1:
            own = nodes.where(F.col("dim") == r["dim"])
            searched.append(_search(own, r["dim"], r["nodes"], threshold, k, tables, rounds, aim))
    known = nodes.select("node", "one", "two", "least", "copies")
    if searched:
        placed, heavy, links = (reduce(DataFrame.union, x) for x in zip(*searched))
        size = placed.groupBy("component").agg(F.count("*").alias("size"))
        marked = placed.join(size, "component").join(heavy.select("node", F.lit(True).alias("h")), "node", "left")
        marked = cut(marked.select("node", "component", "size", (F.coalesce("h", F.lit(False)) | (F.col("size") <= SMALL)).alias("heavy")))
        some = marked.where("heavy").select("component").distinct()
        members = marked.join(some, "component", "left_semi").join(nodes.select("node", "full", "copies", "dim"), "node")
        listed = links.join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("listed"))
        least = placed.join(known, "node").groupBy("component").agg(F.min("least").alias("first"))
        more = marked.join(least, "component").join(_counts(members, threshold), "node", "left").join(listed, "node", "left")
        more = more.select("node", "first", F.when(F.col("heavy"), F.col("links")).otherwise(F.col("listed")).alias("links"))
        known = known.join(more, "node", "left")
    else:
        known = known.withColumns({"first": F.lit(None).cast("bigint"), "links": F.lit(None).cast("bigint")})
    known = stored(known.select("one", "two", "copies", F.coalesce("first", "least").alias("first"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n")), "known")
    # a vector that more than a thousandth of all rows hold is not dealt: there are at most a
    # thousand of them, which go to every task
    often = F.col("copies") * 1000 > sum(r["rows"] for r in sizes)
    hot, key = known.where(often).drop("copies"), ["one", "two"]
    own = base.select("vec_id", "one", "two")
    many = own.join(F.broadcast(hot), key)
    few = own.join(F.broadcast(hot.select(key)), key, "left_anti").join(known.where(~often).drop("copies"), key, "left")
    component = F.when(F.col("one").isNull(), F.col("vec_id")).otherwise(F.col("first"))
    return many.unionByName(few).select("vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
