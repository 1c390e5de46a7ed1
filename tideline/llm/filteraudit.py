"""How quality filters interact: what each one removes in every order of application.

The failures of a document under five filters are a mask of five bits.  Counts by part and mask go
into a decision diagram for each part, whose nodes carry the counts of the documents below them.
Swapping adjacent levels takes the diagram from one order of filters to the next, through all 120;
along the path on which no filter fails, a node's weight is what is left and its failing branch is
what the next filter removes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stored

FILTERS = "ABCDE"
SCHEMA = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
Weight = tuple[int, int, int]


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, documents, good, toxic)``: counts of documents by source and failed filters.

    Bit 0 is A: under 200 words; 1 is B: fewer than half of the words distinct; 2 is C: over 2 % of the
    code points are A-Z; 3 is D: one of ``#$%&*|`` occurs; 4 is E: a smaller ``doc_id`` has the same
    text.  Only hashes of texts are shuffled.  A document is the first of its text if it has the
    least id of that text, which is looked up by (id, text), so copies never meet in one task.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.regexp_extract_all(F.col("t"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    capitals = F.length("t") - F.length(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = (
        F.size("w") < 200,
        100 * F.size(F.array_distinct("w")) < 50 * F.size("w"),
        100 * capitals > 2 * F.length("t"),
        F.col("t").rlike(r"[#$%&*|]"),
    )
    bits = sum((F.when(x, 1 << k).otherwise(0) for k, x in enumerate(fails)), F.lit(0))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("t")).withColumn("w", words)
    rows = stored(rows.select("doc_id", "part", bits.cast("int").alias("bits"), F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("key")), "audit")
    known, unknown = rows.where("doc_id is not null"), rows.where("doc_id is null")
    firsts = known.groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    yes = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").alias("good"), "toxic").groupBy("doc_id").agg(yes("good"), yes("toxic"))
    known = known.join(firsts, ["doc_id", "key"], "left").join(marks, "doc_id", "left")
    copy = F.when(F.col("first").isNull(), 1 << 4).otherwise(0)
    known = known.select("part", (F.col("bits") + copy).alias("mask"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    every = known.unionByName(unknown.select("part", F.col("bits").alias("mask"), F.lit(0).alias("good"), F.lit(0).alias("toxic")))
    return every.groupBy("part", "mask").agg(F.count("*").alias("documents"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


class Node:
    """A node of a diagram: ``weight`` counts the documents below it."""

    __slots__ = ("high", "low", "weight")

    def __init__(self, low: Node | None, high: Node | None, weight: Weight):
        self.low, self.high, self.weight = low, high, weight


def joined(unique: dict[tuple[int, int], Node], low: Node, high: Node) -> Node:
    """The node with these branches, made if there is none yet."""
    key = id(low), id(high)
    if key not in unique:
        unique[key] = Node(low, high, tuple(a + b for a, b in zip(low.weight, high.weight)))
    return unique[key]


class Diagram:
    """A count-weighted decision diagram of failure masks; every path visits every level.

    Equal subdiagrams of a level are one node.  ``order[i]`` is the filter that level ``i`` tests.
    """

    def __init__(self, counts: dict[int, Weight], filters: str = FILTERS):
        self.order = list(filters)
        leaves: dict[Weight, Node] = {}
        n = len(filters)
        below = []
        for path in range(1 << n):  # the first level is the highest bit of a path
            mask = sum(1 << k for k in range(n) if path >> (n - 1 - k) & 1)
            weight = counts.get(mask, (0, 0, 0))
            below.append(leaves.setdefault(weight, Node(None, None, weight)))
        self.levels: list[list[Node]] = []
        while len(below) > 1:
            unique: dict[tuple[int, int], Node] = {}
            below = [joined(unique, a, b) for a, b in zip(below[::2], below[1::2])]
            self.levels.insert(0, list(unique.values()))
        self.root = below[0]

    def swap(self, i: int) -> None:
        """Exchanges levels ``i`` and ``i + 1``.  Nodes of level ``i`` keep what they stand for, so that
        nothing above them changes; those below them are made anew."""
        unique: dict[tuple[int, int], Node] = {}
        for node in self.levels[i]:
            low, high = node.low, node.high
            node.low, node.high = joined(unique, low.low, high.low), joined(unique, low.high, high.high)
        self.levels[i + 1] = list(unique.values())
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def steps(self) -> Iterator[tuple[str, Node]]:
        """The filters in order, each with the node it is applied to, along the all-pass path."""
        node = self.root
        for f in self.order:
            yield f, node
            node = node.low


def plain_changes(n: int) -> list[int]:
    """Places ``i`` to swap with ``i + 1``, one after the other, so that each order of ``n`` things comes
    up once: the last thing sweeps through an order of the others, which then makes its next change."""
    if n < 2:
        return []
    out, at_front = list(range(n - 2, -1, -1)), True
    for i in plain_changes(n - 1):
        out.append(i + at_front)
        out += range(n - 1) if at_front else range(n - 2, -1, -1)
        at_front = not at_front
    return out


def interactions(counts: dict[int, Weight], filters: str = FILTERS) -> list[tuple]:
    """``(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``
    for each step of each order."""
    diagram = Diagram(counts, filters)
    rows = []
    fails, alone, shapley = {}, {}, dict.fromkeys(filters, 0)
    for change in [None, *plain_changes(len(filters))]:
        if change is not None:
            diagram.swap(change)
        for step, (f, node) in enumerate(diagram.steps(), 1):
            gone, good, toxic = node.high.weight
            rows.append(("".join(diagram.order), step, f, node.low.weight[0], gone, good, toxic))
            shapley[f] += gone
            if step == 1:
                fails[f] = gone
            if step == len(filters):
                alone[f] = gone
    return [(o, s, kept, gone, fails[f] - gone, alone[f], good, toxic, shapley[f]) for o, s, f, kept, gone, good, toxic in rows]


def _audit(rows: pd.DataFrame) -> pd.DataFrame:
    counts = {m: (n, g, t) for m, n, g, t in zip(*(rows[c].tolist() for c in ("mask", "documents", "good", "toxic")))}
    out = pd.DataFrame(interactions(counts), columns=["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"])
    out.insert(0, "part", rows["part"].iloc[0])
    return out


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per source, order of the five filters and step: what is kept after the step, removed by
    it, failing its filter but removed before, failing only its filter, removed with a good or a
    toxic label, and removed by the filter in all orders together.

    A part's diagram is made of at most 32 counts, however many documents it has, so no group
    grows.  A null text is empty, a null source the empty string.  A row without an id is a document
    that is nobody's copy, has no copies and no labels; repeated rows count each for itself, and of
    rows with one id none is a copy of another.  A document is good or toxic if any of its labels
    says so.  Empty tables give no rows.  Further columns make no difference.
    """
    return failures(docs, labels).groupBy("part").applyInPandas(_audit, SCHEMA)
