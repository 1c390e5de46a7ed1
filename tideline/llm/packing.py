"""Best-fit packing with several permitted sequence lengths.

Documents are cut into pieces no longer than the largest permitted length and packed, within
shards of bounded size, by best fit in descending order: a piece goes into the open bin that it
fills best.  If none has room, the bin size is opened whose cost by token that the remaining pieces
can put in it is least; a size costs its length and a part that grows with its square, as attention
does.  A shard for which prices as if every bin were filled come cheaper is packed by those.  At the
end each bin is downsized to the smallest permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stored

LENGTHS = (1024, 2048, 4096, 8192)
SHARD = 50_000  # pieces in a shard, about


def cost(length: int, square: int = 16_384) -> float:
    """Of a sequence: linear work and attention."""
    return length * (1 + length / square)


def fill(room: int, values: Sequence[int], counts: Sequence[int], upto: int) -> int:
    """Tokens that the first ``upto`` of the ascending ``values``, each there ``counts`` times, put
    into ``room``, largest first."""
    begin = room
    while (at := bisect_right(values, room, 0, upto) - 1) >= 0:
        room -= values[at] * min(counts[at], room // values[at])
        upto = at
    return begin - room


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS, fitted: bool = False, downsize: bool = True) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, and the length of each bin.  ``sizes`` must not exceed the
    largest length; pieces are taken in descending order, equal ones as they come, and of bins with
    equal room the one that was filled last.  A new bin is priced as if it were filled, with
    ``fitted`` by what the pieces that remain can put in it.  Without
    ``downsize`` bins keep the length they were opened with."""
    lengths = sorted(lengths)
    prices = [cost(c) for c in lengths]
    order = np.argsort(-np.asarray(sizes, dtype=np.int64), kind="stable")
    left = int(sum(sizes))
    counted = Counter(map(int, sizes)) if fitted else {}
    values = sorted(counted)
    counts = [counted[v] for v in values]
    last = len(values) - 1  # where the size of the piece in turn stands; larger ones are packed
    room: dict[int, list[int]] = {}  # bins by room
    rooms: list[int] = []  # the rooms there are, sorted
    used: list[int] = []
    size_of: list[int] = []
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for i in order.tolist():
        n = int(sizes[i])
        if fitted:
            while values[last] != n:
                last -= 1
            counts[last] -= 1
        at = bisect_left(rooms, n)
        if at < len(rooms):
            r = rooms[at]
            b = room[r].pop()
            if not room[r]:
                del room[r], rooms[at]
        else:
            fit = [k for k, c in enumerate(lengths) if c >= n]
            held = {k: n + fill(lengths[k] - n, values, counts, last + 1) if fitted else min(lengths[k], left) for k in fit}
            k = min(fit, key=lambda k: (prices[k] / held[k], lengths[k]))
            b, r = len(used), lengths[k]
            used.append(0)
            size_of.append(r)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        left -= n
        if r > n:
            if r - n not in room:
                room[r - n] = []
                insort(rooms, r - n)
            room[r - n].append(b)
    return bins, offsets, [lengths[bisect_left(lengths, u)] for u in used] if downsize else size_of


def pack_cheapest(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """:func:`pack` with the prices that give the bins of least total cost."""
    return min((pack(sizes, lengths, fitted) for fitted in (True, False)), key=lambda x: sum(map(cost, x[2])))


def byte_tokens(text: Column) -> Column:
    """Length of a text in byte-level tokens, with one for its end."""
    return F.coalesce(F.octet_length(text), F.lit(0)) + 1


SCHEMA = "doc_id bigint, copy bigint, piece int, start bigint, n_tokens bigint, bin_id bigint, bin_offset int, bin_length int"


def best_fit(docs: DataFrame, tokens: Column | None = None, lengths: Sequence[int] = LENGTHS, shard: int = SHARD) -> DataFrame:
    """Per piece ``(doc_id, copy, piece, start, n_tokens, bin_id, bin_offset, bin_length)``.

    A document of more tokens than the largest length gives several pieces, all but the last of
    that length; ``start`` counts its tokens from 0.  ``bin_id`` is unique over all shards,
    ``bin_offset`` the piece's place in its bin.  ``tokens`` is a column expression for the length,
    by default byte-level tokens with one for the end, so an empty or null text has one; rows
    whose length is null or below 1 count as 1.  Rows that repeat a doc_id and length are told
    apart by ``copy``.  Every piece is packed exactly once; a shard holds about ``shard`` pieces,
    whatever the table, and its rows don't depend on how the input is partitioned.
    """
    lengths = sorted({int(x) for x in lengths})
    if not lengths or lengths[0] < 1:
        raise ValueError("lengths must be positive")
    top = lengths[-1]
    n = F.greatest(F.coalesce((byte_tokens(F.col("text").cast("string")) if tokens is None else tokens).cast("bigint"), F.lit(1)), F.lit(1))
    counted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), n.alias("n")).groupBy("doc_id", "n").agg(F.count("*").alias("copies"))
    counted = stored(counted, "sizes")  # so that texts are read once
    total = counted.agg(F.sum(F.col("copies") * (F.floor((F.col("n") - 1) / top) + 1))).first()[0] or 0
    pieces = (
        counted.select("doc_id", "n", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select("doc_id", "n", "copy", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / top).cast("int"))).alias("piece"))
        .select(
            "doc_id",
            "copy",
            "piece",
            (F.col("piece").cast("bigint") * top).alias("start"),
            F.least(F.lit(top).cast("bigint"), F.col("n") - F.col("piece").cast("bigint") * top).alias("n_tokens"),
        )
    )
    shards = max(1, -(-total // shard))
    mixed = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "copy", "piece"), F.lit(shards)))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "doc_id", "copy", "piece"], ascending=[False, True, True, True], na_position="last", ignore_index=True)
        bins, offsets, sizes = pack_cheapest(rows["n_tokens"].tolist(), lengths)
        out = rows[["doc_id", "copy", "piece", "start", "n_tokens"]].copy()
        out["bin_id"] = np.array(bins, dtype=np.int64) * shards + int(key[0])
        out["bin_offset"] = np.array(offsets, dtype=np.int32)
        out["bin_length"] = np.array(sizes, dtype=np.int32)[bins]
        return out

    return mixed.groupBy("shard").applyInPandas(run, SCHEMA)


def bins(packed: DataFrame) -> DataFrame:
    """Per bin ``(bin_id, bin_length, used, pieces)``."""
    return packed.groupBy("bin_id", "bin_length").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("pieces"))
