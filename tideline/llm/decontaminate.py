"""Benchmark decontamination by the q-gram lemma.

A window of ``window`` characters of a benchmark item and a text region within ``e`` edits of it
share at least ``window + 1 - q * (e + 1)`` q-grams, and these lie on diagonals (text position
minus item position) that drift by at most ``e``.  So, per document:

1. the hashes of all its q-grams are looked up in a bitmap of the benchmark's q-grams, and only
   spans dense enough to hold that many shared q-grams go on;
2. there, shared q-grams are counted in overlapping diagonal bands, and regions that meet the
   bound are retained;
3. each region is verified by a banded alignment of every item window in it.

The first two steps lose nothing, the third decides.  The benchmark is indexed in blocks of bounded
size, each by a task of its own and kept in the shared folder.  A task reads its documents once and holds
one block at a time, so neither the driver nor a task grows with the benchmark.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import shared_dir, slices, stored

BASE = 0x9E3779B1
MIX = np.uint32(0x85EBCA77)
STEP = 32  # of the diagonal bands
FINE = 4  # length of the short q-grams
PIECE = 4096  # text positions that are banded at once
HELD = 64 << 20  # bytes of texts that a task holds while it goes through the blocks
SCHEMA = "doc_id bigint, item_id bigint, start bigint, end bigint, item_start bigint, item_end bigint, edits int"


def codes(text: str) -> np.ndarray:
    """Code points with A-Z lower-cased and every kind of white space made one space: positions
    stay those of ``text``."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    c[(c >= 65) & (c <= 90)] += 32
    c[((c >= 9) & (c <= 13)) | (c == 0xA0) | ((c >= 0x2000) & (c <= 0x200A)) | (c == 0x3000)] = 32
    return c


def grams(c: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all q-grams, by doubling.  Where two collide, a region is only verified in vain."""
    if len(c) < q:
        return np.empty(0, dtype=np.uint32)
    part, width = c, 1
    out: np.ndarray | None = None
    done = 0
    while True:
        if q & width:
            if out is None:
                out, done = part, width
            else:  # the hash of `width` more characters before those that are done
                n = len(c) - done - width + 1
                out, done = part[:n] * np.uint32(pow(BASE, done, 1 << 32)) + out[width : width + n], done + width
        if done == q:
            break
        n = len(c) - 2 * width + 1
        part = part[:n] * np.uint32(pow(BASE, width, 1 << 32)) + part[width : width + n]
        width *= 2
    return out[: len(c) - q + 1] * MIX


@dataclass
class Index:
    """A block of the benchmark: all items in one array, and where each q-gram occurs in it."""

    ids: list[int]
    offset: list[int]  # where a span begins in its item
    short: dict[bytes, list[int]]  # items too short for a q-gram
    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    window: np.ndarray
    edits: np.ndarray
    needs: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    places: np.ndarray
    bitmap: np.ndarray
    q: int

    @property
    def shift(self) -> np.uint64:
        return np.uint32(33 - len(self.bitmap).bit_length())


def bare(c: np.ndarray) -> bytes:
    """``codes`` without blanks at the ends."""
    full = np.flatnonzero(c != 32)
    return c[full[0] : full[-1] + 1].tobytes() if len(full) else b""


def build(items: list[tuple], window: int, rate: float, q: int) -> Index | None:
    """``items`` are (item id, text) or (item id, text, where the text begins in the item)."""
    cut = [(x[0], codes(x[1]), x[2] if len(x) > 2 else 0) for x in items]
    short: dict[bytes, list[int]] = {}
    for i, c, _ in cut:
        if len(c) < q and bare(c):
            short.setdefault(bare(c), []).append(i)
    kept = [x for x in cut if len(x[1]) >= q]
    if not kept and not short:
        return None
    if not kept:  # no q-gram at all
        none = np.empty(0, dtype=np.int64)
        return Index([], [], short, np.empty(0, dtype=np.uint32), none, none, none, none, none, np.empty(0, dtype=np.uint32), none, none, np.zeros(1 << 16, dtype=bool), q)
    offset, kept = [at for *_, at in kept], [(i, c) for i, c, _ in kept]
    size = np.array([len(c) for _, c in kept])
    end = np.cumsum(size)
    begin = end - size
    w = np.minimum(size, window)
    e = np.floor(w * rate).astype(np.int64)
    h = [grams(c, q) for _, c in kept]
    places = np.concatenate([b + np.arange(len(x)) for b, x in zip(begin, h)])
    h = np.concatenate(h)
    order = np.argsort(h, kind="stable")
    keys, first = np.unique(h[order], return_index=True)
    bits = max(16, min(26, len(keys).bit_length() + 5))
    bitmap = np.zeros(1 << bits, dtype=bool)
    bitmap[keys >> np.uint32(32 - bits)] = True
    needs = np.maximum(1, w + 1 - q * (e + 1))
    return Index([i for i, _ in kept], offset, short, np.concatenate([c for _, c in kept]), begin, end, w, e, needs, keys, np.append(first, len(h)), places[order], bitmap, q)


def align(item: np.ndarray, text: np.ndarray, starts: np.ndarray, width: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start, the least edits between ``item[start : start + width]`` and any part of
    ``text`` on diagonals ``low`` to ``high`` (text minus item position), and where it ends in the
    text.  All starts are aligned together, a row of the band at a time."""
    band = np.arange(high - low + 1, dtype=np.int16)
    best = np.zeros((len(starts), len(band)), dtype=np.int16)  # row 0: the region may begin anywhere
    skip = np.full_like(best, 1 << 12)
    # beyond its ends the text holds a code that equals nothing: a step there costs as much as a gap
    begin, end = int(starts[0]) + low, int(starts[-1]) + width + high + 1
    part = np.full(end - begin, 0xFFFFFFFF, dtype=np.uint32)
    a, b = max(0, begin), min(len(text), end)
    part[a - begin : b - begin] = text[a:b]
    view = np.lib.stride_tricks.sliding_window_view(part, len(band))
    own = starts - starts[0]
    for i in range(width):
        row = best + (view[own + i] != item[starts + i][:, None])
        skip[:, :-1] = best[:, 1:] + 1  # an item character without a text character
        np.minimum(row, skip, out=row)
        row -= band
        np.minimum.accumulate(row, axis=1, out=row)  # text characters without an item character
        row += band
        best = row
    to = best.argmin(axis=1)
    return best[np.arange(len(starts)), to].astype(np.int64), starts + width + low + to


def plausible(item: np.ndarray, text: np.ndarray, starts: np.ndarray, width: int, edits: int, low: int, high: int) -> np.ndarray:
    """The starts whose item window passes the q-gram lemma with short q-grams (q = 4), counted
    on the region's own diagonals: a cheap step before the alignment."""
    need = width + 1 - FINE * (edits + 1)
    if need <= 0:
        return starts
    a, b = int(starts[0]), int(starts[-1]) + width
    begin, end = max(0, a + low), min(len(text), b + high)
    mine, theirs = grams(item[a:b], FINE), grams(text[begin:end], FINE)
    held = np.zeros(len(mine), dtype=bool)
    for d in range(low, high + 1):
        i, j = max(0, begin - d - a), min(len(mine), begin + len(theirs) - d - a)
        if i < j:
            held[i:j] |= mine[i:j] == theirs[a + i + d - begin : a + j + d - begin]
    total = np.append(0, np.cumsum(held))
    at = starts - a
    return starts[total[at + width - FINE + 1] - total[at] >= need]


def verify(ix: Index, k: int, text: np.ndarray, p: np.ndarray, g: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """The contaminated parts of ``text`` around the q-grams at ``p`` shared with item ``k`` at
    ``g``: (start, end, item start, item end, edits of the best window).  All equal runs of a window
    or more count as they are; the windows that none of them holds are aligned."""
    w, e, item = int(ix.window[k]), int(ix.edits[k]), ix.text[ix.begin[k] : ix.end[k]]
    low, high = int((p - g).min()) - e, int((p - g).max()) + e
    first, last = max(0, int(g.min()) - w + ix.q), min(len(item) - w, int(g.max()))
    found, open_ = [], np.ones(max(0, last + 1 - first), dtype=bool)
    for d in np.unique(p - g):  # an alignment without edits stays on a diagonal
        lo, hi = max(0, first, -d), min(len(item), last + w, len(text) - d)
        same = np.concatenate([[False], item[lo:hi] == text[lo + d : hi + d], [False]])
        turn = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(turn[::2], turn[1::2]):
            if j - i >= w:
                a, b = lo + int(i), lo + int(j)
                found.append((int(a + d), int(b + d), a, b, 0))
                open_[max(0, a - first) : max(0, b - w + 1 - first)] = False
    starts = first + np.flatnonzero(open_)
    if len(starts):
        starts = plausible(item, text, starts, w, e, low, high)
    if len(starts):
        edits, ends = align(item, text, starts, w, low, high)
        good = edits <= e
        s, t, n = starts[good], ends[good], edits[good]
        turn = np.flatnonzero((np.diff(s) > 1) | (np.abs(np.diff(t)) > 2 * e + 1)) + 1
        for i, j in zip(np.append(0, turn), np.append(turn, len(s))):
            if i < j:
                found.append((max(0, int(t[i:j].min()) - w), min(len(text), int(t[i:j].max())), int(s[i]), int(s[j - 1]) + w, int(n[i:j].min())))
    return found


def regions(ix: Index, text: np.ndarray, p: np.ndarray, g: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item, text positions, item positions) of the shared q-grams of every region that meets the
    bound in some diagonal band."""
    k = np.searchsorted(ix.end, g, side="right")
    own = g - ix.begin[k]
    diag = p - own
    band = diag // STEP
    reach = int(ix.edits.max()) + 1
    over = diag - band * STEP < reach  # also counted in the band before
    k, own, p = np.concatenate([k, k[over]]), np.concatenate([own, own[over]]), np.concatenate([p, p[over]])
    band = np.concatenate([band, band[over] - 1])
    order = np.lexsort((p, band, k))
    k, own, p, band = k[order], own[order], p[order], band[order]
    new = np.append(True, (p[1:] != p[:-1]) | (band[1:] != band[:-1]) | (k[1:] != k[:-1]))
    k, own, p, band = k[new], own[new], p[new], band[new]  # a text position counts once
    cut = np.flatnonzero((k[1:] != k[:-1]) | (band[1:] != band[:-1])) + 1
    for a, b in zip(np.append(0, cut), np.append(cut, len(k))):
        n, which = int(ix.needs[k[a]]), int(k[a])
        if b - a < n:
            continue
        near = p[a + n - 1 : b] - p[a : b - n + 1] <= ix.window[which] - ix.q + ix.edits[which]
        hot = np.zeros(b - a, dtype=bool)
        for i in np.flatnonzero(near):
            hot[i : i + n] = True
        turn = np.flatnonzero(np.diff(np.concatenate([[False], hot, [False]]).astype(np.int8)))
        for i, j in zip(turn[::2], turn[1::2]):
            yield which, p[a + i : a + j], own[a + i : a + j]


def scan(ix: Index, texts: list[str]) -> list[tuple[int, int, int, int, int, int, int]]:
    """(text number, item number, start, end, item start, item end, edits) of every contaminated
    region.  The texts are hashed in one go, held apart by a NUL, which no shared q-gram spans."""
    whole = codes("\0".join(texts))
    out: list[tuple[int, int, int, int, int, int, int]] = []
    if not ix.ids:
        return out
    h = grams(whole, ix.q)
    at = np.flatnonzero(ix.bitmap[h >> ix.shift])
    need = int(ix.needs.min())
    if len(at) < need:
        return out
    # spans in which so many positions hold a shared q-gram
    reach = int((ix.window + ix.edits).max())
    near = np.flatnonzero(at[need - 1 :] - at[: len(at) - need + 1] <= reach - ix.q)
    mark = np.zeros(len(at) + 1, dtype=np.int32)
    np.add.at(mark, near, 1)
    np.add.at(mark, near + need, -1)
    at = at[np.cumsum(mark)[:-1] > 0]
    slot = np.minimum(np.searchsorted(ix.keys, h[at]), len(ix.keys) - 1)
    real = ix.keys[slot] == h[at]
    at, slot = at[real], slot[real]
    end = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
    of = np.searchsorted(end, at, side="right")
    for n in np.unique(of):
        a, b = np.searchsorted(of, [n, n + 1])
        if b - a >= need:
            begin = int(end[n]) - len(texts[n]) - 1
            out += [(int(n), *x) for x in scan_one(ix, whole[begin : end[n] - 1], at[a:b] - begin, slot[a:b], reach, need)]
    return out


def hits(ix: Index, texts: list[str]) -> list[tuple[int, int, int, int, int, int, int]]:
    """:func:`scan` with item ids in place of numbers and places counted in whole items, and the
    texts that are nothing but an item too short for a q-gram."""
    out = [(n, ix.ids[k], s, t, i + ix.offset[k], j + ix.offset[k], e) for n, k, s, t, i, j, e in scan(ix, texts)]
    if ix.short:
        for n, text in enumerate(texts):
            own = len(text.strip()) < ix.q and bare(codes(text))
            out += [(n, item, 0, len(text), 0, len(own) // 4, 0) for item in (ix.short.get(own, []) if own else [])]
    return out


def scan_one(ix: Index, text: np.ndarray, at: np.ndarray, slot: np.ndarray, reach: int, need: int) -> list[tuple[int, int, int, int, int, int]]:
    """The regions of one text, which shares at ``at`` the q-grams numbered ``slot``."""
    found: dict[int, list[tuple[int, int, int, int, int]]] = {}
    i = 0
    while i < len(at):  # pieces overlap, so that every region lies whole in one
        j = int(np.searchsorted(at, at[i] + PIECE + 2 * reach, side="right"))
        n = ix.first[slot[i:j] + 1] - ix.first[slot[i:j]]
        p = np.repeat(at[i:j], n)
        g = ix.places[np.repeat(ix.first[slot[i:j]] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        if len(p) >= need:
            for k, ps, gs in regions(ix, text, p, g):
                if not any(s <= ps[0] and ps[-1] + ix.q <= t for s, t, *_ in found.get(k, ())):
                    if hits := verify(ix, k, text, ps, gs):
                        found.setdefault(k, []).extend(hits)
        i = int(np.searchsorted(at, at[i] + PIECE, side="right"))
    return [(k, *x) for k, hits in found.items() for x in merged(hits)]


def merged(hits: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Overlapping regions as one."""
    out: list[list[int]] = []
    for s, t, a, b, e in sorted(hits):
        if out and s < out[-1][1]:
            o = out[-1]
            o[1], o[2], o[3], o[4] = max(o[1], t), min(o[2], a), max(o[3], b), min(o[4], e)
        else:
            out.append([s, t, a, b, e])
    return [tuple(x) for x in out]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 100, edit_rate: float = 0.08, q: int = 9, block_chars: int = 4_000_000) -> DataFrame:
    """One row per contaminated region: ``(doc_id, item_id, start, end, item_start, item_end, edits)``.

    A document is contaminated by an item if ``window`` consecutive characters of the item (the
    whole item if it is shorter) and some part of the text are within ``edit_rate * window`` edits
    of each other, where A-Z are lower-cased and all white space counts alike.  Offsets are in
    characters, ``end`` exclusive; a start may be off by as many characters as there are edits.
    Overlapping regions of an item are merged and carry the fewest edits of a window.  An item of
    fewer than ``q`` characters contaminates a text that is nothing else, blanks at the ends aside.
    Null and blank items and null or empty texts match nothing.  Equal rows of the benchmark count
    once; repeated documents each give their rows.  The benchmark goes to the executors in blocks of
    about ``block_chars`` characters; an item of more than a quarter of that is searched in spans
    that overlap by two windows, and a passage that runs over several gives a row for each.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    uris = indexed(benchmark, window, edit_rate, q, block_chars)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [pa.int64()] * 6 + [pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in held(batches, len(uris)):
            for uri in uris:
                ix = load(uri)
                for part in parts:
                    ids, own = part.column(0).to_pylist(), part.column(1).to_pylist()
                    if rows := [(ids[n], *x) for n, *x in hits(ix, own)]:
                        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names)

    return texts.mapInArrow(run, SCHEMA)


def indexed(benchmark: DataFrame, window: int, edit_rate: float, q: int, block_chars: int) -> list[str]:
    """Indexes the benchmark in blocks of about ``block_chars`` characters, each in one task, and gives the
    files in the shared folder that hold the indexes."""
    span = max(4 * window, block_chars // 4)
    step = span - 2 * window
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    last = F.greatest(F.lit(0), F.ceil((F.length("text") - span) / step)).cast("int")
    cut = items.select("item_id", "text", F.explode(F.sequence(F.lit(0), last)).alias("k")).select("item_id", (F.col("k") * step).alias("at"), F.substring("text", F.col("k") * step + 1, F.lit(span)).alias("text"))
    size = cut.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_chars))
    root = shared_dir(benchmark.sparkSession, "benchmark")

    def make(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("item_id", "at", "text"))), key=lambda r: (r[0] is not None, *(r if r[0] is not None else r[1:])))
        ix = build([(i, t, at) for i, at, t in rows], window, edit_rate, q)
        if ix is None:
            return pa.table({"uri": pa.array([], pa.string())})
        store, path = fs.FileSystem.from_uri(root)
        store.create_dir(path, recursive=True)
        name = uuid.uuid4().hex
        with store.open_output_stream(f"{path}/.{name}") as out:
            pickle.dump(ix, out, protocol=5)
        store.move(f"{path}/.{name}", f"{path}/{name}")
        return pa.table({"uri": pa.array([f"{root}/{name}"], pa.string())})

    made = cut.withColumn("block", F.pmod(F.xxhash64("item_id", "at", "text"), F.lit(blocks))).groupBy("block").applyInArrow(make, "uri string")
    return sorted(r["uri"] for r in stored(made, "blocks").collect())


_loaded: dict[str, Index] = {}


def load(uri: str) -> Index:
    """An index; a worker keeps the last one that it has used."""
    if uri not in _loaded:
        _loaded.clear()
        store, path = fs.FileSystem.from_uri(uri)
        with store.open_input_file(path) as f:
            _loaded[uri] = pickle.loads(f.read())
    return _loaded[uri]


def held(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices of the batches, as many at a time as go through all blocks together: about ``HELD`` bytes, or
    one slice if there is just one block."""
    parts, total = [], 0
    for batch in batches:
        for a, b in slices(batch, "text"):
            part = batch.slice(a, b - a)
            parts.append(part)
            total += part.nbytes
            if blocks < 2 or total >= HELD:
                yield parts
                parts, total = [], 0
    if parts:
        yield parts


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 100, edit_rate: float = 0.08, q: int = 9, block_chars: int = 4_000_000) -> DataFrame:
    """``docs`` without the rows whose text holds a contaminated region as :func:`contamination` finds
    them, decided where they lie.  Each row is judged by its own text, so repeated rows and ids, null
    ids and further columns make no difference; null and empty texts stay."""

    uris = indexed(benchmark, window, edit_rate, q, block_chars)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in held(batches, len(uris)):
            keep = [np.ones(len(part), dtype=bool) for part in parts]
            for uri in uris:
                ix = load(uri)
                for part, own in zip(parts, keep):
                    left = np.flatnonzero(own)
                    texts = part.column("text").take(pa.array(left)).to_pylist()
                    own[left[[n for n, *_ in hits(ix, [t or "" for t in texts])]]] = False
            for part, own in zip(parts, keep):
                yield part.filter(pa.array(own))

    return docs.mapInArrow(clean, docs.schema)
