"""Line dedup across documents by a deletion-neighbourhood join.

Lines that become equal after deleting one character are within one edit of each other.  Every
line that can have a partner emits its variants as hashed keys, equal keys meet, the edit distance
is verified, and the earliest line is kept.

Keys carry the place of the deletion.  Two lines of equal length whose variants agree at the same
place differ there only, so all lines under such a key are within one edit of each other and only
the earliest matters; a line that equals the variant of a longer one meets it under a key of its
own.  Each key therefore yields minima, never pairs, and a bucket of any size is one aggregate.

Two steps come before.  Equal lines are reduced to their first place.  And of these only lines
that agree with another in two of three pieces can be one edit apart (pigeonhole), so the others
emit no variants, and a line emits only those whose deletion falls in the third piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import cut, joined_on, slices, stored, unused

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\r\x0b\x0c"
PIECES = 3
SPLIT = 2000  # lines that are verified against one line in a group
#: Where a line stands: ``own`` tells rows apart that repeat a doc_id with other texts.
PLACE = ("doc_id", "own", "line")
NEAR = ("near_doc_id", "near_own", "near_line")


def normal(line: Column) -> Column:
    """The form that is compared: A-Z lower-cased, blanks at the ends removed."""
    return F.trim(F.translate(line, UPPER, LOWER), F.lit(BLANKS))


def norms(text: str) -> list[bytes]:
    """The compared form of each line of a text; blank lines are empty."""
    return [x.lower().strip(BLANKS.encode()) for x in text.encode().split(b"\n")]


def piece_keys(norm: bytes) -> list[int]:
    """Keys of a line of n characters among lines of n, and as the longer line among those of
    n - 1: per piece the hash of what lies outside it."""
    line = norm if norm.isascii() else norm.decode()
    out = []
    for longer in (0, 1):
        n = len(line)
        size = n - longer
        for k in range(PIECES):
            head, tail = line[: size * k // PIECES], line[n - (size - size * (k + 1) // PIECES) :]
            whole = head + b"\n" + tail if isinstance(line, bytes) else f"{head}\n{tail}".encode()
            out.append(xxhash.xxh64_intdigest(whole, size * PIECES + k))
    return out


def _line_rows(least: int):
    """Rows ``(doc_id, own, line, h, g, keys)`` of the non-blank lines; h and g are the halves of a 128-bit
    hash.  ``keys`` is null for lines of fewer than ``least`` characters and for those that are in the
    batch already.  A row with line -1 holds a document's lines and blank lines as h and g."""
    names = ["doc_id", "own", "line", "h", "g", "keys"]

    def rows(part: pa.RecordBatch, seen: set[bytes]) -> pa.RecordBatch:
        doc, own, line, digest, keys = [], [], [], [], []
        for d, text, mark in zip(*(part.column(i).to_pylist() for i in range(3))):
            lines = [] if text is None else norms(text)
            full = 0
            for i, norm in enumerate(lines) if d is not None else ():
                if norm:
                    full += 1
                    x = xxhash.xxh3_128_digest(norm)
                    doc.append(d), own.append(mark), line.append(i), digest.append(x)
                    long = x not in seen and len(norm) >= least and (norm.isascii() or len(norm.decode()) >= least)
                    keys.append(piece_keys(norm) if long else None)
                    seen.add(x)
            blank = len(lines) - full if d is not None else sum(not x for x in lines)
            doc.append(d), own.append(mark), line.append(-1), digest.append(len(lines).to_bytes(8, "big") + blank.to_bytes(8, "big")), keys.append(None)
        halves = np.frombuffer(b"".join(digest), dtype=">i8").astype(np.int64).reshape(-1, 2)
        held = [k for k in keys if k is not None]
        flat = np.array(held, dtype=np.uint64).reshape(-1).view(np.int64)
        there = np.array([k is not None for k in keys], dtype=bool)
        offsets = pa.array(np.append(0, np.cumsum(there * 2 * PIECES)).astype(np.int32), mask=np.append(~there, False))
        lists = pa.ListArray.from_arrays(offsets, pa.array(flat))
        return pa.RecordBatch.from_arrays([pa.array(doc, type=pa.int64()), pa.array(own, type=pa.int64()), pa.array(line, type=pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), lists], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[bytes] = set()
            for a, b in slices(batch, "text", 1 << 22):
                yield rows(batch.slice(a, b - a), seen)

    return run


def _asked_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The compared form of the lines that emit variants."""
    for batch in batches:
        for a, b in slices(batch, "text", 1 << 22):
            part = batch.slice(a, b - a)
            out = []
            for d, mark, text, asked in zip(*(part.column(i).to_pylist() for i in range(4))):
                lines = norms(text)
                out += [(d, mark, x["line"], lines[x["line"]].decode(), x["h"], x["g"], x["asks"]) for x in asked if x["line"] < len(lines) and xxhash.xxh3_128_digest(lines[x["line"]]) == x["h"].to_bytes(8, "big", signed=True) + x["g"].to_bytes(8, "big", signed=True)]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = zip(*out) if out else [[] for _ in types]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], ["doc_id", "own", "line", "norm", "h", "g", "asks"])


P = (np.uint64(2147483647), np.uint64(2147483629))
B = (np.uint64(1000003), np.uint64(998244353))


def _powers(n: int, i: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(int(B[i]), done, int(P[i]))) % P[i]
        done += more
    return out


def variants(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a line with the character at each place deleted (one place beyond the end: none
    deleted), in O(n): a polynomial hash, of which the part after the place moves down by one."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    out = []
    for i in range(2):
        power = _powers(len(c), i)
        upto = np.concatenate([[np.uint64(0)], np.cumsum(c * power % P[i])])
        after = np.append((upto[-1] - upto[1:]) % P[i], np.uint64(0))
        out.append((upto + after * np.uint64(pow(int(B[i]), -1, int(P[i])))) % P[i])
    return out[0], out[1]


def _variant_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, role, doc_id, own, line): role 0 for lines of equal length, 1 for the longer
    and 2 for the shorter line of an insertion."""
    names = ["key", "role", *PLACE]
    for batch in batches:
        for a, b in slices(batch, "norm", 1 << 17):
            keys, roles, rows = [], [], []
            part = batch.slice(a, b - a)
            for r, (text, asks) in enumerate(zip(part.column("norm").to_pylist(), part.column("asks").to_pylist())):
                n = len(text)
                u, v = variants(text)
                for ask in asks:
                    longer, piece = divmod(ask, PIECES)
                    size = n - longer
                    lo, hi = size * piece // PIECES, size * (piece + 1) // PIECES + longer
                    at = np.arange(lo, hi, dtype=np.uint64)
                    body = (u[lo:hi] << np.uint64(31)) ^ v[lo:hi]
                    length = np.uint64(n - 1)
                    for role in (1,) if longer else (0, 2):
                        if role == 0:
                            key = (body * np.uint64(0x9E3779B97F4A7C15)) ^ ((at + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)) ^ length
                        elif role == 1:
                            key = (body * np.uint64(0xD6E8FEB86659FD93)) ^ length
                        else:
                            key = ((u[n:] << np.uint64(31)) ^ v[n:]) * np.uint64(0xD6E8FEB86659FD93) ^ np.uint64(n)
                        keys.append(key)
                        roles.append(np.full(len(key), role, dtype=np.int32))
                        rows.append(np.full(len(key), r, dtype=np.int64))
            if keys:
                key, role, row = map(np.concatenate, (keys, roles, rows))
                # a key that several pieces ask for is emitted once
                _, once = np.unique(np.stack([key.view(np.int64), role.astype(np.int64), row]), axis=1, return_index=True)
                take = pa.array(row[once])
                held = [part.column(x).take(take) for x in names[2:]]
                yield pa.RecordBatch.from_arrays([pa.array(key[once].view(np.int64)), pa.array(role[once]), *held], names)


def one_edit(a: str, b: str) -> bool:
    """Whether the edit distance is at most 1: what follows the first difference must agree."""
    if abs(len(a) - len(b)) > 1:
        return False
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:  # length of the common beginning
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return a[lo + (len(a) >= len(b)) :] == b[lo + (len(b) >= len(a)) :]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that are within one edit indeed."""
    for batch in batches:
        fine = [one_edit(a, b) for a, b in zip(batch.column("norm").to_pylist(), batch.column("near_norm").to_pylist())]
        yield batch.filter(pa.array(fine, type=pa.bool_())).select([*PLACE, *NEAR])


def _own(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), _own(F.col("text")).alias("own"))


def line_table(docs: DataFrame, least: int = 32) -> DataFrame:
    """The lines' hashes, computed once and stored: everything but the variants is made from them."""
    return stored(_texts(docs).mapInArrow(_line_rows(least), "doc_id bigint, own bigint, line int, h bigint, g bigint, keys array<bigint>"), "lines")


def line_verdicts(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """Per different line of ``docs``, whose :func:`line_table` is ``lines``, its first place and
    whether it stays: ``(h, g, doc_id, own, line, near_doc_id, near_own, near_line)``; the last
    three are null if it stays."""
    first = stored(
        lines.where("line >= 0")
        .select("h", "g", F.struct(*PLACE).alias("at"))
        .groupBy("h", "g")
        .agg(F.min("at").alias("at"))
        .select("h", "g", "at.*"),
        "first",
    )
    # a line asks for variants in a piece if another line agrees with it outside that piece; two
    # lines under a key are told by the ends of their hashes, however many it has
    keyed = lines.where("keys is not null").select("h", F.posexplode("keys").alias("ask", "key"))
    met = keyed.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b"), F.count("*").alias("n")).where("a != b").select("key", "n")
    asks = joined_on(keyed, stored(met, "met"), "key", "left_semi").groupBy("h").agg(F.collect_set("ask").alias("asks"))
    asked = asks.join(first, "h").groupBy("doc_id", "own").agg(F.collect_list(F.struct("line", "h", "g", "asks")).alias("asked"))
    source = _texts(docs).where("text is not null").join(asked, ["doc_id", "own"]).select("doc_id", "own", "text", "asked")
    texts = source.mapInArrow(_asked_rows, "doc_id bigint, own bigint, line int, norm string, h bigint, g bigint, asks array<int>")
    texts = stored(texts.dropDuplicates(list(PLACE)), "asked")
    # a line gives about as many rows as it has characters: dealt over all tasks before that
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.select(*PLACE, "norm", F.sort_array("asks").alias("asks")).repartition(tasks, *PLACE)
    rows = stored(rows.mapInArrow(_variant_rows, "key bigint, role int, doc_id bigint, own bigint, line int"), "variants")
    best = lambda *roles: F.min(F.when(F.col("role").isin(*roles), F.struct(*PLACE)))
    met = rows.groupBy("key").agg(F.count("*").alias("n"), F.count_if(F.col("role") == 0).alias("equal"), best(0).alias("same"), best(1).alias("long"), best(2).alias("short"))
    met = stored(met.where("equal > 1 or long is not null and short is not null").drop("equal"), "keys")
    other = F.when(F.col("role") == 0, F.col("same")).when(F.col("role") == 1, F.col("short")).otherwise(F.col("long"))
    earlier = joined_on(rows, met, "key").select(*PLACE, other.alias("near")).where("near < struct(doc_id, own, line)").distinct()
    earlier = stored(earlier.select(*PLACE, *(F.col("near")[c].alias(n) for c, n in zip(PLACE, NEAR))), "earlier")
    # verify; an early line that many others meet is split, its text going to each part
    many = stored(earlier.groupBy(*NEAR).agg(F.ceil(F.count("*") / SPLIT).cast("int").alias("parts")).where("parts > 1"), "many")
    parts = F.coalesce("parts", F.lit(1))
    mine = texts.select(*PLACE, "norm")
    theirs = texts.select(*(F.col(c).alias(n) for c, n in zip(PLACE, NEAR)), F.col("norm").alias("near_norm")).join(many, list(NEAR), "left")
    theirs = theirs.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    near = (
        earlier.join(many, list(NEAR), "left")
        .withColumn("part", F.pmod(F.xxhash64(*PLACE), parts).cast("int"))
        .drop("parts")
        .join(mine, list(PLACE))
        .join(theirs, [*NEAR, "part"])
        .select(*PLACE, *NEAR, "norm", "near_norm")
        .mapInArrow(_verify, "doc_id bigint, own bigint, line int, near_doc_id bigint, near_own bigint, near_line int")
        .groupBy(*PLACE)
        .agg(F.min(F.struct(*NEAR)).alias("near"))
        .select(*PLACE, "near.*")
    )
    return first.join(cut(near), list(PLACE), "left")


def line_counts(docs: DataFrame, least: int = 32) -> DataFrame:
    """Per document ``(doc_id, n_lines, n_blank, n_kept, n_near)``: its lines, blank ones, lines that
    stay (blank ones not counted), and first lines that go because an earlier one is one edit away.

    A non-blank line goes if an equal line stands earlier (by doc_id, then line number), or if it
    and an earlier line are one edit apart; the edit bound is one for lines of ``least`` characters
    or more and none for shorter ones, of which one edit makes another line.  Lines are
    compared with A-Z lower-cased and blanks at the ends removed; they end at a line feed.  A null
    text has no lines, an empty one has one blank line.  Rows without a doc_id keep all lines.
    Rows that repeat a doc_id with other texts are documents of their own, in the order of a hash of
    their text; rows that repeat doc_id and text are one document, each with its row, and keep the
    same lines.
    """
    lines = line_table(docs, least)
    verdicts = line_verdicts(docs, lines)
    per = verdicts.groupBy("doc_id", "own").agg(
        F.sum(F.when(F.col("near_doc_id").isNull(), 1).otherwise(0)).alias("kept"),
        F.sum(F.when(F.col("near_doc_id").isNotNull(), 1).otherwise(0)).alias("near"),
    )
    own = lines.where("line = -1").select("doc_id", "own", F.col("h").alias("n_lines"), F.col("g").alias("n_blank"))
    full = F.col("n_lines") - F.col("n_blank")
    kept = F.when(F.col("doc_id").isNull(), full).otherwise(F.coalesce("kept", F.lit(0)))
    return own.join(per, ["doc_id", "own"], "left").select(
        "doc_id", "n_lines", "n_blank", kept.cast("bigint").alias("n_kept"), F.coalesce("near", F.lit(0)).cast("bigint").alias("n_near")
    )


def dedup_lines(docs: DataFrame, least: int = 32) -> DataFrame:
    """``docs`` with the lines that :func:`line_counts` drops cut out of ``text``, blank lines kept,
    and ``n_chars``, if there is such a column, counted again.  No row is dropped: a document all of
    whose lines stand elsewhere keeps its blank lines or an empty text.  Null texts and rows without
    a doc_id stay as they are; further columns may have any names."""
    verdicts = line_verdicts(docs, line_table(docs, least)).where("near_doc_id is null")
    doc, own, kept = unused(docs, "doc", "own", "kept")
    keep = verdicts.groupBy("doc_id", "own").agg(F.collect_set("line").alias(kept)).withColumnsRenamed({"doc_id": doc, "own": own})
    joined = docs.join(keep, (docs["doc_id"] == keep[doc]) & (_own(docs["text"]) == keep[own]), "left")
    split = F.split(docs["text"].cast("string"), "\n", -1)
    stays = lambda x, i: (normal(x) == "") | F.coalesce(F.array_contains(keep[kept], i), F.lit(False))
    text = F.when(docs["doc_id"].isNull() | docs["text"].isNull(), docs["text"]).otherwise(
        F.array_join(F.filter(split, stays), "\n")
    )
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
