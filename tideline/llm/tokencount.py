"""Token counts by a separator scan over flat token files.

Writing: each task tokenises its documents into one flat file of little-endian identifiers without
any index, every document followed by the end-of-document identifier.

Counting: the files are cut into blocks of equal size, whatever lies at the cuts.  Each block is
read as a range and searched for the separator in one vector operation.  What a block can't know -
how many separators stand before it and where the last of them is - comes from a prefix scan over
the blocks' summaries (a window of one small row per block); with it, the boundaries of all
documents are stitched, also of those that span blocks.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.common import shared_dir, slices, stored
from tideline.llm.warc import opened, read_range

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed values of that vocabulary: how it splits text, and the free identifier.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEPARATOR = 50256
TYPE = np.dtype("<u2")
BLOCK = 4 << 20  # bytes


@lru_cache(maxsize=2)
def encoder(path: str = RANKS) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_tokens(docs: DataFrame, root: str, path: str = RANKS, separator: int = SEPARATOR) -> DataFrame:
    """Tokenises ``docs`` into flat files below ``root``; returns which document stands where:
    ``(file, ordinal, doc_id)``, ordinals from 0.  Null texts count as empty."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, (store, base), name, out, ordinal = encoder(path), opened(root), f"{uuid.uuid4().hex}.bin", None, 0
        for batch in batches:
            for a, b in slices(batch, "text", 1 << 20):
                part = batch.slice(a, b - a)
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/.{name}", compression=None)
                for text in part.column("text").to_pylist():
                    out.write(np.array([*enc.encode_ordinary(text or ""), separator], dtype=TYPE).tobytes())
                n = len(part)
                yield pa.RecordBatch.from_arrays([pa.array([f"{root}/{name}"] * n), pa.array(np.arange(ordinal, ordinal + n)), part.column("doc_id")], ["file", "ordinal", "doc_id"])
                ordinal += n
        if out is not None:
            out.close()
            store.move(f"{base}/.{name}", f"{base}/{name}")

    return stored(texts.mapInArrow(run, "file string, ordinal bigint, doc_id bigint"), "documents")


def blocks_of(files: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(file, block, offset, size)``: the ranges into which the files named in ``files.file`` are
    cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for uri in batch.column(0).to_pylist():
                store, path = opened(uri)
                size = store.get_file_info(path).size
                rows += [(uri, k, at, min(block, size - at)) for k, at in enumerate(range(0, size, block))]
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], type=t) for t in types], ["file", "block", "offset", "size"])

    return files.mapInArrow(run, "file string, block bigint, offset bigint, size bigint")


def scan_blocks(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """Per block ``(file, block, n, last, at)``: how many separators, the position in the file of
    the last (null if none), and all their positions, counted in tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, k, offset, size in zip(*(batch.column(i).to_pylist() for i in range(4))):
                tokens = np.frombuffer(read_range(uri, offset, size), dtype=TYPE)
                at = np.flatnonzero(tokens == separator) + offset // TYPE.itemsize
                lists = pa.ListArray.from_arrays(pa.array([0, len(at)], type=pa.int32()), pa.array(at, type=pa.int64()))
                last = pa.array([int(at[-1]) if len(at) else None], type=pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([k]), pa.array([len(at)]), last, lists], ["file", "block", "n", "last", "at"])

    return blocks.mapInArrow(run, "file string, block bigint, n bigint, last bigint, at array<bigint>")


def count_tokens(files: DataFrame, separator: int = SEPARATOR, block: int = BLOCK) -> DataFrame:
    """Per document of the flat files named in ``files.file`` its tokens without the separator:
    ``(file, ordinal, start, n_tokens)``; ``start`` is the position of its first token.  Tokens
    after a file's last separator belong to no document.  ``block`` is in bytes and must hold whole
    tokens."""
    if block % TYPE.itemsize:
        raise ValueError("a block must hold whole tokens")
    cut = blocks_of(files, block)
    found = stored(scan_blocks(cut.repartition("file", "block"), separator), "separators")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.select("file", "block", "n", "last").select(
        "file",
        "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skipped"),
        F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(-1).cast("bigint")).alias("previous"),
    )
    placed = found.select("file", "block", "at").where(F.size("at") > 0).join(carried, ["file", "block"])
    starts = F.concat(F.array("previous"), F.slice("at", 1, F.size("at") - 1))
    each = placed.select("file", "skipped", F.posexplode(F.arrays_zip(starts.alias("before"), F.col("at").alias("end"))).alias("i", "cut"))
    start = F.col("cut.before") + 1
    return each.select("file", (F.col("skipped") + F.col("i")).alias("ordinal"), start.alias("start"), (F.col("cut.end") - start).alias("n_tokens"))


def token_counts(spark: SparkSession, docs: DataFrame, path: str = RANKS) -> DataFrame:
    """Per document ``(doc_id, n_tokens)``, tokenised into flat files in the shared folder and
    counted from them by the separator scan.  Empty and null texts have none.  Repeated rows each
    give a row.  An empty table gives an empty result."""
    root = shared_dir(spark, "tokens")
    written = write_tokens(docs, root, path)
    counts = count_tokens(written.select("file").distinct())
    return written.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")
