"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are computed where the texts lie, by Arrow batches.  The trees are fitted in numpy
on a bounded sample of labelled rows (``sample`` rows at most, chosen by a hash of the id) and
flattened into arrays, which score a whole batch level by level.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATISTICS = (
    "log_bytes log_words word_mean word_sd upper digit mark symbol bar bang hash_like non_ascii control "
    "line_mean log_lines short_lines repeated_lines distinct_words commonest_word capitalised letterless punctuated longest_word"
).split()
_BYTES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "mark": b".,;:?'\"-()",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
    "bar": b"|",
    "bang": b"!",
    "hash_like": b"#$%&*",
    "non_ascii": bytes(range(128, 256)),
    "control": bytes(x for x in range(32) if x not in (9, 10, 13)),
}
_MASKS = np.array([[1.0 if x in set(v) else 0.0 for x in range(256)] for v in _BYTES.values()])


def statistics(text: bytes) -> list[float]:
    """The statistics of one text, in the order of STATISTICS; all finite, also for an empty one."""
    words, lines = text.split(), text.split(b"\n")
    n, w = max(1, len(text)), max(1, len(words))
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1, dtype=np.int64)
    shares = _MASKS @ np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) / n
    seen = Counter(words)
    full = [x for x in lines if x.strip()]
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        float(size.mean()),
        float(size.std()),
        *shares.tolist(),
        len(text) / len(lines),
        math.log1p(len(lines)),
        sum(len(x) < 30 for x in full) / max(1, len(full)),
        1 - len(set(full)) / max(1, len(full)),
        len(seen) / w,
        max(seen.values(), default=0) / w,
        sum(c for x, c in seen.items() if x[:1].isupper()) / w,
        sum(c for x, c in seen.items() if not x.isalpha() and x.isascii() and not any(65 <= y <= 90 or 97 <= y <= 122 for y in x)) / w,
        sum(c for x, c in seen.items() if x[-1] in b".,;:!?") / w,
        math.log1p(int(size.max())),
    ]


def _table(batch: pa.RecordBatch) -> np.ndarray:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    return np.array([statistics(t or b"") for t in texts], dtype=np.float64).reshape(len(texts), len(STATISTICS))


@dataclass
class Trees:
    """Complete binary trees of one depth, as arrays over (tree, node)."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), dtype=np.int64)
            while at.size and at[0] < inner:
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += leaf[at - inner] if len(at) else 0
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 48, rate: float = 0.12, ridge: float = 2.0, least: float = 5.0) -> Trees:
    """Boosted trees for the logistic loss.  Each level of a tree takes one histogram of gradients
    and curvatures over (node, feature, bin)."""
    inner, k = 2**depth - 1, x.shape[1]
    p = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    start = math.log(p / (1 - p))
    model = Trees(np.zeros((0, inner), dtype=np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), start)
    if len(y) == 0 or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    width = bins + 1
    cell = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    margin = np.full(len(y), start)
    columns = np.arange(k) * width
    fs, ts, leaves = [], [], []
    for _ in range(trees):
        prob = 1 / (1 + np.exp(-margin))
        g, h = y - prob, prob * (1 - prob)
        at = np.zeros(len(y), dtype=np.int64)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            slot = ((at - first)[:, None] * k * width + columns + cell).ravel()
            hist = [np.bincount(slot, np.repeat(v, k), nodes * k * width).reshape(nodes, k, width) for v in (g, h)]
            left_g, left_h = (np.cumsum(v, axis=2)[:, :, :-1] for v in hist)
            all_g, all_h = (v[:, :1].sum(axis=2, keepdims=True) for v in hist)
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - all_g**2 / (all_h + ridge)
            gain[(left_h < least) | (right_h < least)] = 0
            for n in range(nodes):
                j, b = divmod(int(gain[n].argmax()), width - 1)
                if gain[n, j, b] > 1e-9 and b < len(edges[j]):
                    feature[first + n], threshold[first + n] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > threshold[at])
        own = at - inner
        leaf = rate * np.bincount(own, g, inner + 1) / (np.bincount(own, h, inner + 1) + ridge)
        margin += leaf[own]
        fs.append(feature), ts.append(threshold), leaves.append(leaf)
    return Trees(np.array(fs), np.array(ts), np.array(leaves), start)


def held_out(doc_id, folds: int, fold: int):
    """Whether crc32 of the id as text leaves ``fold`` when divided by ``folds``; false for null."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == fold, F.lit(False))


def sampled(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, sample: int) -> DataFrame:
    """``(doc_id, text, y)`` of at most ``sample`` labelled documents outside the held-out fold.

    Ids are chosen by a hash, so the same ones are chosen whatever the partitions.  An id with
    several labels counts with its largest, and a document that is there twice counts once.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"), folds, fold))
        .groupBy(F.col("doc_id").cast("bigint").alias("__id"))
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(known), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "y")


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000, **how) -> Trees:
    """Trees fitted on at most ``sample`` labelled documents (documented bound); the driver sees
    their statistics only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.FixedSizeListArray.from_arrays(pa.array(_table(b).ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), x], ["doc_id", "y", "x"])

    rows = sampled(docs, labels, "quality", 4, 2, sample).mapInArrow(run, "doc_id bigint, y int, x array<double>").toPandas()
    rows = rows.sort_values("doc_id").drop_duplicates("doc_id")
    x = np.array(rows["x"].tolist(), dtype=np.float64).reshape(len(rows), len(STATISTICS))
    return fit(x, rows["y"].to_numpy(dtype=np.float64), **how)


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = 20_000, threshold: float = 0.7) -> DataFrame:
    """Per document ``(doc_id, held_out, score, predicted)``.

    Labels are read only outside the fold that crc32(doc_id) mod 4 = 2 holds out; the score depends
    on the text alone.  A null text counts as empty.  A null id is in no fold.  Without labels
    every score is 0.5; with labels of one class it is that class's share.  Repeated rows each get
    a row.
    """
    model = train(docs, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(_table(b)))], ["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(run, "doc_id bigint, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
