import random

import numpy as np

from tideline.llm import quality as ql


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    texts, labels = [], []
    for _ in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(20, 90))]
        texts.append(" ".join(words).capitalize() + "." if good else " | ".join(w.upper() + "!!" for w in words))
        labels.append(int(good))
    return texts, labels


def test_flattened_trees_equal_a_walk_and_learn():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    model = ql.fit(x, y, trees=30, depth=3)

    def walk(row):
        total = model.start
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > t[at] else 1)
            total += leaf[at - len(f)]
        return total

    assert np.allclose(model.margin(x[:50]), [walk(r) for r in x[:50]])
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.95


def test_statistics_are_finite_for_any_text():
    for text in ("", " \n\t", "é" * 9, "a" * 100_000, "\0\x01", "| |\n| |", "…", "..."):
        values = ql.statistics(text.encode())
        assert len(values) == len(ql.STATISTICS) and np.isfinite(values).all()


def test_held_out_accuracy_and_awkward_rows(spark, docs_of):
    texts, labels = corpus()
    docs = docs_of([*texts, None, "", texts[0]], [*range(len(texts)), 900, 901, None])
    marks = spark.createDataFrame([*((i, q, 0) for i, q in enumerate(labels)), (5, None, 0), (None, 1, 0), (7777, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = ql.quality_scores(docs, marks).collect()
    assert len(rows) == len(texts) + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    import zlib

    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in rows if r.held_out and r.doc_id < len(texts)]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_held_out_labels_and_other_columns_dont_matter(spark, docs_of):
    texts, labels = corpus(200)
    docs = docs_of(texts)
    marks = spark.createDataFrame([(i, q) for i, q in enumerate(labels)], "doc_id bigint, quality int")
    a = {r.doc_id: r.score for r in ql.quality_scores(docs, marks).collect()}
    from pyspark.sql import functions as F

    flipped = marks.withColumn("quality", F.when(ql.held_out(F.col("doc_id"), 4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
    b = {r.doc_id: r.score for r in ql.quality_scores(docs.withColumn("lang", F.lit("zz")), flipped).collect()}
    assert a == b


def test_no_labels_and_empty_table(spark, docs_of):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in ql.quality_scores(docs_of(["a", "b"]), none).collect()} == {0.5}
    assert ql.quality_scores(docs_of(["a"]).where("false"), none).count() == 0
