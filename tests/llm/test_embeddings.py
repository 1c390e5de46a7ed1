import numpy as np
from pyspark.sql import functions as F

from tideline.llm import embeddings as em


def brute(vectors, threshold=0.95):
    ok = [i for i, v in enumerate(vectors) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n = len(vectors)
    near = np.zeros((n, n), dtype=bool)
    for i in ok:
        for j in ok:
            if i != j and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], dtype=float), np.array(vectors[j], dtype=float)
                near[i, j] = (a / np.linalg.norm(a)) @ (b / np.linalg.norm(b)) >= threshold
    comp = np.arange(n)
    while True:
        new = np.array([min(comp[i], *comp[near[i]]) if near[i].any() else comp[i] for i in range(n)])
        if (new == comp).all():
            return {i: (int(near[i].sum()), int(comp[i])) for i in range(n)}
        comp = new


def test_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(300, 16))
    vectors = [*base]
    vectors += [b + rng.normal(scale=0.15, size=16) for b in base[:60]]
    center = rng.normal(size=16)
    vectors += [center + rng.normal(scale=0.12, size=16) for _ in range(150)]
    vectors += [base[5]] * 30 + [2 * base[6]]
    vectors = [np.float32(v).tolist() for v in vectors] + [None, [], [0.0] * 16, [float("nan")] * 16, [None, 1.0] * 8, [1.0, 2.0], [2.0, 4.0], [float("inf")] * 16]
    frame = spark.createDataFrame([(i, v, 0, i) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>, label int, node bigint")
    rows = em.embedding_groups(frame).collect()
    want = brute(vectors)
    assert len(rows) == len(vectors)
    hit = sum((r.n_links, r.component_id) == want[r.vec_id] for r in rows)
    assert all(r.n_links <= want[r.vec_id][0] and r.kept == (r.component_id == r.vec_id) for r in rows)
    assert hit >= 0.98 * len(rows)


def test_null_ids_and_empty_table(spark):
    frame = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0])], "vec_id bigint, embedding array<float>")
    assert sorted((str(r.vec_id), r.n_links, r.kept) for r in em.embedding_groups(frame).collect()) == [("1", 0, True), ("None", 0, False)]
    assert em.embedding_groups(frame.where("false")).count() == 0


def two_caps(rng, each=120, dim=24):
    """Two dense groups: cosines of about 0.99 within, of 0.95 to 0.97 across for some pairs."""
    a, b = np.linalg.qr(rng.normal(size=(dim, 2)))[0].T
    turned = 0.955 * a + np.sqrt(1 - 0.955**2) * b
    return np.float32([v + rng.normal(scale=0.008, size=dim) for v in [a] * each + [turned] * each])


def test_full_lists_do_not_hide_links_between_groups(spark):
    rng = np.random.default_rng(3)
    vectors = [v.tolist() for v in two_caps(rng)] + np.float32(rng.normal(size=(300, 24))).tolist()
    x = np.array(vectors[:240]) / np.linalg.norm(vectors[:240], axis=1, keepdims=True)
    s = x @ x.T
    assert (s[:120, 120:] >= 0.95).any() and np.sort(s[:120, :120], axis=1)[:, -82].min() > s[:120, 120:].max()
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in em.embedding_groups(frame).collect()}
    assert {i: got[i] for i in range(240)} == brute(vectors[:240])


def test_all_pairs_where_the_descent_fails(spark):
    rng = np.random.default_rng(4)
    vectors = np.float32([*two_caps(rng, 40), *rng.normal(size=(50, 24))]).tolist()
    unit = [(np.array(v, dtype=float) / np.linalg.norm(v)).tolist() for v in vectors]
    nodes = spark.createDataFrame(list(enumerate(unit)), "node bigint, full array<double>")
    none = spark.createDataFrame([], "node bigint, component bigint")
    got = {r.node: r.component for r in em._all_pairs(nodes, none, 0.95).collect()}
    assert got == {i: c for i, (n, c) in brute(vectors).items() if n}


def test_double_precision(spark):
    turn = np.arccos(0.95)
    pair = lambda e: [[1.0, 0.0], [float(np.cos(turn + e)), float(np.sin(turn + e))]]
    for e, linked in ((-1e-12, True), (1e-12, False)):
        frame = spark.createDataFrame(list(enumerate(pair(e))), "vec_id bigint, embedding array<double>")
        assert {(r.n_links, r.component_id) for r in em.embedding_groups(frame).collect()} == ({(1, 0)} if linked else {(0, 0), (0, 1)})


def test_only_saturated_lists_grow_and_the_rest_is_compared(spark, monkeypatch):
    monkeypatch.setattr(em, "SMALL", 20)
    monkeypatch.setattr(em, "TILE", 64)
    rng = np.random.default_rng(11)
    dense = [v.tolist() for v in two_caps(rng, 70)]  # lists of 40 are too short for one of these
    near = rng.normal(size=(40, 24))
    some = np.float32(np.concatenate([near + rng.normal(scale=0.1, size=near.shape) for _ in range(5)])).tolist()
    vectors = dense + some
    seen = []
    enlarged = em._enlarged

    def watched(*args, **more):
        out = enlarged(*args, **more)
        seen.append({r.node: (r.most, r.kth) for r in out.select("node", "most", "kth").collect()})
        return out

    monkeypatch.setattr(em, "_enlarged", watched)
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in em.embedding_groups(frame).collect()}
    want = brute(vectors)
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)
    most = [m for m, _ in seen[0].values()]
    assert min(most) == 10 and max(most) == em.WIDEST and sum(m == 10 for m in most) >= 150


def test_a_start_that_finds_nothing_is_audited_and_made_good(spark, monkeypatch):
    rng = np.random.default_rng(12)
    base = rng.normal(size=(120, 16))
    vectors = np.float32([*base, *(base + rng.normal(scale=0.1, size=base.shape))]).tolist()
    monkeypatch.setattr(em, "_compare", lambda rows, k, groups: rows.select("node", F.lit(0.0).cast("float").alias("sim"), F.col("node").alias("nbr")).where("false"))
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in em.embedding_groups(frame, k=40).collect()}
    assert got == brute(vectors)
