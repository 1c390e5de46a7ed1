import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.llm import simhash
from tideline.llm.common import components


def reach(ids, prints, bits=3):
    v = np.array([int(p, 16) for p in prints], dtype=np.uint64)
    near = np.bitwise_count(v[:, None] ^ v[None]) <= bits
    comp = np.array(ids)
    while True:
        new = np.array([comp[row].min() for row in near])
        if (new == comp).all():
            return dict(zip(ids, comp.tolist()))
        comp = new


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**23 - 1), st.integers(0, 22))
def test_a_neighbours_nearest_codeword_is_among_the_keys(x, bit):
    words, count = simhash.codewords(np.array([x, x ^ (1 << bit)]))
    assert words[1, 0] in words[0, : count[0]]


def test_links_equal_brute_force(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)]
    values = set(base)
    for x in base[:40]:
        for _ in range(6):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
            values.add(x)
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in values]
    found = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp bigint")).collect()}
    mask = (1 << 64) - 1
    assert found == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3}


def plain_fingerprint(text):
    """The contract's words, one shingle and one bit at a time."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c in upper else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=300, deadline=None)
@given(st.text("aBÄ é\t\n\x0b\x0c\r\x1c\x85\xa0\u2003", max_size=30))
def test_fingerprints_are_those_of_the_contract(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_components_of_paths_stars_and_values(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (7, 7), (None, 3)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    values = spark.createDataFrame([(i, None if i < 50 else 1000 - i) for i in range(300)], "node bigint, value bigint")
    got = {r.node: r.component for r in components(frame, values).collect()}
    assert got == {**{i: 940 for i in range(1, 61)}, **{i: 841 for i in range(100, 160)}, 200: 799, 201: 799}
    assert components(frame.where("false")).count() == 0 == components(frame.where("false"), values).count()


def test_groups_with_awkward_rows(spark, docs_of):
    texts = [None, "", "  \n", "one two", "ONE two", "a b c d e f g h", "a b c d e f g h", "naïve Äpfel " * 9, "x" * 300_000, None]
    rows = simhash.simhash_groups(docs_of(texts)).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    assert {got[i].fingerprint for i in (0, 1, 2, 9)} == {"0" * 16}
    assert got[9].component_id == 0 and got[4].component_id == 3 and got[6].component_id == 5
    ids = sorted(got)
    assert {i: got[i].component_id for i in ids} == reach(ids, [got[i].fingerprint for i in ids])


def test_keep_one_keeps_columns_null_ids_and_clean_rows(docs_of):
    docs = docs_of(["a b c d", "a b c d", "quite another text here", "zz"], [7, 3, 9, None])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 3), (False, 9), (True, None)]


def test_keep_one_judges_rows_that_repeat_an_id_by_their_texts(spark):
    rows = [(1, "a b c d", 0), (5, "a b c d", 1), (5, "quite another text here", 2), (5, "quite another text here", 3), (6, None, 4), (7, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, one int").withColumn("fp", F.lit("x")).withColumn("TWO", F.lit(2))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "a b c d"), (5, "quite another text here"), (6, None)]


def test_empty_table(docs_of):
    docs = docs_of(["a"]).where("false")
    assert simhash.simhash_groups(docs).count() == 0 and simhash.keep_one(docs).count() == 0


def jaccard(a, b, width=5):
    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x and y else 0.0


def test_keep_one_finds_texts_with_similar_shingles(spark, docs_of, monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT", 10)  # the leader of the large group is split
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [[word() for _ in range(rng.choice([3, 60, 250, 900]))] for _ in range(60)]
    base.append([word() for _ in range(400)])
    texts = [" ".join(b) for b in base]
    for b in base[:40]:
        copy = list(b)
        for k in rng.sample(range(len(b)), max(1, int(len(b) * rng.choice([0.005, 0.02, 0.03, 0.08])))):
            copy[k] = word()
        texts.append(" ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    for i in range(60):  # a large group of near copies of one text
        copy = list(base[-1])
        copy[i * 6] = word()
        texts.append(" ".join(copy))
    texts += ["", None, "one", "one"]
    n = len(texts)
    comp = list(range(n))
    prints = [simhash.fingerprint((t or "").encode()) for t in texts]

    def top(i):
        while comp[i] != i:
            i = comp[i]
        return i

    near = [(i, j) for j in range(n) for i in range(j) if (prints[i] ^ prints[j]).bit_count() <= 3 or jaccard(texts[i] or "", texts[j] or "") >= 0.8]
    for i, j in near:
        a, b = sorted((top(i), top(j)))
        comp[b] = a
    want = {i for i in range(n) if top(i) == i}
    assert {r.doc_id for r in simhash.keep_one(docs_of(texts)).collect()} == want
    far = sum((prints[i] ^ prints[j]).bit_count() > 3 for i, j in near)
    assert far > 10  # which three bits don't reach
    only = {r.doc_id for r in simhash.keep_one(docs_of(texts), similarity=None).collect()}
    assert want < only


@pytest.mark.parametrize(("tile", "share"), [(1 << 20, 0.1), (4000, 0.05), (1 << 20, 0.037)])
def test_no_link_is_lost_in_a_dense_group_of_strangers(spark, docs_of, monkeypatch, tile, share):
    """Pairs of similar texts whose similarity to all others is nearly as large, so that they share band keys
    with them; and a large class of near copies among these."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(int(1000 * share))
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    core = [word() for _ in range(400)]

    def changed(text, n):
        copy = list(text)
        for k in rng.sample(range(len(copy)), n):
            copy[k] = word()
        return copy

    texts = []
    for _ in range(60):
        one = changed(core, int(400 * share))
        texts += [" ".join(one), " ".join(changed(one, 8))]
    texts += [" ".join(changed(core, 1)) for _ in range(60)]
    sets = [set(simhash.shingle_set(t.encode(), 5).astype(np.uint32).tolist()) for t in texts]
    near = np.array([[len(x & y) >= 0.8 * len(x | y) for y in sets] for x in sets])
    assert near[:120, :120].sum() >= 220
    table = docs_of(texts).select("doc_id", "text", F.xxhash64("text").alias("one"), F.lit(0).cast("bigint").alias("two"))
    rows = simhash.cut(table.mapInArrow(simhash._sketches(5), "doc_id bigint, fp bigint, one bigint, two bigint, bands array<bigint>, shingles array<int>"))
    fp = {r.doc_id: r.fp for r in rows.select("doc_id", "fp").collect()}
    parent = {f: f for f in fp.values()}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    got = [tuple(r) for r in simhash.similar(rows, 0.8).collect()]
    back = {}
    for i, f in fp.items():
        back.setdefault(f, []).append(i)
    for x, y in got:
        assert any(near[i, j] for i in back[x] for j in back[y])
        parent[top(x)] = top(y)
    pairs = [(i, j) for i, j in zip(*np.nonzero(np.triu(near, 1)))]
    found = sum(top(fp[i]) == top(fp[j]) for i, j in pairs)
    assert found == len(pairs), (found, len(pairs))


def test_sets_are_compared_exactly():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.int32) for _ in range(60)]
    got = simhash.close(sets[:25], sets[25:], 0.4)
    for i, x in enumerate(sets[:25]):
        for j, y in enumerate(sets[25:]):
            assert got[i, j] == (len(np.intersect1d(x, y)) >= 0.4 * len(np.union1d(x, y)))
