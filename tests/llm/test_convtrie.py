import hashlib
import math
import random
import zlib

import pytest

from tideline.llm import convtrie as ct

KIND = "conv_id bigint, turn int, role string, text string"


def expected(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            key = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16]
            convs.setdefault(c, []).append(((turn is not None, turn or 0), key, (role or "", text or "")))
    own = {c: [x[2] for x in sorted(v)] for c, v in convs.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[x] for x in below) if below else 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[x] for x in below)
    digest = lambda p: hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children.get(p, [])), leaves[p], saved[p], digest(p)) for p, m in members.items())


def got(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in df.dtypes} == {"bigint", "string"}
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


def talk(rng, n, convs, roles=("user", "assistant", None), texts=("a", "bé", "", None, "long " * 9)):
    return [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(convs) for t in range(rng.randint(0, n))]


@pytest.mark.parametrize(("levels", "longest", "convs"), [(10, 9, 120), (1, 13, 60), (2, 40, 40)])
def test_equals_brute_force(spark, levels, longest, convs):
    """Few levels in a row make blocks of blocks of long conversations."""
    rng = random.Random(levels)
    rows = talk(rng, longest, convs, texts=("a", "a", "a", "a", "a", "a", "b", None))
    rows += [(c, t, "user", "same") for c in range(200, 260) for t in range(longest)]  # a large group of copies
    rows += [(c, t, "user", "same" if t < longest - 1 else str(c)) for c in range(300, 340) for t in range(longest)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND + ", name string, at int")
    assert got(ct.prefix_trie(df, levels)) == expected(rows)


def test_ties_nulls_and_long_conversations(spark):
    rng = random.Random(4)
    rows = talk(rng, 6, 30)
    rows += [(c, rng.choice([None, 1, 1, -5]), rng.choice(["user", None]), rng.choice(["x", "y" * 9999, None])) for c in range(40, 60) for _ in range(5)]
    rows += rows[:20] + [(None, 1, "user", "x"), (-3, 0, "user", "m"), (-5, 0, "user", "n"), (7_000_000_004, 0, None, None)]
    long = [("user", str(k % 7)) for k in range(3000)]
    rows += [(c, k, *x) for c, n in ((100, 3000), (101, 2500), (105, 2048)) for k, x in enumerate(long[:n])]
    assert got(ct.prefix_trie(spark.createDataFrame(rows, KIND))) == expected(rows)


def test_turnless_and_empty(spark):
    make = lambda rows: ct.prefix_trie(spark.createDataFrame(rows, KIND))
    assert make([]).count() == 0 and make([(None, 1, "user", "x")]).count() == 0
    short = [(c, 0, "user", "x") for c in range(1, 5)]  # conversation 0 isn't there
    assert got(make(short)) == expected(short)
    assert any(d == 0 and kids == 0 for _, d, _, _, kids, *_ in got(make([(c, 0, "user", "x") for c in (1,) if zlib.crc32(b"1") % 9])))


def test_ends_run_through_many_tasks(spark):
    ends = [(bytes([k]) * 16, c) for k, n in ((1, 1), (2, 5000), (3, 2), (4, 1)) for c in random.Random(k).sample(range(-9000, 9000), n)]
    df = spark.createDataFrame(ends, "name binary, conv_id bigint").repartition(7)
    held = ct.PIECE
    try:
        ct.PIECE = 64
        found = {bytes(r.name): r.ends_sha256 for r in ct.ends_hashed(df).collect()}
    finally:
        ct.PIECE = held
    want = {n: hashlib.sha256(",".join(map(str, sorted(c for m, c in ends if m == n))).encode()).hexdigest() for n in {n for n, _ in ends}}
    assert found == want
