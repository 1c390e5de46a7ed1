import itertools
import random
import re

from tideline.llm import filteraudit as fa

LABELS = "doc_id bigint, quality int, toxic int"
W = re.compile(r"[^\x20\x09-\x0D]+")


def masks(rows):
    """By brute force: the part and the failed filters of each (doc_id, text, source)."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, s in rows:
        text = t or ""
        w = W.findall(text)
        failed = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and i > first[text],
        }
        yield i, s or "", {k for k, v in failed.items() if v}


def expected(rows, labels):
    marked = {}
    for i, q, t in (x for x in labels if x[0] is not None):
        a, b = marked.get(i, (0, 0))
        marked[i] = (a or int(q == 1), b or int(t == 1))
    parts = {}
    for i, part, failed in masks(rows):
        parts.setdefault(part, []).append((failed, *marked.get(i, (0, 0))))
    out = {}
    for part, docs in parts.items():
        share = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                share[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in d[0] for d in docs) - len(gone), sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, o, s), v in out.items():
            if p == part:
                v.append(share[o[s - 1]])
    return out


def test_equals_brute_force(spark):
    rng = random.Random(1)
    vocabulary = [f"w{k}é" for k in range(400)]
    texts = [None, "", " \t\x0b", "A B c", "# " + "x " * 300]
    for _ in range(40):
        size, pool = rng.choice([3, 150, 250, 400]), rng.choice([vocabulary, vocabulary[:90]])
        words = [rng.choice(pool) for _ in range(size)]
        words = [w.upper() if rng.random() < rng.choice([0, 0, 0.2]) else w for w in words]
        texts.append(rng.choice([" ", "\n"]).join(words) + rng.choice(["", "", " 5%", "|"]))
    rows = [(rng.choice([None, *range(90)]), rng.choice(texts), rng.choice(["s", "t", None, ""])) for _ in range(200)]
    rows += [rows[0], rows[1], (7, texts[9], "s"), (7, texts[9], "t"), (7, texts[10], "s")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(60)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, source string, part string, first int")
    got = fa.filter_audit(docs, spark.createDataFrame([(*r, "x") for r in labels], LABELS + ", key string")).collect()
    want = expected(rows, labels)
    differ = [(k, list(r)[3:], want.get(k)) for r in got if list(r)[3:] != want.get(k := (r.part, r.filter_order, r.step))]
    assert not differ, differ[:3]
    assert len(got) == 3 * 600


def test_diagrams_and_orders():
    for n in range(1, 6):
        order, seen = list(range(n)), {tuple(range(n))}
        for i in fa.plain_changes(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            seen.add(tuple(order))
        assert len(seen) == len(fa.plain_changes(n)) + 1 == len(list(itertools.permutations(range(n))))
    rng = random.Random(2)
    counts = {m: (rng.randint(0, 2), 0, 0) for m in rng.sample(range(32), 20)}
    d = fa.Diagram(counts)
    for i in fa.plain_changes(5):
        d.swap(i)
        for mask in range(32):  # each mask still leads to its count, whatever the order
            node = d.root
            for f in d.order:
                node = node.high if mask >> "ABCDE".index(f) & 1 else node.low
            assert node.weight == counts.get(mask, (0, 0, 0))
        for level in d.levels:  # nodes of a level differ in a branch
            assert len({(id(x.low), id(x.high)) for x in level}) == len(level)
            assert all(x.weight[0] == x.low.weight[0] + x.high.weight[0] for x in level)
    assert len(fa.Diagram({}).levels[0]) == 1 and sum(map(len, fa.Diagram({}).levels)) == 5


def test_empty_tables(spark, docs_of):
    labels = spark.createDataFrame([], LABELS)
    assert fa.filter_audit(docs_of(["x"]).where("false"), labels).count() == 0
    rows = fa.filter_audit(docs_of(["x", "x", "a" * 200_000]), labels).collect()
    assert len(rows) == 600 and all(r.good_lost == r.toxic_lost == 0 for r in rows)
    assert {(r.kept, r.removed) for r in rows if r.filter_order == "EABCD" and r.step == 1} == {(2, 1)}
