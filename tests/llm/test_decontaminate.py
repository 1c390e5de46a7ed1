import random

import numpy as np

from tideline.llm import decontaminate as dc

WORDS = "alpha bravo carbon delta ember fjord glacier harbor indigo jungle kernel lumen meadow nectar onyx pillar quartz river summit timber".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", ".", ","]) for _ in range(n))


def within(item, text, window=100, rate=0.08):
    """Brute force: some window of the item within its edit budget of some part of the text."""
    a, b = (list(dc.codes(x)) for x in (item, text))
    w = min(len(a), window)
    for s in range(len(a) - w + 1):
        row = [0] * (len(b) + 1)
        for i, x in enumerate(a[s : s + w], 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
            row = new
        if min(row) <= int(w * rate):
            return True
    return False


def test_scan_equals_brute_force():
    rng = random.Random(3)
    for trial in range(40):
        item = prose(rng, rng.choice([8, 14, 20]))
        text = list(item[rng.randint(0, 40) : len(item) - rng.randint(0, 40)])
        for _ in range(rng.randint(0, 14)):
            k = rng.randrange(max(1, len(text)))
            what = rng.randrange(3)
            if what == 0:
                text[k : k + 1] = []
            elif what == 1:
                text[k : k + 1] = ["#"]
            else:
                text.insert(k, "#")
        whole = prose(rng, 5) + " " + "".join(text) + " " + prose(rng, 5)
        ix = dc.build([(1, item)], 100, 0.08, 9)
        assert bool(dc.scan(ix, [whole])) == within(item, whole), trial


def spans(item, text, window=100, rate=0.08):
    """Brute force: the text positions that lie in some part which an item window matches within its
    budget, by the end positions of all such alignments."""
    a, b = (list(dc.codes(x)) for x in (item, text))
    w = min(len(a), window)
    held = np.zeros(len(b), dtype=bool)
    for s in range(len(a) - w + 1):
        row = np.zeros(len(b) + 1, dtype=int)
        for i, x in enumerate(a[s : s + w], 1):
            step = np.minimum(row[:-1] + (np.array(b) != x), row[1:] + 1)
            new = np.concatenate([[i], step])
            row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
        for t in np.flatnonzero(row <= int(w * rate)):
            held[max(0, t - w) : t] = True
    return held


def test_regions_are_whole():
    rng = random.Random(5)
    for trial in range(10):
        item = prose(rng, 45)
        middle = len(item) // 2
        body = item[:middle] + ["#", "", "##", "#" * 4, "#" * 30][trial % 5] + item[middle + 1 :]
        if trial % 3 == 2:
            body = item[: middle - 60] + item[middle + 60 :]
        whole = prose(rng, 9) + " | " + body + " | " + prose(rng, 9)
        ix = dc.build([(1, item)], 100, 0.08, 9)
        got, want = np.zeros(len(whole), dtype=bool), spans(item, whole)
        for _, _, s, t, i, j, e in dc.scan(ix, [whole]):
            got[s:t] = True
            assert 0 <= i < j <= len(item) and e <= 8
        # ends of regions may be off by the edits
        off = np.flatnonzero(got != want)
        ends = np.flatnonzero(np.diff(np.concatenate([[False], want, [False]]).astype(int)))
        assert all(np.abs(ends - x).min() <= 8 for x in off), (trial, off, ends)
        assert got[whole.index("| ") + 12 :][:150].all() and len(off) <= 4 * 8 and len(off) < 0.1 * len(body), (trial, len(off))


def test_short_items_and_long_ones(spark, docs_of):
    rng = random.Random(9)
    long = prose(rng, 400)
    bench = spark.createDataFrame([(1, "Yes"), (2, " x "), (3, "eleven char"), (4, long), (4, long)], "item_id bigint, text string")
    texts = ["yes", " YES\n", "yes it is", "x", "it says eleven char here", long[900:1900], ""]
    rows = dc.contamination(docs_of(texts), bench, block_chars=1600).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(0, 1), (1, 1), (3, 2), (4, 3), (5, 4)}
    for r in rows:
        if r.item_id == 4:
            assert abs(900 + r.start - r.item_start) <= 8 and abs(900 + r.end - r.item_end) <= 8
    held = {x for r in rows if r.item_id == 4 for x in range(r.start, r.end)}
    assert held == set(range(1000))


def test_rows_and_filter(spark, docs_of):
    rng = random.Random(8)
    items = [prose(rng, 30) for _ in range(4)]
    edited = items[1].replace("e", "o", 2)
    texts = [prose(rng, 40) + "\n" + items[0].upper() + " " + prose(rng, 9), prose(rng, 60), None, "", edited, items[2] * 2, "a" * 50_000]
    bench = spark.createDataFrame([*enumerate(items), (9, None), (10, ""), (11, "too short"), (0, items[0])], "item_id bigint, text string")
    docs = docs_of(texts)
    rows = dc.contamination(docs, bench).collect()
    assert sorted({(r.doc_id, r.item_id) for r in rows}) == [(0, 0), (4, 1), (5, 2)]
    r = next(r for r in rows if r.doc_id == 0)
    assert texts[0][r.start : r.end].lower() == items[0] and r.edits == 0
    assert sum(r.doc_id == 5 for r in rows) == 2
    blocks = dc.contamination(docs, bench, block_chars=150)  # several blocks give the same
    assert sorted({(r.doc_id, r.item_id) for r in blocks.collect()}) == [(0, 0), (4, 1), (5, 2)]
    left = dc.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 6]


def test_repetitive_texts_and_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([(1, "ab" * 200), (2, "a" * 120)], "item_id bigint, text string")
    rows = dc.contamination(docs_of(["ab" * 3000, "a" * 5000, "b" * 500]), bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(0, 1), (1, 2)}
    assert dc.contamination(docs_of(["x"]).where("false"), bench).count() == 0
    assert dc.contamination(docs_of(["x"]), bench.where("false")).count() == 0


def test_blocks_are_kept_in_the_shared_folder_and_documents_read_once(spark, docs_of, monkeypatch):
    monkeypatch.setattr(dc, "HELD", 3000)
    rng = random.Random(12)
    items = [prose(rng, 60) for _ in range(12)]
    bench = spark.createDataFrame([*enumerate(items), (None, prose(rng, 20))], "item_id bigint, text string")
    docs = docs_of([prose(rng, 30) + " " + items[i % 12][:200] + " " + prose(rng, 30) if i % 3 else prose(rng, 60) for i in range(60)])
    uris = dc.indexed(bench, 100, 0.08, 9, 900)
    assert len(uris) > 3 and all("benchmark-" in u for u in uris)
    one, many = (sorted(map(tuple, dc.contamination(docs, bench, block_chars=n).collect())) for n in (1 << 22, 900))
    assert {(r[0], r[1]) for r in one} == {(r[0], r[1]) for r in many} == {(i, i % 12) for i in range(60) if i % 3}
    plan = dc.contamination(docs, bench, block_chars=900)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert sorted(r.doc_id for r in dc.drop_contaminated(docs, bench, block_chars=900).collect()) == list(range(0, 60, 3))
