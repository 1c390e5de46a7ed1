import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.llm import linededup as ld

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return max(len(a), len(b)) - i - j == 1


def brute(rows, least=32):
    """(doc_id, line) to True (stays) or False, by comparing all pairs of different lines."""
    first = {}
    for doc, text in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        for n, line in enumerate(text.split("\n")):
            norm = line.translate(UPPER).strip(" \t\r\x0b\x0c")
            if norm and norm not in first:
                first[norm] = (doc, n)
    gone = {a for a in first for b in first if len(a) >= least and len(b) >= least and first[b] < first[a] and near(a, b)}
    return {p: x not in gone for x, p in first.items()}


@settings(max_examples=150, deadline=None)
@given(st.text(min_size=1, max_size=40), st.data())
def test_variant_hashes_are_those_of_the_shorter_text(text, data):
    k = data.draw(st.integers(0, len(text) - 1))
    shorter = text[:k] + text[k + 1 :]
    u, v = ld.variants(text)
    x, y = ld.variants(shorter) if shorter else (np.zeros(1, np.uint64),) * 2
    assert (u[k], v[k]) == (x[-1], y[-1])


@given(st.text("ab", max_size=6), st.text("ab", max_size=6))
def test_one_edit(a, b):
    rows = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(rows[j - 1] + (x != y), rows[j] + 1, new[j - 1] + 1))
        rows = new
    assert ld.one_edit(a, b) == (rows[-1] <= 1)


def test_equals_brute_force(spark, docs_of):
    rng = random.Random(4)
    bases = ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice([10, 33, 34, 60, 200]))).strip() or "x" for _ in range(25)]
    texts = []
    for _ in range(80):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(line))
                line[k : k + 1] = rng.choice([[], ["z"], [line[k], "y"]])
                line = line or ["q"]
            lines.append("".join(line).upper() if rng.random() < 0.2 else " " * rng.randint(0, 2) + "".join(line))
        texts.append("\n".join(lines))
    rows = list(enumerate(texts))
    want = brute(rows)
    got = {(r.doc_id, r.line): r.near_doc_id is None for r in ld.line_verdicts(docs_of(texts), ld.line_table(docs_of(texts))).collect()}
    assert got == want and False in want.values()
    kept = Counter(doc for (doc, _), stays in want.items() if stays)
    assert {r.doc_id: r.n_kept for r in ld.line_counts(docs_of(texts)).collect()} == {i: kept[i] for i in range(len(texts))}
    out = {r.doc_id: r for r in ld.dedup_lines(docs_of(texts)).collect()}
    for doc, text in rows:
        lines = [x for n, x in enumerate(text.split("\n")) if not x.strip(" ") or want.get((doc, n))]
        assert out[doc].text == "\n".join(lines) and out[doc].n_chars == len(out[doc].text)


def test_rows_that_repeat_an_id_with_other_texts_and_clashing_columns(spark):
    a, b, c = ("line %s of a document that is longer than thirty-two characters" % x for x in ("number one", "number two", "number 3"))
    rows = [(1, a + "\n" + b), (5, a + "\n" + c), (5, b + "\n" + c), (5, c + "\nhere"), (5, c + "\nhere"), (7, "here")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for x in ("doc", "own", "kept", "__doc", "__kept", "LINE", "near"):
        docs = docs.withColumn(x, F.lit(x))
    out = ld.dedup_lines(docs)
    assert out.columns == docs.columns
    lines = Counter(x for r in out.select("doc_id", "text").distinct().collect() for x in r.text.split("\n") if x)
    assert lines == {a: 1, b: 1, c: 1, "here": 1}  # nothing is lost and nothing stands twice
    assert out.count() == len(rows)
    assert ld.line_counts(docs).count() == len(rows)


def test_many_lines_that_agree_in_two_pieces(spark, docs_of):
    texts = [f"{'prefix of a log line ' * 3}{i:012d}{' and the same end of it' * 3}" for i in range(0, 4000, 7)]
    got = ld.line_counts(docs_of(texts)).agg(F.sum("n_kept"), F.sum("n_near")).first()
    near = {t for i, t in enumerate(texts) for s in texts[:i] if sum(x != y for x, y in zip(s, t)) == 1}
    assert tuple(got) == (len(texts) - len(near), len(near))


def test_awkward_rows(docs_of):
    line = "this very line stands in several of the documents"
    texts = [line, None, "", "\n\n", line + "\n" + line, line, line, "y" * 200_000, "y" * 100_000 + "x" + "y" * 99_999]
    docs = docs_of(texts, [0, 1, 2, 3, 4, None, 0, 7, 8])
    out = ld.dedup_lines(docs).collect()
    assert len(out) == len(texts)
    by = sorted(((r.doc_id is None, r.doc_id, r.text) for r in out), key=str)
    assert (False, 4, "") in by and (True, None, line) in by and (False, 1, None) in by and (False, 3, "\n\n") in by
    assert sum(x == (False, 0, line) for x in by) == 2
    assert (False, 8, "") in by
    assert ld.line_counts(docs.where("false")).count() == 0 and ld.dedup_lines(docs.where("false")).count() == 0


def test_a_line_that_many_others_are_near_to(spark, docs_of, monkeypatch):
    """One early line with hundreds of later ones an edit away, in groups of a few; and a key that most lines share."""
    monkeypatch.setattr(ld, "SPLIT", 7)
    rng = random.Random(8)
    base = "".join(rng.choice("abcdefgh") for _ in range(90))
    texts = [base] + [base[: k % 90] + "XYZ"[k // 90] + base[k % 90 + 1 :] for k in range(250)] + [base[:k] + "-" + base[k:] for k in range(60)]
    texts += [base[:-1] + chr(0x100 + k) for k in range(200)] + [f"{k:03d} quite another line, with numbers of its own {k * k:09d}" for k in range(50)]
    rng.shuffle(texts)
    got = {(r.doc_id, r.line): r.near_doc_id is None for r in ld.line_verdicts(docs_of(texts), ld.line_table(docs_of(texts))).collect()}
    want = brute(list(enumerate(texts)))
    assert got == want and sum(not x for x in want.values()) > 200
