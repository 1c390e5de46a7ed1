"""The pipeline on a small corpus against a brute-force version of each stage."""

import random

import numpy as np
import pytest

import corpus_pipeline as cp
from tideline.llm import simhash

SYLLABLES = "ba be bi bo da de di do ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to".split()


def words(rng, n):
    return [("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(2, 4)))) for _ in range(n)]


def lines(rng, n):
    return "\n".join(" ".join(words(rng, 12)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    items = [" ".join(words(rng, 30)) for _ in range(3)]
    texts, toxic, leaks = {}, set(), set()
    for i in range(400):
        own = lines(rng, 4)
        if i % 5 == 1:
            parts = own.split(" ")
            for k in rng.sample([k for k, x in enumerate(parts) if "\n" not in x], 5):
                parts[k] = rng.choice(["zworgh", "xurtling", "qwazzle"])
            own = " ".join(parts)
            toxic.add(i)
        texts[i] = own
    shared = lines(rng, 1)
    for i in range(400, 420):
        texts[i] = lines(rng, 3) + "\n" + shared
    long = words(rng, 200)
    for i in range(420, 425):  # near copies in one line, which line dedup leaves: a word of 200 differs
        copy = list(long)
        copy[i - 300] = "other" + "x" * (i - 419)
        texts[i] = " ".join(copy)
    for i in range(425, 428):
        texts[i] = " ".join(words(rng, 20)) + " " + items[i - 425] + " " + " ".join(words(rng, 20))
        leaks.add(i)
    texts[428], texts[429], texts[430] = "", None, texts[0]
    path = tmp_path_factory.mktemp("sf")
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(400)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), texts, toxic, leaks, items


def test_stages_and_run(spark, corpus):
    path, texts, toxic, leaks, items = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in cp.STAGES[:-1]:
        docs = cp.stored(stage(spark, docs, path), name)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    # toxicity: what was planted goes, all else stays
    assert set(kept["toxicity"]) == set(texts) - toxic
    # line dedup: of equal lines the first stays
    seen, want = set(), {}
    for i in sorted(kept["toxicity"]):
        t = kept["toxicity"][i]
        own = []
        for x in (t or "").split("\n"):
            if not x or x not in seen:
                own.append(x)
            seen.add(x)
        want[i] = None if t is None else "\n".join(own)
    assert kept["line_dedup"] == want
    # near-duplicates: brute force over fingerprints and sets of five-word shingles
    ids = sorted(want)
    v = np.array([simhash.fingerprint((want[i] or "").encode()) for i in ids], dtype=np.uint64)
    near, comp = np.bitwise_count(v[:, None] ^ v[None]) <= 3, np.arange(len(ids))
    split = [(want[i] or "").split() for i in ids]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in split]
    near |= np.array([[bool(x and y) and len(x & y) >= 0.8 * len(x | y) for y in sets] for x in sets])
    while True:
        new = np.array([comp[row].min() for row in near])
        if (new == comp).all():
            break
        comp = new
    first = {ids[c] for c in comp}
    assert set(kept["simhash_near_dedup"]) == first and 430 not in first and 429 not in first
    assert {i for i in range(420, 425) if i in first} == {420}
    # decontamination
    assert set(kept["benchmark_decontamination"]) == first - leaks
    assert all(any(x in texts[i] for x in items) for i in leaks)
    # packing: every piece once
    size = {}
    for r in cp.run(spark, path).collect():
        size[r.doc_id] = size.get(r.doc_id, 0) + r.n_tokens
    assert size == {i: len((t or "").encode()) + 1 for i, t in kept["benchmark_decontamination"].items()}
