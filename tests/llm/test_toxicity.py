import random
from itertools import product

from tideline.llm import toxicity as tx

TERMS = [("moron", False), ("scum", False), ("lowei", True), ("worthless", False), ("numbskull", True)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def brute(word):
    best = (9, -1)
    for t, (text, stem) in enumerate(TERMS):
        bears = len(text) >= (tx.FUZZY_STEM if stem else tx.FUZZY_WORD)
        e = min(edits(text, word[:k]) for k in range(len(word) + 1)) if stem else edits(text, word)
        if e == 0 or (bears and e == 1):
            best = min(best, (e, t))
    return best


def test_automaton_equals_edit_distance():
    rng = random.Random(6)
    words = {"moron", "m0ron", "moro", "morons", "xmoron", "mor", "scum", "scums", "loweichen", "lowey", "numskull", "numbskulls", "nunbskullery", "worthles", "worthlesss", "wortless", "ab", "z" * 40}
    for text, _ in TERMS:
        for _ in range(60):
            w = list(text) + list(rng.choice(["", "", "er", "xyz"]))
            for _ in range(rng.randint(0, 2)):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], [rng.choice("abcmno0")], [w[k], "q"]])
                w = w or ["a"]
            words.add("".join(w))
    words |= {"".join(x) for x in product("sucm", repeat=4)}
    words = sorted(words)
    w = tx.words_of([" ".join(words)])
    at, term, e = tx.compile_terms(TERMS).run(w)
    got = {w.word(i): (int(k), int(t)) for i, t, k in zip(at, term, e)}
    assert got == {x: b for x in words if (b := brute(x))[0] <= 1}


def test_quotation_is_told_from_abuse():
    texts = ['you utter moron go away now', 'he wrote the word "moron" in his essay on slurs', "moron"]
    w = tx.words_of(texts)
    at, _, _ = tx.compile_terms(TERMS).run(w)
    assert [tx.quoted(w, int(i), int(w.of[i])) for i in at] == [False, True, False]


def test_learns_terms_stems_and_misspellings(spark, docs_of):
    rng = random.Random(9)
    plain = ["".join(rng.choice("bdfgklmprt") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(300)]
    texts, labels = [], []
    for i in range(900):
        words = [rng.choice(plain) for _ in range(40)]
        toxic = i % 5 == 1
        if toxic:
            for _ in range(4):
                words[rng.randrange(40)] = rng.choice(["moronic", "worthless", "zworgh" + rng.choice(plain)])
        texts.append(" ".join(words))
        labels.append(int(toxic))
    texts += [plain[0] + " m0ronic worthles m0ronic worhtless w0rthless " + plain[1], None, ""]
    docs = docs_of([*texts, "x"], [*range(len(texts)), None])
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "doc_id bigint, toxic int")
    rows = tx.toxicity_scores(docs, marks).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts) + 1 and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 900]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.97 * len(held)
    assert got[900].predicted == 1 and got[901].predicted == 0 and got[902].predicted == 0
    kept = tx.drop_toxic(docs, marks)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.predicted == 0)


def test_learns_words_of_reporting_of_any_language_and_terms_of_any_length(spark, docs_of):
    rng = random.Random(10)
    plain = ["".join(rng.choice("bdfgklmprt") + rng.choice("aeiou") for _ in range(3)) for _ in range(200)]
    texts, labels = [], []
    for i in range(1200):
        words = [rng.choice(plain) for _ in range(30)]
        k = rng.randrange(2, 28)
        if i % 4 == 1:
            words[k] = rng.choice(["zq", "zworgh" * 5])
        elif i % 16 == 2:
            words[k - 1 : k + 1] = ["sagteer", rng.choice(["zq", "zworgh" * 5])]
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 1))
    docs = docs_of(texts)
    model = tx.train(docs, spark.createDataFrame(list(enumerate(labels)), "doc_id bigint, toxic int"))
    assert {"zq", "zworgh" * 5} <= {t for t, _ in model.terms} or any(s and "zworgh".startswith(t[:6]) for t, s in model.terms)
    assert "zq" in {t for t, _ in model.terms} and model.reporting - tx.REPORTING == {"sagteer"}
    a, b = model.score(["du bist ein zq und mehr", "er sagteer zq und mehr"])
    assert a > 0.5 > b


def test_no_labels_and_empty_table(spark, docs_of):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert tx.toxicity_scores(docs_of(["a"]).where("false"), none).count() == 0
    docs = docs_of(["a", None])
    assert {(r.score, r.predicted) for r in tx.toxicity_scores(docs, none).collect()} == {(0.0, 0)}
    assert tx.drop_toxic(docs, none).count() == 2
