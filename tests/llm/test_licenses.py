import random
import re
import time

import pytest

from tideline.llm import licenses as lic


def accepted(text, template):
    return [x for x, *_ in lic.scan(text.encode(), [lic.compile_template("t", template)]).found]


def test_templates():
    t = "<<optional>>this file<</optional>> is free <<any:2>> software <<optional>>really<</optional>> done"
    for text, want in (
        ("this file is free software done", 1),
        ("IS FREE as-is software, really done!", 1),
        ("is free one two three software done", 0),
        ("is free software really really done", 0),
        ("is free software", 0),
        ("x this is free software done is free a b software really done y", 2),
    ):
        assert len(accepted(text, t)) == want, text
    for bad in ("<<optional>>a b", "<<optional>>a<</optional>>"):
        with pytest.raises((ValueError, IndexError)):
            lic.compile_template("t", bad)


def test_automata_equal_regular_expressions():
    rng = random.Random(2)

    def template(depth=0):
        parts = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.random()
            if kind < 0.2 and depth < 2:
                parts.append(f"<<optional>>{template(depth + 1)}<</optional>>")
            elif kind < 0.35:
                parts.append(f"<<any:{rng.randint(1, 3)}>>")
            else:
                parts.append(rng.choice("abc"))
        return " ".join(parts)

    hits = 0
    for _ in range(400):
        t = template()
        pattern = re.sub(r"<<any:(\d)>> ?", r"(?:\\w+ ){0,\1}", re.sub(r"(?<![<\w/])([abc])(?![\w>])", r"\1 ", t).replace("  ", " "))
        pattern = pattern.replace("<<optional>>", "(?:").replace("<</optional>> ", ")?").replace("<</optional>>", ")?")
        pattern = re.sub(r"\)\?\s+", ")?", pattern)
        try:
            a = lic.compile_template("t", t)
        except ValueError:
            continue  # no mandatory words
        for _ in range(20):
            text = "".join(rng.choice("abcd") + " " for _ in range(rng.randint(0, 9)))
            found = lic.scan(text.encode(), [a]).found
            assert bool(found) == bool(re.search(r"(?<!\w)" + pattern, text)), (t, pattern, text)
            hits += bool(found)
    assert hits > 500


def test_every_template_accepts_its_own_wording_and_nothing_less():
    for label, t in lic.TEMPLATES.items():
        words = re.sub(r"<<any:\d+>>", "someone", re.sub(r"<</?optional>>", " ", t)).split()
        assert accepted(" ".join(words).upper(), t) == ["t"], label
        bare = re.sub(r"<<any:\d+>>", " ", t)
        while "<<optional>>" in bare:
            bare = re.sub(r"<<optional>>[^<]*<</optional>>", " ", bare)
        words = bare.split()
        assert accepted(" ".join(words), t) == ["t"], label
        for k in {0, len(words) // 2, len(words) - 1}:
            assert not accepted(" ".join([*words[:k], "qq", *words[k + 1 :]]), t), (label, k)


def test_places_are_counted_in_one_pass():
    def seconds(n):
        text, began = b"the mit license " * n, time.perf_counter()
        s = lic.scan(text, [])
        assert len(s.base) == n and s.base[-1] == (3 * n - 2, "mit")
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(200_000) < 5  # a count from the start for every place would take minutes


def test_base_places_and_awkward_rows(docs_of):
    texts = [
        "The MIT License. mit-license! submit license",
        None,
        "",
        "Apache\xa0License and apache license",
        "x " * 100_000 + "GNU General Public License",
        "Licensed under the Apache License, Version 2.0.",
    ]
    rows = {r.doc_id: r for r in lic.license_scan(docs_of(texts)).collect()}
    a = rows[0]
    assert (a.n_words, a.n_base, a.first_word, a.last_word, a.base_labels) == (7, 2, 1, 3, "mit")
    assert (rows[1].n_words, rows[1].n_base, rows[1].first_word, rows[1].labels, rows[1].score) == (0, 0, None, "", 0.0)
    assert (rows[3].n_base, rows[3].first_word) == (1, 2)  # the no-break space is part of a word
    assert (rows[4].first_word, rows[4].base_labels, rows[4].score) == (100_001, "gpl", 0.5)
    assert (rows[5].labels, rows[5].score) == ("apache,apache-2-notice", 1.0)
    assert rows[5].found[0].asDict() == {"label": "apache-2-notice", "first": 0, "end": 8}
    assert lic.license_scan(docs_of(["a"]).where("false")).count() == 0
