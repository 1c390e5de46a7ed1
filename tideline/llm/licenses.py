"""License scan by template-markup matching.

A template is license wording with two kinds of marked regions, in the style of license-list
templates: ``<<optional>> ... <</optional>>`` may be left out, ``<<any:N>>`` stands for up to N
replaceable words.  A template is compiled into an automaton over words.  A text holds the license
if the automaton accepts some run of its words, that is if all mandatory wording is there exactly,
in order.  The automaton starts only where a template's first mandatory words stand, so texts
without them cost a substring search.

Besides, base phrases are counted at all places where their words stand consecutively.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import slices

#: Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: The wording of common licenses and notices as templates, label and words.  Words
#: are what the word pattern leaves, so punctuation and case don't matter.
TEMPLATES: dict[str, str] = {
    "mit-notice": "<<optional>>this software is<</optional>> released under the <<optional>>terms of the<</optional>> mit license",
    "mit-text": """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the rights to use
        copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software
        is furnished to do so subject to the following conditions the above copyright notice and this permission notice
        <<optional>>including the next paragraph<</optional>> shall be included in all copies or substantial portions of the software
        the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of
        merchantability fitness for a particular purpose and <<any:2>> in no event shall the <<any:8>> be liable for any claim damages
        or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software
        or the use or other dealings in the software""",
    "isc-text": """permission to use copy modify and <<optional>>or<</optional>> distribute this software for any purpose with or without
        fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is
        provided as is and <<any:8>> disclaims all warranties with regard to this software including all implied warranties of
        merchantability and fitness in no event shall <<any:8>> be liable for any special direct indirect or consequential damages or
        any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other
        tortious action arising out of or in connection with the use or performance of this software""",
    "bsd-2-text": """redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met <<any:1>> redistributions of source code must retain the above copyright notice this list of
        conditions and the following disclaimer <<any:1>> redistributions in binary form must reproduce the above copyright notice
        this list of conditions and the following disclaimer in the documentation and or other materials provided with the
        distribution this software is provided by <<any:8>> as is and any express or implied warranties including but not limited to
        the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<any:8>> be
        liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement
        of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of
        liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of
        this software even if advised of the possibility of such damage""",
    "bsd-3-text": """redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met <<any:1>> redistributions of source code must retain the above copyright notice this list of
        conditions and the following disclaimer <<any:1>> redistributions in binary form must reproduce the above copyright notice
        this list of conditions and the following disclaimer in the documentation and or other materials provided with the
        distribution <<any:1>> neither the name of <<any:12>> nor the names of <<any:4>> contributors may be used to endorse or promote
        products derived from this software without specific prior written permission this software is provided by <<any:8>> as is and
        any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a
        particular purpose are disclaimed in no event shall <<any:8>> be liable for any direct indirect incidental special exemplary or
        consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or
        business interruption however caused and on any theory of liability whether in contract strict liability or tort including
        negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage""",
    "apache-2-notice": "licensed under the apache license version 2 0 <<optional>>the license<</optional>>",
    "apache-2-header": """licensed under the apache license version 2 0 the license you may not use this <<any:1>> except in compliance
        with the license <<optional>>you may obtain a copy of the license at <<any:8>><</optional>> unless required by applicable law or
        agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions
        of any kind either express or implied see the license for the specific language governing permissions and limitations under
        the license""",
    "mpl-2-notice": """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not
        distributed with this file you can obtain one at <<any:8>>""",
    "gpl-notice": """<<optional>>this program<</optional>> is free software you can redistribute it and or modify it under the terms of
        the gnu general public license as published by the free software foundation either version <<any:1>> of the license or
        <<optional>>at your option<</optional>> any later version <<any:8>> is distributed in the hope that it will be useful but without
        any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general
        public license for more details""",
    "lgpl-notice": """<<optional>>this library<</optional>> is free software you can redistribute it and or modify it under the terms of
        the gnu lesser general public license as published by the free software foundation either version <<any:2>> of the license or
        <<optional>>at your option<</optional>> any later version <<any:8>> is distributed in the hope that it will be useful but without
        any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser
        general public license for more details""",
    "agpl-notice": """<<optional>>this program<</optional>> is free software you can redistribute it and or modify it under the terms of
        the gnu affero general public license as published by the free software foundation either version <<any:1>> of the license or
        <<optional>>at your option<</optional>> any later version <<any:8>> is distributed in the hope that it will be useful but without
        any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu affero
        general public license for more details""",
    "gpl-reference": "licensed under the <<optional>>terms of the<</optional>> gnu general public license <<optional>>version<</optional>> <<any:1>>",
    "cc-by-nc-4": "licensed under <<optional>>a<</optional>> cc by nc 4 0 <<optional>>license<</optional>>",
}

_TABLE = bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or 48 <= x <= 57 or 97 <= x <= 122 else 32 for x in range(256))


@dataclass
class Automaton:
    """An automaton over words: ``step[state]`` maps a word to the next states, ``other[state]``
    holds the next states on any word, ``free[state]`` those reached without one."""

    label: str
    step: list[dict[bytes, list[int]]]
    other: list[list[int]]
    free: list[list[int]]
    final: int
    anchor: bytes
    lead: int  # most words that can stand before the anchor

    def reach(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for n in self.free[todo.pop()]:
                if n not in states:
                    states.add(n)
                    todo.append(n)
        return states

    def accept(self, words: list[bytes], at: int) -> int:
        """The end of the longest accepted run from word ``at``, or -1."""
        states, end = self.reach({0}), -1
        while True:
            if self.final in states:
                end = at
            if not states or at >= len(words):
                return end
            nxt: set[int] = set()
            for s in states:
                nxt.update(self.step[s].get(words[at], ()))
                nxt.update(self.other[s])
            states, at = self.reach(nxt), at + 1


def compile_template(label: str, text: str) -> Automaton:
    """The anchor is the first run of mandatory words."""
    step: list[dict[bytes, list[int]]] = [{}]
    other: list[list[int]] = [[]]
    free: list[list[int]] = [[]]

    def state() -> int:
        step.append({}), other.append([]), free.append([])
        return len(step) - 1

    at, opened, anchor, lead, anchored = 0, [], [], 0, False
    for part in re.findall(r"<<optional>>|<</optional>>|<<any:\d+>>|[^\s<>]+", text):
        if part == "<<optional>>":
            opened.append(at)
            anchored |= bool(anchor)
        elif part == "<</optional>>":
            free[opened.pop()].append(at)
            new = state()
            free[at].append(new)
            at = new
        elif part.startswith("<<any:"):
            anchored |= bool(anchor)
            for _ in range(int(part[6:-2])):
                new = state()
                other[at].append(new)
                free[at].append(new)
                at = new
                lead += not anchor
        else:
            new = state()
            step[at].setdefault(part.encode(), []).append(new)
            at = new
            if opened or anchored:
                lead += not anchor
            else:
                anchor.append(part.encode())
    if opened:
        raise ValueError(f"{label}: an optional region isn't closed")
    if not anchor:
        raise ValueError(f"{label}: a template needs mandatory words")
    return Automaton(label, step, other, free, at, b" ".join(anchor), lead)


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Byte offsets in `` w1 w2 ... `` of all places of the phrase, overlapping ones included."""
    out, at = [], joined.find(b" " + phrase + b" ")
    while at >= 0:
        out.append(at)
        at = joined.find(b" " + phrase + b" ", at + 1)
    return out


def numbers(joined: bytes, at: list[int]) -> Iterator[int]:
    """The words before each of the ascending offsets ``at``, in one pass."""
    n = before = 0
    for offset in at:
        n += joined.count(b" ", before, offset)
        before = offset
        yield n


@dataclass
class Scan:
    n_words: int
    base: list[tuple[int, str]]  # (first word, label) of every base place
    found: list[tuple[str, int, int]]  # (label, first word, end) of every accepted template


def scan(text: bytes, automata: list[Automaton]) -> Scan:
    words = text.translate(_TABLE).split()
    joined = b" " + b" ".join(words) + b" "
    base = [(n, label) for phrase, label in BASE.items() for n in numbers(joined, places(joined, phrase.encode()))]
    found = []
    for a in automata:
        done = -1
        for k in numbers(joined, places(joined, a.anchor)):
            for begin in range(max(0, k - a.lead, done), k + 1):
                end = a.accept(words, begin)
                if end > k:
                    found.append((a.label, begin, end))
                    done = end
                    break
    return Scan(len(words), sorted(base), found)


SCHEMA = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, found array<struct<label:string,first:bigint,end:bigint>>"


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Per document its license places.

    ``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, found)``: words
    of the whole text; places of base phrases, their smallest and largest first word (else null);
    base labels, and those with the labels of accepted templates, both distinct, sorted and
    comma-joined (empty strings if none); score 1 if a template is accepted, 0.5 if only base
    phrases stand there, else 0; and every accepted run of words.  A null or empty text has no
    words.  Repeated rows each give a row.
    """
    automata = [compile_template(k, v) for k, v in (TEMPLATES if templates is None else templates).items()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))
    types = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64(), kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch, "text", 1 << 23):
                part = batch.slice(a, b - a)
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    s = scan(text or b"", automata)
                    first = [p for p, _ in s.base]
                    base, own = {x for _, x in s.base}, {x for x, *_ in s.found}
                    found = [{"label": x, "first": i, "end": j} for x, i, j in s.found]
                    score = 1.0 if own else 0.5 if base else 0.0
                    rows.append((doc, s.n_words, len(first), min(first, default=None), max(first, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)), score, found))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, SCHEMA)
