"""Toxicity by Levenshtein automata over a lexicon trie, with context windows.

The lexicon is learned: words, and stems that start many words, whose document frequency among
toxic training documents is well above that among clean ones.  It is put into a trie, and the
trie is intersected with Levenshtein automata of one edit for terms long enough to bear it; the
product is made deterministic, a table of states by character classes.  All words of a batch run
through that table together, one character position at a time, and words that can't match any
more leave early.

Each hit is then weighed in a window of words around it: a hit between quotation marks or beside
a word of reporting or mention counts as quoted, others as abuse.  Words of reporting are some
English ones and those, of any language, that training documents hold around hits far more often
where they are clean than where they are toxic.  A logistic model over the weighed hits, fitted on training documents other than those the lexicon came from, gives the score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import cut, slices
from tideline.llm.quality import held_out, sampled

STEMS = (4, 5, 6)
FUZZY_WORD, FUZZY_STEM = 5, 7  # least lengths at which an edit is forgiven
WINDOW = 6
RATIO, SURE = math.log(4), 3.5  # least log ratio of frequencies, and deviations above chance
REPORTING = frozenset("said says saying quote quoted quotes quoting called wrote writes word words term slur phrase cited citing".split())
QUOTES = np.array([ord(c) for c in "\"“”„«»‹›‘’"], dtype=np.uint32)
_WORD = np.array([chr(c).isalnum() for c in range(0x3000)], dtype=bool)
_INNER = np.zeros(0x3000, dtype=bool)
_INNER[[ord(c) for c in "@$*"]] = True


@dataclass
class Words:
    """The words of some texts: code points of all texts, and per word its text, begin and end."""

    codes: np.ndarray
    of: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray  # per text the number of words before it

    def word(self, i: int) -> str:
        return self.codes[self.begin[i] : self.end[i]].tobytes().decode("utf-32-le")


def words_of(texts: list[str]) -> Words:
    """Words are runs of letters and digits of any script; ``@ $ *`` count inside a word."""
    lowered = [t.lower() for t in texts]
    c = np.frombuffer("\0".join(lowered).encode("utf-32-le", "replace"), dtype=np.uint32)
    low = np.minimum(c, 0x2FFF)
    word = _WORD[low] | (c >= 0x3000)
    inner = np.flatnonzero(_INNER[low])
    inner = inner[(inner > 0) & (inner < len(c) - 1)]
    inner = inner[word[inner - 1] & word[inner + 1]]
    word[inner] = True
    turn = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    begin, end = turn[::2], turn[1::2]
    last = np.cumsum(np.fromiter(map(len, lowered), dtype=np.int64, count=len(lowered)) + 1)
    of = np.searchsorted(last, begin, side="right")
    return Words(c, of, begin, end, np.searchsorted(of, np.arange(len(texts) + 1)))


@dataclass
class Automaton:
    """The determinised product: ``step[state, class]``; class 0 is any character that no term
    holds; state 0 is dead.  ``hit[state]`` is the term (or -1) if a word ends there; ``sure`` marks
    states that no further character changes."""

    classes: np.ndarray
    step: np.ndarray
    hit: np.ndarray
    edits: np.ndarray
    sure: np.ndarray

    def run(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word numbers, terms, edits) of all hits."""
        state = np.ones(len(w.begin), dtype=np.int32)
        live = np.arange(len(w.begin))
        size = w.end - w.begin
        pos = 0
        while len(live):
            live = live[size[live] > pos]
            c = self.classes[np.minimum(w.codes[w.begin[live] + pos], len(self.classes) - 1)]
            state[live] = s = self.step[state[live], c]
            live = live[(s != 0) & ~self.sure[s]]
            pos += 1
        at = np.flatnonzero(self.hit[state] >= 0)
        return at, self.hit[state[at]], self.edits[state[at]]


def compile_terms(terms: list[tuple[str, bool]]) -> Automaton:
    """``terms`` are (text, is it a stem); of several terms that match a word, the one with fewer
    edits and then the earlier one counts."""
    children: list[dict[str, int]] = [{}]
    fuzzy = [False]  # whether some term below the node bears an edit
    word_at, stem_at = {}, {}
    for t, (text, stem) in enumerate(terms):
        bears = len(text) >= (FUZZY_STEM if stem else FUZZY_WORD)
        node = 0
        fuzzy[0] |= bears
        for ch in text:
            if ch not in children[node]:
                children[node][ch] = len(children)
                children.append({})
                fuzzy.append(False)
            node = children[node][ch]
            fuzzy[node] |= bears
        (stem_at if stem else word_at).setdefault(node, (t, bears))
    alphabet = sorted({ch for t, _ in terms for ch in t})
    number = {ch: i + 1 for i, ch in enumerate(alphabet)}

    # A position is (node, edits); (term, edits) below zero is a matched stem.
    def close(found: dict[int, int]) -> dict[int, int]:
        for node, e in list(found.items()):
            if node >= 0 and e == 0 and fuzzy[node]:
                for child in children[node].values():  # a character of the term is missing
                    if fuzzy[child] and found.get(child, 9) > 1:
                        found[child] = 1
        for node, e in list(found.items()):
            if node >= 0 and node in stem_at:
                t, bears = stem_at[node]
                if e == 0 or bears:
                    key = -1 - t
                    found[key] = min(e, found.get(key, 9))
        return found

    def move(found: dict[int, int], ch: str) -> dict[int, int]:
        out: dict[int, int] = {}
        for node, e in found.items():
            if node < 0:
                out[node] = min(e, out.get(node, 9))
                continue
            child = children[node].get(ch)
            if child is not None and (e == 0 or fuzzy[child]):
                out[child] = min(e, out.get(child, 9))
            if e == 0 and fuzzy[node]:
                out[node] = min(1, out.get(node, 9))  # a character too many
                for other in children[node].values():  # another character
                    if fuzzy[other]:
                        out[other] = min(1, out.get(other, 9))
        return close(out)

    def verdict(found: dict[int, int]) -> tuple[int, int]:
        best = (9, -1)
        for node, e in found.items():
            if node < 0:
                best = min(best, (e, -1 - node))
            elif node in word_at and (e == 0 or word_at[node][1]):
                best = min(best, (e, word_at[node][0]))
        return best

    start = close({0: 0}) if terms else {}
    sets = {frozenset(): 0, frozenset(start.items()): 1} if start else {frozenset(): 0}
    todo, step, ends = [dict(start)], [np.zeros(len(alphabet) + 1, dtype=np.int32)], [(9, -1)]
    if not start:
        step.append(step[0])
        ends.append((9, -1))
        todo = []
    for found in todo:
        row = np.zeros(len(alphabet) + 1, dtype=np.int32)
        live = {ch for node, e in found.items() if node >= 0 for ch in children[node]}
        for ch in ["", *live]:
            new = move(found, ch)
            key = frozenset(new.items())
            if key not in sets:
                sets[key] = len(sets)
                todo.append(new)
            if ch:
                row[number[ch]] = sets[key]
            else:
                row[:] = sets[key]
        step.append(row)
        ends.append(verdict(found))
    classes = np.zeros(max([ord(c) for c in alphabet], default=0) + 2, dtype=np.int32)
    for ch, n in number.items():
        classes[ord(ch)] = n
    hit = np.array([t for _, t in ends], dtype=np.int32)
    edits = np.array([e for e, _ in ends], dtype=np.int32)
    table = np.array(step, dtype=np.int32)
    sure = (table == np.arange(len(table))[:, None]).all(axis=1)
    return Automaton(classes, table, hit, edits, sure)


@dataclass
class Model:
    terms: list[tuple[str, bool]]
    weight: np.ndarray
    automaton: Automaton
    spared: frozenset[str]  # near words that clean training documents use
    reporting: frozenset[str]
    beta: np.ndarray | None
    prior: float

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text: log of words, then for abuse and for quoted hits the sum of weights (near ones
        at 0.6), its square root, and the largest weight; different terms; sum by words."""
        w = words_of(texts)
        out = np.zeros((len(texts), 9))
        out[:, 0] = np.log1p(np.diff(w.first))
        at, term, edits = self.automaton.run(w)
        seen: list[set[int]] = [set() for _ in texts]
        for i, t, e in zip(at.tolist(), term.tolist(), edits.tolist()):
            if e and w.word(i) in self.spared:
                continue
            n = int(w.of[i])
            value = float(self.weight[t]) * (0.6 if e else 1.0)
            k = 4 if quoted(w, i, n, self.reporting) else 1
            out[n, k] += value
            out[n, k + 2] = max(out[n, k + 2], value)
            seen[n].add(t)
        out[:, 2], out[:, 5] = np.sqrt(out[:, 1]), np.sqrt(out[:, 4])
        out[:, 7] = [len(s) for s in seen]
        out[:, 8] = 10 * out[:, 1] / np.maximum(10, np.diff(w.first))
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        if self.beta is None:
            return np.full(len(texts), self.prior)
        x = np.column_stack([np.ones(len(texts)), self.features(texts)])
        return 1 / (1 + np.exp(-np.clip(x @ self.beta, -30, 30)))


def window(w: Words, i: int, n: int) -> tuple[int, int]:
    """The words around word ``i`` of text ``n``, itself included, as a range."""
    return max(int(w.first[n]), i - WINDOW), min(int(w.first[n + 1]), i + WINDOW + 1)


def quoted(w: Words, i: int, n: int, reporting: frozenset[str] = REPORTING) -> bool:
    """Whether word ``i`` of text ``n`` stands in quotation marks that open and close within the
    window, or a word of reporting or mention stands in it."""
    a, b = window(w, i, n)
    before = np.isin(w.codes[w.begin[a] : w.begin[i]], QUOTES).sum()
    after = np.isin(w.codes[w.end[i] : w.end[b - 1]], QUOTES).sum()
    if before % 2 and after:
        return True
    return any(w.word(j) in reporting for j in range(a, b))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Newton steps for the ridge-penalised logistic loss; the intercept is not penalised."""
    x = np.column_stack([np.ones(len(x)), x])
    scale = np.append(1.0, np.maximum(1e-9, x[:, 1:].std(axis=0)))
    z, beta = x / scale, np.zeros(x.shape[1])
    hold = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + hold, z.T @ (y - p) - hold @ beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta / scale


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and term how many toxic and how many clean documents hold it."""
    for batch in batches:
        counts = {0: Counter(), 1: Counter()}
        for a, b in slices(batch, "text", 1 << 20):
            part = batch.slice(a, b - a)
            w = words_of(part.column("text").to_pylist())
            for n, y in enumerate(part.column("y").to_pylist()):
                own = {w.word(i) for i in range(w.first[n], w.first[n + 1])}
                counts[y].update(own)
                counts[y].update({x[:k] + "\t" for x in own for k in STEMS if len(x) > k})
        terms = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, type=pa.string()), pa.array([counts[1][t] for t in terms], type=pa.int64()), pa.array([counts[0][t] for t in terms], type=pa.int64())],
            ["term", "toxic", "clean"],
        )


def _surety(more: str, less: str, many: int, few: int) -> tuple[Column, Column]:
    """The log of the ratio of two document frequencies, and how many deviations it is above 0."""
    weight = F.log((F.col(more) + 0.5) / (many + 1)) - F.log((F.col(less) + 0.5) / (few + 1))
    return weight, weight / F.sqrt(1 / (F.col(more) + 0.5) + 1 / (F.col(less) + 0.5))


def lexicon(train: DataFrame, toxic: int, clean: int) -> list[tuple[str, bool, float]]:
    """(term, is it a stem, weight) of all terms that are far enough above chance, the weight being
    the log of the ratio of document frequencies.  A word under a chosen stem of at least about its
    weight is left out.  The training rows bound how many there are."""
    counts = train.mapInArrow(_term_counts, "term string, toxic bigint, clean bigint").groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    weight, surety = _surety("t", "c", toxic, clean)
    rows = counts.select("term", weight.alias("w"), surety.alias("z")).where(f"w >= {RATIO} and z >= {SURE}").orderBy(F.desc("z"), "term").collect()
    stems = {r["term"][:-1]: r["w"] for r in rows if r["term"].endswith("\t")}
    out = []
    for r in rows:
        text, stem = r["term"].rstrip("\t"), r["term"].endswith("\t")
        if not any(k < len(text) and stems.get(text[:k], -9) >= r["w"] - 0.7 for k in STEMS):
            out.append((text, stem, float(r["w"])))
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Model:
    """Fitted on at most ``sample`` labelled documents outside the held-out fold (crc32 mod 5 = 0):
    one half (by a hash of the id) gives the lexicon, the other the logistic model."""
    rows = sampled(docs, labels, "toxic", 5, 0, sample)
    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2))
    base = rows.where(part == 0)
    sizes = {r["y"]: r["count"] for r in base.groupBy("y").count().collect()}
    terms = lexicon(base, sizes.get(1, 0), sizes.get(0, 0)) if sizes.get(1) and sizes.get(0) else []
    pairs = [(t, s) for t, s, _ in terms]
    model = Model(pairs, np.array([w for *_, w in terms]), compile_terms(pairs), frozenset(), REPORTING, None, 0.0)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per word: in how many clean documents it is a near hit, and in how many toxic and clean
        ones it stands in the window of a hit."""
        for batch in batches:
            near, beside = Counter(), {0: Counter(), 1: Counter()}
            for a, b in slices(batch, "text", 1 << 20):
                part = batch.slice(a, b - a)
                w, ys = words_of(part.column("text").to_pylist()), part.column("y").to_pylist()
                at, _, edits = model.automaton.run(w)
                near.update({(int(w.of[i]), w.word(i)) for i in at[edits > 0] if ys[w.of[i]] == 0})
                hits = set(at.tolist())
                seen = {(n, w.word(j)) for i in hits for n in [int(w.of[i])] for j in range(*window(w, i, n)) if j not in hits}
                for n, x in seen | {(int(w.of[i]), "") for i in hits}:  # the empty word stands for all documents with hits
                    beside[ys[n]][x] += 1
            by = Counter(x for _, x in near)
            words = list(by.keys() | beside[0].keys() | beside[1].keys())
            columns = [words, [by[x] for x in words], [beside[1][x] for x in words], [beside[0][x] for x in words]]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, [pa.string()] + [pa.int64()] * 3)], ["word", "near", "toxic", "clean"])

    if pairs:
        by = base.select("text", "y").mapInArrow(around, "word string, near bigint, toxic bigint, clean bigint")
        by = by.groupBy("word").agg(F.sum("near").alias("near"), F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
        by = cut(by)
        held = by.where("word = ''").first()
        weight, surety = _surety("c", "t", held["c"] if held else 0, held["t"] if held else 0)
        told = by.where("word != ''").select("word", "near", ((weight >= RATIO) & (surety >= SURE)).alias("told")).where("near >= 2 or told").collect()
        model.spared = frozenset(r["word"] for r in told if r["near"] >= 2)
        model.reporting = REPORTING | {r["word"] for r in told if r["told"]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _features(model, batch)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), lists], ["doc_id", "y", "x"])

    other = rows.where(part == 1).mapInArrow(run, "doc_id bigint, y int, x array<double>").toPandas()
    other = other.sort_values("doc_id").drop_duplicates("doc_id")
    y = other["y"].to_numpy(dtype=np.float64)
    total = {k: sizes.get(k, 0) + int((y == k).sum()) for k in (0, 1)}
    model.prior = total[1] / max(1, sum(total.values()))
    if len(y) and y.min() < y.max():
        model.beta = fit_logistic(np.array(other["x"].tolist(), dtype=np.float64), y)
    return model


def _features(model: Model, batch: pa.RecordBatch) -> np.ndarray:
    parts = [model.features(["" if t is None else t for t in batch.slice(a, b - a).column("text").to_pylist()]) for a, b in slices(batch, "text", 1 << 20)]
    return np.concatenate(parts) if parts else np.zeros((0, 9))


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """Per document ``(doc_id, held_out, score, predicted)``.

    Labels are read only outside the fold that crc32(doc_id) mod 5 = 0 holds out; the score depends
    on the text alone, over all its words.  A null text counts as empty.  A null id is in no fold.
    Without labels of both classes there is nothing to tell apart: every score is the share of toxic
    labels, 0 if there are none.  Repeated rows each get a row.
    """
    model = train(docs, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(["" if t is None else t for t in batch.slice(a, b - a).column("text").to_pylist()]) for a, b in slices(batch, "text", 1 << 20)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(scores) if scores else np.zeros(0))], ["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(run, "doc_id bigint, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose text is predicted toxic, decided where the rows lie.  Each row is
    judged by its own text, so repeated rows and ids, null ids and further columns make no difference;
    a null text counts as empty, and an empty one is scored like any other."""
    model = train(docs, labels, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch, "text", 1 << 20):
                part = batch.slice(a, b - a)
                scores = model.score(["" if t is None else t for t in part.column("text").to_pylist()])
                yield part.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)
