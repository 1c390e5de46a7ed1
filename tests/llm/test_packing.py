import random

import numpy as np
from pyspark.sql import functions as F

from tideline.llm import packing


def plain_best_fit(sizes, lengths):
    """Best fit without any index: every open bin is looked at; of equal rooms the bin that was
    filled last is taken."""
    left, bins = sum(sizes), []
    for turn, i in enumerate(sorted(range(len(sizes)), key=lambda i: -sizes[i])):
        n = sizes[i]
        fit = [b for b in bins if b[1] >= n]
        if fit:
            bin_ = min(fit, key=lambda b: (b[1], -b[2]))
        else:
            k = min((c for c in lengths if c >= n), key=lambda c: (packing.cost(c) / min(c, left), c))
            bin_ = [k, k, turn]
            bins.append(bin_)
        bin_[1] -= n
        bin_[2] = turn
        left -= n
    return [c - r for c, r, _ in bins]


def test_pack_equals_plain_best_fit():
    rng = random.Random(1)
    for _ in range(30):
        sizes = [rng.randint(1, 64) for _ in range(rng.randint(0, 80))]
        bins, offsets, length = packing.pack(sizes, (16, 32, 64))
        used = [0] * len(length)
        for i in sorted(range(len(sizes)), key=lambda i: (bins[i], offsets[i])):
            assert offsets[i] == used[bins[i]]
            used[bins[i]] += sizes[i]
        assert all(u <= c and c == min(x for x in (16, 32, 64) if x >= u) for u, c in zip(used, length))
        assert sorted(used) == sorted(plain_best_fit(sizes, (16, 32, 64)))


def test_every_piece_once(spark, docs_of):
    rng = random.Random(2)
    texts = ["é" * rng.randint(0, 400) for _ in range(200)] + [None, "", "a" * 50_000]
    docs = docs_of([*texts, texts[0], "z"], [*range(len(texts)), 0, None])
    rows = packing.best_fit(docs, lengths=(128, 256, 512), shard=60).collect()
    per, bins = {}, {}
    for r in rows:
        per.setdefault((r.doc_id, r.copy), []).append((r.start, r.n_tokens, r.piece))
        bins.setdefault(r.bin_id, []).append((r.bin_offset, r.n_tokens, r.bin_length))
    assert len(per) == len(texts) + 2
    for (doc, _), pieces in per.items():
        text = "z" if doc is None else texts[doc]
        assert sum(n for _, n, _ in pieces) == len((text or "").encode()) + 1
        end = 0
        for k, (start, n, piece) in enumerate(sorted(pieces)):
            assert (start, piece) == (end, k) and n <= 512
            end += n
    for held in bins.values():
        end = 0
        for offset, n, length in sorted(held):
            assert offset == end
            end += n
        assert {x for *_, x in held} == {min(c for c in (128, 256, 512) if c >= end)}
    again = packing.best_fit(docs.repartition(7), lengths=(128, 256, 512), shard=60)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))


def test_other_lengths_and_empty_table(docs_of):
    assert packing.best_fit(docs_of(["a"]).where("false")).count() == 0
    rows = packing.best_fit(docs_of(["a b c", None]), tokens=F.size(F.split("text", " "))).collect()
    assert sorted(r.n_tokens for r in rows) == [1, 3]
    assert packing.bins(packing.best_fit(docs_of(["abc", "de"]))).collect()[0].used == 7


def total(lengths):
    return sum(map(packing.cost, lengths))


def test_new_bins_are_priced_by_what_fits(docs_of):
    rows = packing.best_fit(docs_of(["a" * 599] * 300)).collect()
    assert {(r.n_tokens, r.bin_length) for r in rows} == {(600, 2048)} and len({r.bin_id for r in rows}) == 100
    # one fits 4096, two or three fit 8192
    assert set(packing.pack_cheapest([3000] * 30, (4096, 8192))[2]) == {4096}
    assert set(packing.pack_cheapest([2600] * 30, (4096, 8192))[2]) == {8192}


def test_fill_takes_the_largest_that_fit():
    assert packing.fill(100, [7, 30, 60], [9, 1, 1], 3) == 60 + 30 + 7
    assert packing.fill(100, [7, 30, 60], [9, 9, 0], 3) == 90 + 7 and packing.fill(5, [7], [1], 1) == 0


def test_leftover_bins_are_downsized_and_no_shard_gets_dearer():
    rng, downsized = random.Random(3), 0
    for _ in range(60):
        sizes = [rng.choice((rng.randint(1, 64), 20, 9)) for _ in range(rng.randint(1, 80))]
        bins, offsets, length = packing.pack_cheapest(sizes, (16, 32, 64))
        used, biggest = [0] * len(length), [0] * len(length)
        for i in sorted(range(len(sizes)), key=lambda i: (bins[i], offsets[i])):
            assert offsets[i] == used[bins[i]]
            used[bins[i]] += sizes[i]
        assert sum(used) == sum(sizes) and all(c == min(x for x in (16, 32, 64) if x >= u) for u, c in zip(used, length))
        assert total(length) <= total(packing.pack(sizes, (16, 32, 64))[2])
        downsized += length != packing.pack(sizes, (16, 32, 64), True, False)[2]
    assert downsized


def least_cost(sizes):
    """A bound that no packing into 1024, 2048, 4096 and 8192 can beat.  Pieces of more than half of the largest
    length need a bin each.  What these have left takes at most so many pieces of the class below as fit one by
    one, smallest first; the others need a bin each.  Of the next class at most so many are spared as fit into all
    the room there is, and what tokens find no room so far costs at least what it does in the least length."""
    top, mid, low = (sorted(n for n in sizes if c // 2 < n <= c) for c in (8192, 4096, 2048))
    spared = 0
    for gap in sorted(8192 - n for n in top):
        spared += spared < len(mid) and mid[spared] <= gap
    many, some = len(top), len(mid) - spared
    room = many * 8192 + some * 4096 - sum(top) - sum(mid)
    fits = np.searchsorted(np.cumsum(low), room, side="right")
    few = len(low) - int(fits)
    rest = max(0, sum(sizes) - many * 8192 - some * 4096 - few * 2048)
    return many * packing.cost(8192) + some * packing.cost(4096) + few * packing.cost(2048) + rest * packing.cost(1024) / 1024


def test_cost_on_sizes_like_those_of_documents():
    """Near what no packing can beat, and below opening one length, the largest, and downsizing at the end."""
    rng = np.random.default_rng(5)
    for sigma in (0.6, 0.9, 1.2):
        raw = np.exp(rng.normal(7.3, sigma, 8000)).astype(int) + 1
        sizes = [x for n in raw.tolist() for x in [8192] * ((n - 1) // 8192) + [(n - 1) % 8192 + 1]]
        found = sum(map(packing.cost, packing.pack_cheapest(sizes)[2]))
        assert least_cost(sizes) <= found <= 1.02 * least_cost(sizes)
        order = np.argsort(-np.array(sizes), kind="stable")
        one = packing.pack([sizes[i] for i in order], (8192,))
        used = np.bincount(one[0], weights=[sizes[i] for i in order]).astype(int)
        assert found < 0.95 * sum(packing.cost(min(c for c in packing.LENGTHS if c >= u)) for u in used)
