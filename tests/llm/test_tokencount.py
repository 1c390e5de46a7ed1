import os

import numpy as np
import pytest

from tideline.llm import tokencount as tc
from tideline.llm.common import shared_dir

needs_vocabulary = pytest.mark.skipif(not os.path.exists(tc.RANKS), reason="the vocabulary file isn't there")


@needs_vocabulary
def test_counts_equal_the_tokenizer(spark, docs_of):
    texts = ["Hello world, it's 2026!", None, "", "é…日本" * 400, " \n\t ", "<|endoftext|>", "a" * 20_000] + [f"row {i} " * i for i in range(60)]
    docs = docs_of([*texts, "again"], [*range(len(texts)), 3])
    rows = sorted((r.doc_id, r.n_tokens) for r in tc.token_counts(spark, docs).collect())
    count = lambda t: len(tc.encoder().encode_ordinary(t or ""))
    assert rows == sorted([*((i, count(t)) for i, t in enumerate(texts)), (3, count("again"))])
    assert tc.token_counts(spark, docs.where("false")).count() == 0


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
def test_stitching_across_blocks(spark, block):
    rng = np.random.default_rng(block)
    root, files, want = shared_dir(spark, "flat"), [], []
    os.makedirs(root.removeprefix("file://"))
    for k in range(3):
        tokens = rng.integers(0, 100, size=300)
        tokens[rng.random(300) < (0.3, 0.01, 0.0)[k]] = tc.SEPARATOR
        if k == 0:
            tokens[:2] = tc.SEPARATOR
        files.append(f"{root}/{k}.bin")
        tokens.astype(tc.TYPE).tofile(files[-1].removeprefix("file://"))
        before = -1
        for n, at in enumerate(np.flatnonzero(tokens == tc.SEPARATOR)):
            want.append((files[-1], n, before + 1, int(at) - before - 1))
            before = int(at)
    got = tc.count_tokens(spark.createDataFrame([(f,) for f in files], "file string"), block=block).collect()
    assert sorted(map(tuple, got)) == sorted(want)
