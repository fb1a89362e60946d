"""A passage that many texts share behind different text never makes one group in the suffix sort."""

import random
from collections import Counter

import numpy as np
import pytest

from pricebeam.llm import suffixes
from pricebeam.llm.suffixes import remove_repeated_bytes

HOT = 5


def removed(texts, window):
    counts = Counter(x[k : k + window] for x in texts for k in range(len(x) - window + 1))
    out = []
    for x in texts:
        gone = bytearray(len(x))
        for k in range(len(x) - window + 1):
            if counts[x[k : k + window]] > 1:
                gone[k : k + window] = b"\1" * window
        out.append(sum(gone))
    return out


@pytest.mark.parametrize("size", [200, 260, 700])
def test_groups_stay_small(spark, monkeypatch, size):
    rng = random.Random(size)
    letters = "abcdefghijklmnop"

    def some(n):
        return "".join(rng.choice(letters) for _ in range(n))

    passage = some(size)
    # Some of the texts beside the passage agree in a few bytes or in all of them.
    texts = [some(rng.randrange(150, 300)) + rng.choice(["", "x", "yz"]) + passage + some(rng.randrange(150, 300))
             for _ in range(60)]
    texts += [texts[0][90:], texts[1], passage, passage[1:], "q" + passage + passage, "q" * 450]
    sort = suffixes._sort

    def checked(window, at_once):
        work = sort(window, at_once)

        def small(table):
            keys = np.concatenate([np.frombuffer(x, "u8") for x in table.column("grams").to_pylist()])
            assert np.unique(keys, return_counts=True)[1].max() <= HOT
            return work(table)
        return small

    monkeypatch.setattr(suffixes, "_sort", checked)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    monkeypatch.setattr("pricebeam.llm.blocks.BLOCK_BYTES", 2000)
    got = {x.doc_id: x.n_removed for x in remove_repeated_bytes(docs, 200, hot_segments=HOT).collect()}
    assert [got[i] for i in range(len(texts))] == removed([x.encode() for x in texts], 200)
