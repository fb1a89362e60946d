"""What a task holds stays bounded: hashes of very long texts, the index over many random fingerprints."""

import time
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pricebeam.llm import simhash
from pricebeam.llm.bilinear import score_texts
from pricebeam.llm.decontaminate import BenchIndex, _tokens
from pricebeam.llm.simhash import GrayIndex, near_groups, one_of_each_group
from pricebeam.llm.textarrays import PIECE, RangeHash, Words, column_bytes, random_table


def peak_mb(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_word_hashes_over_pieces():
    """Words that lie over the edges of pieces hash alike wherever they stand."""
    text = "alpha beta " * (PIECE // 8) + "x" * (PIECE + 3) + " alpha"
    data, offsets = column_bytes(pa.array([text, "beta alpha", "x" * (PIECE + 3)]))
    words = Words(data, offsets)
    plain = RangeHash(random_table(256, 5)[data]).of(words.starts, words.ends)
    assert (words.hashes(seed=5) == plain).all()
    assert len(np.unique(plain)) == 3


def test_a_very_long_text_is_hashed_in_little_memory():
    text = pa.array(["some words of a text that has no end " * 440_000])  # 16 MB
    index = BenchIndex([1], ["a text that has no end and is long enough to have seeds of all kinds in it"], 12)

    def work():
        index.hits(*_tokens(text))

    assert peak_mb(work) < 250
    data, offsets = column_bytes(text)
    words = Words(data, offsets)
    assert peak_mb(lambda: words.hashes(seed=1)) < 150


def test_many_random_fingerprints_of_one_band():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 51, 20_000, dtype=np.uint64)
    prints[1::100] = prints[::100] ^ np.uint64(0b10010000001)
    begin, found = time.time(), []
    assert peak_mb(lambda: found.append(GrayIndex(np.zeros(20_000, np.int64), prints).labels(4))) < 300
    label = found[0]
    for i in range(0, 20_000, 500):
        near = np.bitwise_count(prints ^ prints[i]) <= 4
        assert len(set(label[near])) == 1
    assert time.time() - begin < 120


def test_repeated_cuts_link_the_same(spark, monkeypatch):
    """Random fingerprints that share a band are cut; those near each other stay together."""
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 1 << 40, 3000, dtype=np.uint64)
    prints[1000:2000] = prints[5] ^ (np.uint64(1) << rng.integers(0, 50, 1000).astype(np.uint64)) ^ (
        np.uint64(1) << rng.integers(0, 50, 1000).astype(np.uint64))
    rows = spark.createDataFrame([(i, int(x)) for i, x in enumerate(prints)], "doc_id long, fingerprint long")
    monkeypatch.setattr(simhash, "BUCKET_LIMIT", 50)
    got = {x.doc_id: x.component_id for x in near_groups(rows, 4).collect()}
    monkeypatch.setattr(simhash, "BUCKET_MOST", 400)
    again = {x.doc_id: x.component_id for x in near_groups(rows, 4).collect()}
    label = list(range(3000))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(3000):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 4).tolist():
            a, b = top(i), top(j)
            label[max(a, b)] = min(a, b)
    assert got == again == {i: top(i) for i in range(3000)}


def test_a_callers_key_column_stays(spark):
    docs = spark.createDataFrame([(1, "a b c d e", "kept"), (2, "a b c d e", "gone")], "doc_id long, text string, __key string")
    assert [x.asDict() for x in one_of_each_group(docs).collect()] == [{"doc_id": 1, "text": "a b c d e", "__key": "kept"}]
    scored = score_texts(docs.withColumn("__KEY_", F.lit(3)))
    assert sorted((x["doc_id"], x["__key"], x["__KEY_"]) for x in scored.collect()) == [(1, "kept", 3), (2, "gone", 3)]
