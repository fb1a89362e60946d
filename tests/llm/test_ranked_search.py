"""Ranked search against plain scores of every document."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pricebeam.llm import lexical
from pricebeam.llm.lexical import ranked_search, term_counts

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, count=20):
    cut = [(k, Counter(terms(t))) for k, t in docs]
    cut = [(k, c) for k, c in cut if c]
    n, total = len(cut), sum(c.total() for _, c in cut)
    df = Counter(t for _, c in cut for t in c)
    found = []
    for item, text in items:
        scores = []
        for k, c in cut:
            m = 100 - 25 + (25 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, k is None, k or 0))
        found += [(item, r + 1, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(scores)[:count])]
    return found


def test_terms_by_the_pattern():
    for text in ("Ab9_c-É字 x", "\x00a\x7fb", "", " ", None, "x" * 10 + "\n" + "ÀÉ É"):
        assert term_counts(text) == Counter(t.encode() for t in terms(text))
    piece, lexical.PIECE = lexical.PIECE, 7
    try:
        assert term_counts("one two three fourfive six  seven") == Counter([b"one", b"two", b"three", b"fourfive", b"six", b"seven"])
    finally:
        lexical.PIECE = piece


@pytest.mark.parametrize("item_bytes,step", [(lexical.ITEM_BYTES, lexical.STEP), (2000, 1)])
def test_whole_corpus(spark, texts, monkeypatch, item_bytes, step):
    """Nulls, repeated rows and long texts among them; items in one block and in many."""
    monkeypatch.setattr(lexical, "ITEM_BYTES", item_bytes)
    monkeypatch.setattr(lexical, "STEP", step)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    items = items.union(spark.createDataFrame([(900, None), (901, ""), (902, "three three word"), (903, "zzzz not held"), (None, "one two"),
                                               (905, " ".join(f"w{i}" for i in range(200)) + " one two three the de")], items.schema))
    got = [tuple(x) for x in ranked_search(texts, items).collect()]
    expected = brute([tuple(x) for x in texts.collect()], [tuple(x) for x in items.collect()])
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_ties_copies_and_clashing_columns(spark):
    """Thousands of equal texts tie; the smallest ids win."""
    rows = [(5000 - i, "same words here") for i in range(3000)] + [(9000, "same words here and others"), *[(9001 + i, "nothing") for i in range(4000)]]
    docs = (spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
            .withColumns({c: F.lit(1) for c in ("doc", "n", "terms", "times", "item", "number", "rank", "score", "item_id")}))
    items = spark.createDataFrame([(1, "same words"), (1, "same words"), (2, "others")], "item_id long, text string")
    got = sorted(tuple(x) for x in ranked_search(docs, items).collect())
    assert got == sorted(brute(rows, [(1, "same words"), (1, "same words"), (2, "others")]))
    assert [x[2] for x in got if x[0] == 1][::2] == list(range(2001, 2021))


def test_nothing(spark, nothing):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert ranked_search(nothing, items).collect() == []
    assert ranked_search(docs, items.filter("false")).collect() == []
    assert ranked_search(docs.filter("text IS NULL"), items).collect() == []
