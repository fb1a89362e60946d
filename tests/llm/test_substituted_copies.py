"""Copies of benchmark items with substituted words, against a count of agreement in every segment."""

import random

import pyarrow as pa
import pytest

from pricebeam.llm.decontaminate import BenchIndex, _tokens, overlaps

LEAST = 12


def agreeing(words, item):
    """Equal words of the segment, of those with four equal words of five, that has most; over all alignments."""
    best = 0
    for shift in range(1 - len(item), len(words)):
        same = [0 <= q + shift < len(words) and words[q + shift] == w for q, w in enumerate(item)]
        for a in range(len(same)):
            for b in range(a + 1, len(same) + 1):
                if 5 * sum(same[a:b]) >= 4 * (b - a):
                    best = max(best, sum(same[a:b]))
    return best


def changed(item, places):
    return ["zzz" if i in places else w for i, w in enumerate(item)]


@pytest.mark.parametrize("length", [15, 16])
def test_one_changed_word_anywhere(spark, length):
    item = [f"w{i}" for i in range(length)]
    docs = spark.createDataFrame([(i, " ".join(["before", *changed(item, {i}), "behind"])) for i in range(length)],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {x.doc_id: x for x in overlaps(docs, bench, LEAST).collect()}
    assert set(got) == set(range(length))
    assert all(x.n_equal >= LEAST and 5 * x.n_equal >= 4 * x.n_words for x in got.values())


def test_agreement_is_counted_whole():
    rng = random.Random(5)
    items = [[f"i{n}x{k}" for k in range(n)] for n in [*range(1, 24), 40]]
    texts = []
    for item in items:
        for k in range(5):
            for _ in range(12):
                copy = changed(item, set(rng.sample(range(len(item)), min(k, len(item)))))
                texts.append(rng.choice([[], ["x"]]) + copy[rng.choice([0, 0, 1]) :] + rng.choice([[], ["y", "z"]]))
    index = BenchIndex(list(range(len(items))), [" ".join(x) for x in items], LEAST)
    found = index.hits(*_tokens(pa.array([" ".join(x) for x in texts])))
    expected = {(t, i) for t, text in enumerate(texts) for i, item in enumerate(items)
                if set(text) & set(item) and agreeing(text, item) >= min(LEAST, -(-4 * len(item) // 5))}
    assert {x[:2] for x in found} == expected
    assert {len(items[i]) for _, i in expected} == {len(x) for x in items}
    assert any(len(items[i]) < 15 and set(items[i]) - set(texts[t]) for t, i in expected)
    for t, i, equal, words, at, place in found:
        same = [a == b for a, b in zip(texts[t][at : at + words], items[i][place : place + words])]
        assert len(same) == words and sum(same) == equal and same[0] and same[-1]
