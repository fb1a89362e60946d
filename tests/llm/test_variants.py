"""Spelling variants against plain edit distances of all pairs of words."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricebeam.llm import variants
from pricebeam.llm.variants import near_pairs, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)):] == b[at + 1:]


def brute(docs, least=6, times=5, ratio=5):
    counts = Counter()
    for key, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= times}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return [(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()]


def rows(frame):
    return sorted(map(repr, [tuple(x) for x in frame.collect()]))


@pytest.mark.parametrize("group,tile", [(variants.GROUP, variants.TILE), (3, 2)])
def test_whole_corpus(spark, texts, monkeypatch, group, tile):
    """Groups whole, and cut down to single places."""
    monkeypatch.setattr(variants, "TILE", tile)
    docs = texts.union(spark.createDataFrame([(50, "strange Strange stränge " * 40), (51, "strangé stranges trange " * 5),
                                              (52, "×÷×÷×÷ " * 6), (None, "Straßenbahn " * 9)], "doc_id long, text string"))
    assert rows(spelling_variants(docs, group=group)) == sorted(map(repr, brute([tuple(x) for x in docs.collect()])))


def test_chains_and_ties(spark):
    """Forms of forms; equally frequent forms; words of one group over few letters."""
    text = " ".join(["aaaaaa"] * 5 + ["aaaaab"] * 25 + ["aaaabb"] * 125 + ["aaabbb"] * 625 + ["cccccc"] * 5 + ["cccccd"] * 30
                    + ["ccccce"] * 30 + ["zzzzzzz"] * 4)
    rng = random.Random(1)
    many = " ".join("".join(rng.choice("xyz") for _ in range(rng.choice((6, 7)))) for _ in range(12000))
    docs = spark.createDataFrame([(1, text), (2, many)], "doc_id long, text string")
    expected = brute([tuple(x) for x in docs.collect()])
    assert any(x[1] != x[2] and x[1] for x in expected)
    assert rows(spelling_variants(docs, group=40)) == sorted(map(repr, expected))


def test_pairs_once_each_way():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice((7, 8)))).encode() for _ in range(300)})
    n = len(words)
    found = near_pairs(words, np.zeros(n, int), np.zeros(n, int), np.full(n, 8), 8)
    plain = {(i, j) for i in range(n) for j in range(n) if one_edit(words[i], words[j]) and 8 in (len(words[i]), len(words[j]))}
    assert len(found) == len(plain) and {tuple(x) for x in found.tolist()} == plain


def test_long_words_odd_rows_and_nothing(spark, odd, nothing):
    long = "q" * 30000
    docs = spark.createDataFrame([(1, " ".join([long] * 6 + [long + "w"] * 31))], "doc_id long, text string")
    got = {len(x.word): x for x in spelling_variants(docs).collect()}
    assert got[30000].form == long + "w" and got[30001].form is None and got[30000].n_near == got[30001].n_near == 1
    clash = odd.withColumns({c: F.lit("x") for c in ("word", "n", "key", "long", "lo", "hi", "slot")})
    got = rows(spelling_variants(clash))
    assert got == sorted(map(repr, brute([(x.doc_id, x.text) for x in odd.collect()])))
    assert spelling_variants(nothing).collect() == []
