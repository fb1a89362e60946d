"""Substring, suffix and near dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from pricebeam.llm import simhash, suffixes
from pricebeam.llm.components import connected
from pricebeam.llm.simhash import GrayIndex, fingerprint, gray_rank, near_groups, one_of_each_group, simhash_components
from pricebeam.llm.substrings import COVERS, remove_repeated_windows
from pricebeam.llm.suffixes import deep_shallow_sort, remove_repeated_bytes, sliding_minimum


def covered(units, window, counts):
    gone = [False] * len(units)
    for k in range(len(units) - window + 1):
        if counts[tuple(units[k : k + window])] > 1:
            gone[k : k + window] = [True] * window
    return gone


def windows_of(all_units, window):
    counts = Counter()
    for units in all_units:
        for k in range(len(units) - window + 1):
            counts[tuple(units[k : k + window])] += 1
    return counts


@pytest.mark.parametrize("period", list(COVERS))
def test_covers_reach_every_pair(period):
    cover = COVERS[period]
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


@pytest.mark.parametrize("window", [3, 35])
def test_substrings(texts, window):
    rows = texts.collect()
    units = [(x.text or "").encode().split() for x in rows]
    counts = windows_of(units, window)
    expected = []
    for x, words in zip(rows, units):
        gone = covered(words, window, counts)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        expected.append((x.doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest(),
                         kept.decode() if any(gone) else x.text))
    got = [tuple(x) for x in remove_repeated_windows(texts, window).select(
        "doc_id", "n_words", "n_removed", "kept_sha256", "text").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


@pytest.mark.parametrize("slice_,hot", [(suffixes.SORTED, suffixes.HOT_SEGMENTS), (100, 1)])
def test_suffixes(texts, slice_, hot):
    rows = texts.collect()
    units = [(x.text or "").encode() for x in rows]
    counts = Counter()
    for data in units:
        for k in range(len(data) - 199):
            counts[hash(data[k : k + 200])] += 1
    expected = []
    for x, data in zip(rows, units):
        gone = bytearray(len(data))
        for k in range(len(data) - 199):
            if counts[hash(data[k : k + 200])] > 1:
                gone[k : k + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = [s for s in bytes(gone).split(b"\0") if s]
        expected.append((x.doc_id, len(data), sum(gone), len(spans), hashlib.sha256(kept).hexdigest()))
    result = remove_repeated_bytes(texts, 200, hot_segments=hot, sorted_at_once=slice_)
    got = result.collect()
    assert sorted(map(repr, ((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got))) == sorted(map(repr, expected))
    assert all(sum(s.end - s.start for s in x.spans) == x.n_removed and len(x.spans) == x.n_spans for x in got)


@pytest.mark.parametrize("seed", range(25))
def test_deep_shallow_sort(seed):
    rng = random.Random(seed)
    depth = rng.choice([5, 24, 27, 64, 200])
    letters = rng.choice([b"a", b"ab", b"\x00\xffq"])
    base = bytes(rng.choice(letters) for _ in range(rng.choice([3, 10, 100])))
    data = b"".join(rng.choice([base, bytes([rng.choice(letters)])]) for _ in range(rng.choice([1, 50, 300]))) + b"z" * depth
    starts = np.arange(len(data) - depth + 1)
    order, same = deep_shallow_sort(np.frombuffer(data, np.uint8), starts, depth, shallow=rng.choice([8, 24]))
    found = [data[i : i + depth] for i in order]
    assert found == sorted(found)
    assert same.tolist() == [False] + [a == b for a, b in zip(found, found[1:])]


def test_sliding_minimum():
    values = np.array([random.Random(4).randrange(1000) for _ in range(200)], np.uint64)
    for width in (1, 7, 64, 200, 300):
        assert sliding_minimum(values, width).tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def plain_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= distance:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("limit", [simhash.BUCKET_LIMIT, 3])
def test_simhash(texts, monkeypatch, limit):
    monkeypatch.setattr(simhash, "BUCKET_LIMIT", limit)
    rows = texts.collect()
    prints = [plain_fingerprint(x.text) for x in rows]
    assert prints == [fingerprint(x.text) for x in rows]
    groups = plain_groups(prints, 4)
    least = {}
    for x, g in zip(rows, groups):
        if x.doc_id is not None:
            least[g] = min(least.get(g, x.doc_id), x.doc_id)
    expected = [(x.doc_id, f"{p:016x}", least.get(g)) for x, p, g in zip(rows, prints, groups)]
    got = [tuple(x) for x in simhash_components(texts).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


@pytest.mark.parametrize("seed", range(6))
def test_gray_index_links_like_brute_force(seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(8)]
    prints = list({rng.choice(centres) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) for _ in range(400)})
    got = GrayIndex(np.zeros(len(prints), np.int64), np.array([p % 2**64 for p in prints], np.uint64)).labels(4)
    expected = plain_groups([p % 2**64 for p in prints], 4)
    assert len(set(zip(got.tolist(), expected))) == len(set(got.tolist())) == len(set(expected))


def test_gray_rank_counts_gray_codes():
    codes = np.array([i ^ (i >> 1) for i in range(256)], np.uint64)
    assert gray_rank(codes).tolist() == list(range(256))


def test_connected(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {x["node"]: x["root"] for x in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for a, b in pairs if a != b for x in (a, b)}


def test_near_groups_of_odd_keys(spark):
    rows = spark.createDataFrame([(None, 5), (None, 4), (7, 5), (9, None), (None, 1 << 40)], "doc_id long, fingerprint long")
    got = sorted(map(repr, ((x.doc_id, x.fingerprint, x.component_id) for x in near_groups(rows, 1).collect())))
    assert got == sorted(map(repr, [(None, 5, 7), (None, 4, 7), (7, 5, 7), (9, None, 9), (None, 1 << 40, None)]))


def test_one_of_each_group(odd):
    kept = one_of_each_group(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    prints = [plain_fingerprint(x.text) for x in odd.collect()]
    assert len(rows) == len(set(plain_groups(prints, 4)))
    assert {(x.doc_id, x.text) for x in rows} >= {(1, ""), (3, "one two three")}


def test_odd_columns_and_empty_tables(odd, nothing):
    cut = remove_repeated_windows(odd)
    assert set(odd.columns) <= set(cut.columns) and cut.count() == odd.count()
    cut = remove_repeated_bytes(odd)
    assert set(odd.columns) <= set(cut.columns) and cut.count() == odd.count()
    assert remove_repeated_windows(nothing).collect() == []
    assert remove_repeated_bytes(nothing).collect() == []
    assert simhash_components(nothing).collect() == []
    assert one_of_each_group(nothing).collect() == []
