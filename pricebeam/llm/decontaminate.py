"""Benchmark decontamination: spaced seeds find places, alignments that tolerate substitutions judge them."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebeam.llm.blocks import PAYLOAD, TEXT, packed, with_columns
from pricebeam.llm.textarrays import BASE, Words, column_bytes, mixed, powers
from pricebeam.session import discard, scratch_path

#: Spaced seeds (fixed values): places with 0 may differ. Seven words have to agree. Every segment with four
#: equal words of five and twelve equal words holds at least one of them.
MASKS = ("110100110101", "101100101011", "111011001001", "11110111", "11100011011", "1011010100011", "1000111111")
#: Items under this many words have seeds of their own.
SHORT = 15
#: Least words of short items, how many of the first so many may differ, and the groups these are parted into:
#: of all choices of groups that leave so many out, one holds equal words only. Still shorter items agree wholly.
TIERS = ((10, 2, 5), (8, 1, 3), (5, 1, 3))
#: Weight of a differing word against an equal one: segments that pay have four equal words of five.
MISMATCH = 4
#: Bytes of benchmark text that tasks hold at a time.
BENCH_BYTES = 2 << 20
#: Pairs of equal seeds that are looked at at a time.
PAIRS = 1 << 20
#: Texts are taken in slices of about this many bytes, and a text's words so many at a time.
SLICE_BYTES, PIECE = 1 << 20, 1 << 17

#: Bytes between words: white space and ASCII punctuation. A-Z are lowered.
BETWEEN = np.array([not (chr(b).isalnum() or b >= 0x80) for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

HIT = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("n_equal", T.IntegerType()),
                    T.StructField("n_words", T.IntegerType()), T.StructField("doc_word", T.IntegerType()),
                    T.StructField("item_word", T.IntegerType())])


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each text's first word (n + 1)."""
    data, offsets = column_bytes(column)
    words = Words(LOWER[data], offsets, BETWEEN)
    return words.hashes(seed=11), words.first


def _seeds(symbols: np.ndarray, first: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the mask at each position where it lies within one text."""
    span, n = len(mask), len(symbols)
    if n < span:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    weights = powers(BASE, span)
    total = np.zeros(n - span + 1, np.uint64)
    for i, kept in enumerate(mask):
        if kept == "1":
            total += symbols[i : n - span + 1 + i] * weights[i]
    end = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(n - span + 1) + span <= end[: n - span + 1])
    return mixed(total[at] + np.uint64(span)), at


def short_masks(length: int) -> list[tuple[str, int]]:
    """(mask, its place in the item) for items of `length` < SHORT words. Four words of five agree at least,
    so one of these does."""
    for words, differ, groups in TIERS:
        if length >= words:
            cuts = [words * i // groups for i in range(groups + 1)]
            found = []
            for out in combinations(range(groups), differ):
                mask = "".join(("0" if g in out else "1") * (cuts[g + 1] - cuts[g]) for g in range(groups))
                found.append((mask.strip("0"), mask.index("1")))
            return found
    return [("1" * length, 0)] if length else []


class BenchIndex:
    """Seeds of a bounded block of benchmark items. Items under SHORT words have seeds at fixed places."""

    def __init__(self, ids: list[int | None], texts: list[str | None], least: int):
        self.ids, self.least = ids, least
        self.symbols, self.first = _tokens(pa.array(texts, pa.string()))
        lengths = np.diff(self.first)
        self.need = np.minimum(least, -(-4 * lengths // 5))
        places: dict[str, set[tuple[int, int]]] = {mask: set() for mask in MASKS}  # lengths and places of short items
        for n in np.unique(lengths[lengths < SHORT]).tolist():
            for mask, place in short_masks(n):
                places.setdefault(mask, set()).add((n, place))
        self.masks: list[tuple[str, np.ndarray, np.ndarray, np.ndarray]] = []
        for mask, wanted in places.items():
            hashes, at = _seeds(self.symbols, self.first, mask)
            item = np.searchsorted(self.first, at, side="right") - 1
            own = (lengths[item] >= SHORT) & (mask in MASKS)
            for n, place in wanted:
                own |= (lengths[item] == n) & (at - self.first[item] == place)
            hashes, at = hashes[own], at[own]
            if not len(hashes):
                continue
            order = np.argsort(hashes, kind="stable")
            hashes, at = hashes[order], at[order]
            bits = min(26, max(10, int(len(hashes)).bit_length() + 6))
            gate = np.zeros(1 << bits, bool)
            gate[(hashes >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.masks.append((mask, hashes, at, gate))

    def hits(self, symbols: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, equal words, words, first word in the text, first word in the item): for each
        text and item that overlap, the best overlap."""
        found = [np.zeros((0, 3), np.int64)]
        for mask, hashes, at, gate in self.masks:
            bits = np.uint64(64 - (len(gate).bit_length() - 1))
            passed = []
            for a in range(0, max(1, len(symbols)), PIECE):
                end = min(len(symbols), a + PIECE + len(mask) - 1)
                seed, place = _seeds(symbols[a:end], np.clip(first - a, 0, end - a), mask)
                open_ = gate[(seed >> bits).astype(np.int64)]
                passed.append((seed[open_], place[open_] + a))
            seed, place = (np.concatenate(x) for x in zip(*passed))
            low, high = np.searchsorted(hashes, seed), np.searchsorted(hashes, seed, side="right")
            times = high - low
            total = np.concatenate([[0], np.cumsum(times)])
            for begin in range(0, int(total[-1]), PAIRS):
                pair = np.arange(begin, min(begin + PAIRS, int(total[-1])))
                of = np.searchsorted(total, pair, side="right") - 1
                mine, theirs = place[of], at[low[of] + pair - total[of]]
                text = np.searchsorted(first, mine, side="right") - 1
                item = np.searchsorted(self.first, theirs, side="right") - 1
                shift = (mine - first[text]) - (theirs - self.first[item])
                found.append(self._likely(symbols, first, np.unique(np.stack([text, item, shift], axis=1), axis=0)))
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for t, i, s in np.unique(np.concatenate(found), axis=0).tolist():
            overlap = self._overlap(symbols[first[t] : first[t + 1]], self.symbols[self.first[i] : self.first[i + 1]], s,
                                    int(self.need[i]))
            if overlap and overlap > best.get((t, i), (0,)):
                best[t, i] = overlap
        return [(*key, x[0], x[0] - x[1], -x[2], -x[3]) for key, x in best.items()]

    def _likely(self, symbols: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Those (text, item, shift) with enough equal words in the whole alignment."""
        text, item, shift = rows.T
        begin = np.maximum(0, -shift)
        size = np.minimum(self.first[item + 1] - self.first[item], first[text + 1] - first[text] - shift) - begin
        total, kept, a = np.concatenate([[0], np.cumsum(size)]), [], 0
        while a < len(rows):
            b = max(a + 1, int(np.searchsorted(total, total[a] + PAIRS, side="right")) - 1)
            of = np.repeat(np.arange(a, b), size[a:b])
            word = np.arange(total[a], total[b]) - total[of] + begin[of]
            same = self.symbols[self.first[item[of]] + word] == symbols[first[text[of]] + shift[of] + word]
            kept.append(np.bincount(of[same] - a, minlength=b - a) >= self.need[item[a:b]])
            a = b
        return rows[np.concatenate(kept)] if kept else rows

    def _overlap(self, text: np.ndarray, item: np.ndarray, shift: int, need: int) -> tuple[int, int, int, int] | None:
        """The segment of the alignment with the most equal words against differing ones or, if that is too
        short, the one with the most equal words of those in which four words of five agree; None if both
        are too short: (equal, -differing, -place in the text, -place in the item)."""
        a, b = max(0, -shift), min(len(item), len(text) - shift)
        same = item[a:b] == text[a + shift : b + shift]
        sums = np.concatenate([[0], np.cumsum(np.where(same, 1, -MISMATCH))])
        gain = sums - np.minimum.accumulate(sums)
        end = int(np.argmax(gain))
        begin = int(np.flatnonzero(sums[: end + 1] == sums[: end + 1].min())[-1])
        equal = int(same[begin:end].sum())
        if equal < need:
            begin, end = _agreeing(same, sums)
            equal = int(same[begin:end].sum())
        if equal < need:
            return None
        return equal, -(end - begin - equal), -(a + begin + shift), -(a + begin)


def _agreeing(same: np.ndarray, sums: np.ndarray) -> tuple[int, int]:
    """The segment with the most equal words, of those the fewest words, whose sum is not negative."""
    at = np.flatnonzero(same)
    if not len(at):
        return 0, 0
    ahead = np.maximum.accumulate(sums[::-1])  # the largest sum from each place on, from the last place
    far = len(sums) - 1 - np.searchsorted(ahead, sums[at])  # the last place with a sum as large
    count = np.searchsorted(at, far)  # equal words before it
    last = at[count - 1] + 1
    best = np.lexsort((last - at, -(count - np.arange(len(at)))))[0]
    return int(at[best]), int(last[best])


def _blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[tuple[list, list]]:
    """Benchmark items in blocks of about BENCH_BYTES; one block at a time is on the driver."""
    rows = benchmark.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BENCH_BYTES)
    for b in range(blocks):
        part = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == b)
        items = part.filter("text IS NOT NULL").orderBy("key", "text").collect()
        yield [x.key for x in items], [x.text for x in items]


def with_overlaps(docs: DataFrame, benchmark: DataFrame, least: int = 12, text: str = "text",
                  key: str = "item_id") -> DataFrame:
    """The columns of `docs` and hits: for each benchmark item that a text overlaps, how.

    Words are runs of letters, digits and non-ASCII characters, A-Z lowered. Texts and items that share
    a spaced seed are aligned there. A segment of the alignment in which at least four of five words agree
    must have `least` equal words, or four fifths of the item's words if these are fewer. The best segment
    in which each differing word costs four equal ones is given if it has them, else the one with the most
    equal words. With `least` 12 or more the seeds miss no such segment.

    Benchmark items are held in blocks of bounded size; documents are scanned once per block and never
    shuffled, whatever they repeat. Null and empty texts and items overlap nothing; items that repeat are
    separate hits. hits replaces a column of that name.
    """
    spark = docs.sparkSession
    thin = packed(docs, text)
    schema = T.StructType([*thin.schema.fields, T.StructField("hits", T.ArrayType(HIT))])
    now = thin.withColumn("hits", F.array().cast(T.ArrayType(HIT)))
    paths: list[str] = []
    for block, (ids, texts) in enumerate(_blocks(benchmark, key, text)):
        if block:  # each further block reads what the block before has written
            paths.append(scratch_path(spark, "overlaps"))
            now.write.parquet(paths[-1])
            now = spark.read.schema(schema).parquet(paths[-1])
            if block > 1:
                discard(spark, paths[-2])
        now = now.mapInArrow(_finder(spark.sparkContext.broadcast(BenchIndex(ids, texts, least))), schema)
    return with_columns(now, docs, text, "hits")


def _finder(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            lists = batch.column(2).to_pylist()
            sizes = np.diff(column_bytes(batch.column(0))[1])
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES)) + 1).tolist(), len(sizes)]
            for a, b in zip(cuts, cuts[1:]):
                for t, i, equal, words, at, place in index.hits(*_tokens(batch.column(0).slice(a, b - a))):
                    lists[a + t].append({"item_id": index.ids[i], "n_equal": equal, "n_words": words,
                                         "doc_word": at, "item_word": place})
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, HIT_ARROW)],
                                             names=[TEXT, PAYLOAD, "hits"])
    return work


HIT_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("n_equal", pa.int32()), ("n_words", pa.int32()),
                                ("doc_word", pa.int32()), ("item_word", pa.int32())]))


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = 12, text: str = "text", doc_key: str = "doc_id",
             key: str = "item_id") -> DataFrame:
    """One row per document and benchmark item that overlap: (doc key, item_id, n_equal, n_words, doc_word,
    item_word). See `with_overlaps`."""
    return (with_overlaps(docs.select(doc_key, text), benchmark, least, text, key)
            .select(doc_key, F.explode("hits").alias("hit")).select(doc_key, "hit.*"))


def without_overlaps(docs: DataFrame, benchmark: DataFrame, least: int = 12, text: str = "text",
                     key: str = "item_id") -> DataFrame:
    """The rows of `docs` that overlap no benchmark item."""
    found = with_overlaps(docs, benchmark, least, text, key)
    return found.filter(F.size("hits") == 0).select(*docs.columns)
