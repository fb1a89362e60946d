"""Spelling variants: words one edit apart, found by comparing tiles of padded code-point matrices."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebeam.llm.blocks import sliced
from pricebeam.session import discard, materialize, written

#: Every so many-th hash loses a code point (fixed value of the contract).
DAMAGED = 199
#: Least code points of a word, and least occurrences.
LENGTH, TIMES = 6, 5
#: A form is at least so many times as frequent as the word.
RATIO = 5
#: Words that a task counts before it sends them.
HELD = 200_000
#: A group of words that agree outside of a segment is cut by finer segments if it has more words than this.
GROUP = 2048
#: Rows of a tile.
TILE = 64
#: Numbers of a comparison at a time.
CELLS = 1 << 21
#: Rows of a slot.
SLOT_ROWS = 200_000

COUNTS = "word string, n long"
NEAR = "word string, n_near long, form_n long, form string"


def _counted(least: int):
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in sliced(batches, text=1):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                begin = crc32(f"{key or ''}:".encode())
                lowered = text.encode().lower().decode()
                for run, n in Counter(m.group() for m in runs.finditer(lowered)).items():
                    h = crc32(run.encode(), begin)
                    if h % DAMAGED == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                    if len(run) >= least:
                        total[run] += n
            if len(total) >= HELD:
                yield _table(total)
                total = Counter()
        yield _table(total)
    return work


def _table(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                      names=["word", "n"])


def word_counts(docs: DataFrame, least: int = LENGTH, times: int = TIMES, text: str = "text",
                key: str = "doc_id") -> DataFrame:
    """(word, n): runs `[A-Za-z\\u00C0-\\u00FF]+` of whole texts, A-Z lowered, of which those whose crc32 (with the
    document's key) 199 divides have lost a code point; words of at least `least` code points that occur at least
    `times` times. A null text has none; a null key counts as an empty one. Counts are summed before the shuffle."""
    thin = docs.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return (thin.mapInArrow(_counted(least), COUNTS).groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= times))


#: A row for a word and a segment [lo, hi) of the places of the longer word of a pair, which has `long` code points:
#: near words whose first difference lies in the segment agree before and after it.
_KEY = "concat(left(word, lo), '\\u0000', right(word, long - hi))"


def _segments(words: DataFrame) -> DataFrame:
    """(word, n, long, lo, hi, key): each word as the longer and as the shorter of a pair, in three segments."""
    size = F.char_length("word")
    longer = F.explode(F.array(size, size + 1)).alias("long")
    rows = words.select("word", "n", longer)
    return _keyed(rows.select("word", "n", "long", F.expr(
        "explode(array(struct(0 AS lo, long div 3 AS hi), struct(long div 3 AS lo, 2 * long div 3 AS hi),"
        " struct(2 * long div 3 AS lo, long AS hi))) AS s")).select("word", "n", "long", "s.lo", "s.hi"))


def _keyed(rows: DataFrame) -> DataFrame:
    rows = rows.select("word", "n", *[F.col(c).cast("int") for c in ("long", "lo", "hi")]).filter("lo < hi")
    return rows.withColumn("key", F.expr(_KEY))


def _bounded(rows: DataFrame, most: int) -> DataFrame:
    """Groups over `most` words are cut by halves of their segment until none is, or the segment is one place,
    where a group has at most one word for each code point."""
    by, path = ["long", "lo", "hi", "key"], None
    while True:
        large = materialize(rows.groupBy(by).count().filter((F.col("count") > most) & (F.col("hi") - F.col("lo") > 1)), "large")
        if large.isEmpty():
            return rows
        met = rows.join(large, by, "left")
        halves = F.expr("explode(array(struct(lo AS lo, (lo + hi) div 2 AS hi), struct((lo + hi) div 2 AS lo, hi AS hi))) AS s")
        finer = _keyed(met.filter("count IS NOT NULL").select("word", "n", "long", halves)
                       .select("word", "n", "long", "s.lo", "s.hi"))
        rows, after = written(met.filter("count IS NULL").select(rows.columns).union(finer.select(rows.columns)), "segments")
        if path:
            discard(rows.sparkSession, path)
        path = after


def _matrices(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points from the left and from the right, padded with zeros."""
    left = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    right = np.frombuffer(b"".join(w[::-1].ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    return left, right


def near_pairs(words: list[bytes], groups: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int) -> np.ndarray:
    """(place, place), both ways, of all words of a group (equal numbers side by side) that are one edit apart, the
    longer has `width` code points and the common prefix ends in [lo, hi). Groups are cut into blocks; pairs of
    blocks are compared as dense tiles: common prefix and suffix together reach the width less one."""
    left, right = _matrices(words, width)
    size = np.array([len(w) for w in words])
    new = np.ones(len(groups), bool)
    new[1:] = groups[1:] != groups[:-1]
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(groups)))
    tile = max(1, min(TILE, int((CELLS / width) ** 0.5)))
    pairs = []  # (first block's start and size, second block's)
    small = (lengths > 1) & (lengths <= tile)
    pairs.append(np.stack([starts[small], lengths[small], starts[small], lengths[small]], axis=1))
    large = lengths > tile
    for a, n in zip(starts[large].tolist(), lengths[large].tolist()):
        at = np.arange(0, n, tile)
        p, q = np.triu_indices(len(at))
        pairs.append(np.stack([a + at[p], np.minimum(tile, n - at[p]), a + at[q], np.minimum(tile, n - at[q])], axis=1))
    pairs = np.concatenate(pairs)
    largest = np.maximum(pairs[:, 1], pairs[:, 3])
    pairs, largest = pairs[np.argsort(largest, kind="stable")], np.sort(largest)
    found, i = [np.zeros((0, 2), np.int64)], 0
    while i < len(pairs):
        j = i + 1
        while j < len(pairs) and (j - i + 1) * int(largest[j]) ** 2 * width <= CELLS:
            j = min(len(pairs), j + max(1, (j - i) // 4))
        side = int(largest[j - 1])
        at = np.arange(side)
        a, an, b, bn = (pairs[i:j, k][:, None] for k in range(4))
        row, column = np.minimum(a + at, len(words) - 1), np.minimum(b + at, len(words) - 1)
        for part in _parts(len(row), side * side * width):
            x, y = row[part], column[part]
            prefix = np.argmin(left[x][:, :, None, :] == left[y][:, None, :, :], axis=3)
            suffix = np.argmin(right[x][:, :, None, :] == right[y][:, None, :, :], axis=3)
            near = (prefix + suffix >= width - 1) & (x[:, :, None] != y[:, None, :])
            near &= (prefix >= lo[x][:, :, None]) & (prefix < hi[x][:, :, None])
            near &= (at < an[part])[:, :, None] & (at < bn[part])[:, None, :]
            near &= np.maximum(size[x][:, :, None], size[y][:, None, :]) == width
            of, k, l = np.nonzero(near)
            one = np.stack([x[of, k], y[of, l]], axis=1)
            found.append(one)
            found.append(one[a[part][of, 0] != b[part][of, 0]][:, ::-1])
        i = j
    return np.concatenate(found)


def _parts(n: int, cells: int) -> Iterator[slice]:
    step = max(1, CELLS // max(cells, 1))
    for at in range(0, n, step):
        yield slice(at, at + step)


def _tiles(table: pa.Table) -> pa.Table:
    """Near words of each word of a slot: how many, and the most frequent."""
    table = table.select(["word", "n", "long", "lo", "hi", "key"]).sort_by(
        [(c, "ascending") for c in ("long", "lo", "hi", "key", "word")]).combine_chunks()
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    long, lo, hi, n = (table.column(c).to_numpy() for c in ("long", "lo", "hi", "n"))
    key = table.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
    new = np.ones(len(key), bool)
    for c in (long, lo, hi, key):
        new[1:] &= c[1:] == c[:-1]
    new[1:] = ~new[1:]
    group = np.cumsum(new)
    pairs = [np.zeros((0, 2), np.int64)]
    cuts = np.flatnonzero(np.concatenate([[True], long[1:] != long[:-1]])).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(words)]):
        pairs.append(near_pairs(words[a:b], group[a:b], lo[a:b], hi[a:b], int(long[a])) + a)
    one, other = np.concatenate(pairs).T
    distinct = {w: i for i, w in enumerate(sorted(set(words)))}
    number = np.array([distinct[w] for w in words])
    order = np.lexsort((number[other], -n[other], number[one]))
    one, other = one[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], number[one][1:] != number[one][:-1]])) if len(one) else np.zeros(0, int)
    return pa.table({
        "word": pa.array([words[i].decode("latin-1") for i in one[first]], pa.string()),
        "n_near": pa.array(np.diff(np.append(first, len(one))), pa.int64()),
        "form_n": pa.array(n[other[first]], pa.int64()),
        "form": pa.array([words[i].decode("latin-1") for i in other[first]], pa.string()),
    })


def _near(words: DataFrame, group: int) -> DataFrame:
    """`NEAR` of each word that has a near word."""
    spark = words.sparkSession
    rows = _bounded(_segments(words), group)
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words.count() * 6 // SLOT_ROWS)
    found = (rows.withColumn("slot", F.pmod(F.xxhash64("long", "lo", "hi", "key"), F.lit(slots)))
             .groupBy("slot").applyInArrow(_tiles, NEAR))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms are followed to the last. A form is more frequent than its word by a
    factor, so chains are short and have no rings; each round doubles the steps taken."""
    now, path = written(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after, written_path = written(now.join(step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        discard(links.sparkSession, path)
        now, path = after.drop("moved"), written_path
        if after.filter("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, least: int = LENGTH, times: int = TIMES, ratio: int = RATIO, text: str = "text",
                      key: str = "doc_id", group: int = GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of `word_counts`.

    Near words differ by exactly one inserted, deleted or replaced code point; all are counted. The form is the most
    frequent of them, of equal ones the first in code-point order, if it is at least `ratio` times as frequent as
    the word, else null; form_n is its number. The root is the last form of the chain, or the word itself.

    Words meet in groups that agree outside of a segment (a third of the places of the longer word, cut further
    where more than `group` words agree), so each near pair meets exactly once, in the segment that holds its
    first difference. Repeated rows count again. Empty tables and texts without words give no rows.
    """
    words = materialize(word_counts(docs, least, times, text, key), "words")
    near = materialize(_near(words, group), "near")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"))
    found = materialize(found.select("word", "n", "n_near", F.col("best.form").alias("form"),
                                     (-F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
