"""Substring dedup over words, by difference-cover anchors."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pricebeam.llm.blocks import (
    ASK_SCHEMA, BLOCK, PAYLOAD, ROW, TEXT, Blocks, Distinct, asked, compare, occurs_elsewhere, replies_of, with_columns,
)
from pricebeam.llm.textarrays import RangeHash, Words, column_bytes, marked, mixed, random_table
from pricebeam.session import materialize

#: Perfect difference covers by period (fixed values): for any two positions some shift below the
#: period takes both to a cover position.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}


def period_for(window: int) -> int:
    """The longest period whose anchors still have a third of the window's words."""
    return max(p for p in COVERS if p == 1 or window - p + 1 >= max(2, window // 3))


class _Block:
    """Words of a block, and the anchors of those texts that are at least a window long."""

    def __init__(self, table: pa.Table, window: int):
        self.window, self.period = window, period_for(window)
        self.data, self.offsets = column_bytes(table.column(TEXT))
        self.words = words = Words(self.data, self.offsets)
        self.n = len(words.starts)
        self.symbols = words.hashes()
        self.hash = RangeHash(self.symbols)
        first = np.repeat(words.first[:-1], words.counts)
        last = np.repeat(words.first[1:], words.counts)
        at = np.arange(self.n)
        length = window - self.period + 1
        cover = np.zeros(self.period, bool)
        cover[list(COVERS[self.period])] = True
        self.anchors = np.flatnonzero(
            cover[(at - first) % self.period] & (at + length <= last) & (last - first >= window))
        self.first, self.last, self.length = first, last, length

    def anchor_hashes(self) -> Distinct:
        return Distinct(self.hash.of(self.anchors, self.anchors + self.length))

    def extended(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of all windows around the repeated anchors."""
        at = self.anchors[repeated]
        low = np.maximum(at - self.period + 1, self.first[at])
        high = np.minimum(at, self.last[at] - self.window)
        keep = low <= high
        return np.flatnonzero(marked(low[keep], high[keep] + 1, self.n))

    def window_hashes(self, starts: np.ndarray) -> Distinct:
        """128 bits for each window: two hashes over independent word hashes."""
        second = RangeHash(mixed(self.symbols ^ random_table(1, 77)[0]) + self.words.hashes(seed=2))
        return Distinct(self.hash.of(starts, starts + self.window), second.of(starts, starts + self.window))


def _anchors(window: int, buckets: int):
    def work(table: pa.Table) -> pa.Table:
        distinct = _Block(table, window).anchor_hashes()
        return asked(table.column(BLOCK)[0].as_py(), distinct, (distinct.counts > 1).astype(np.uint8), buckets)
    return work


def _windows(window: int, buckets: int):
    def work(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.int64()),
                             "hashes": pa.array([], pa.binary()), "extra": pa.array([], pa.binary())})
        block = _Block(table, window)
        found = replies_of(answers, 0, "u1")[block.anchor_hashes().inverse] > 0
        distinct = block.window_hashes(block.extended(found))
        return asked(table.column(BLOCK)[0].as_py(), distinct, (distinct.counts > 1).astype(np.uint8), buckets)
    return work


def _removed(window: int):
    def work(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(table, window)
        gone = np.zeros(block.n, bool)
        if answers.num_rows:
            found = replies_of(answers, 0, "u1")[block.anchor_hashes().inverse] > 0
            starts = block.extended(found)
            twice = starts[replies_of(answers, 1, "u1")[block.window_hashes(starts).inverse] > 0]
            gone = marked(twice, twice + window, block.n)
        words = block.words
        removed = np.add.reduceat(np.append(gone, False), words.first[:-1]) * (words.counts > 0) \
            if len(words.counts) else np.zeros(0, np.int64)
        # Kept words joined by one space: copy each kept word and a space, then drop the last space.
        kept_words = ~gone
        lengths = np.where(kept_words, words.ends - words.starts + 1, 0)
        total = np.concatenate([[0], np.cumsum(lengths)])
        out = np.full(int(total[-1]), 0x20, np.uint8)
        inside = marked(words.starts[kept_words], words.ends[kept_words], len(block.data))
        spaces = np.zeros(len(out), bool)
        spaces[total[1:][kept_words] - 1] = True
        out[~spaces] = block.data[inside]
        bounds = total[words.first]
        raw = out.tobytes()
        kept = [raw[a : max(a, b - 1)] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        return pa.table({
            TEXT: pa.array([x.decode("utf-8") if gone else whole for x, gone, whole
                            in zip(kept, removed.tolist(), table.column(TEXT).to_pylist())], pa.string()),
            PAYLOAD: table.column(PAYLOAD),
            "n_words": pa.array(words.counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        })
    return work


def remove_repeated_windows(docs: DataFrame, window: int = 35, text: str = "text") -> DataFrame:
    """Remove each word covered by a `window`-word sequence that starts anywhere else in the corpus.

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged. Windows lie within one row and are judged on the
    input. Anchors (shorter runs of words) are hashed only at positions of a difference cover of the
    period, so two equal windows share an anchor at the same place in both; around each anchor that
    occurs twice, the windows are extended and compared by 128 bits. Every copy goes, the first too.

    Returns the columns of `docs`, where a text that loses words is its kept words joined by one space
    and any other text stays as it is, and n_words, n_removed, kept_sha256 (of the kept words joined by
    one space, in either case). A null or empty text has no words. Rows are not
    told apart by any column, so repeated ids, rows and nulls are ordinary rows. If `docs` has
    columns named like the new ones, the new ones replace them.
    """
    blocks = Blocks(docs, text)
    asks = blocks.each(_anchors(window, blocks.buckets), ASK_SCHEMA)
    anchors = materialize(compare(asks, occurs_elsewhere, 1, "u1", kind=0), "anchors")
    asks = blocks.with_replies(anchors, _windows(window, blocks.buckets), ASK_SCHEMA)
    windows = materialize(compare(asks, occurs_elsewhere, 2, "u1", kind=1), "windows")
    payload = blocks.schema[PAYLOAD]
    schema = T.StructType([T.StructField(TEXT, T.StringType()), payload, T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    result = blocks.with_replies(anchors.union(windows), _removed(window), schema)
    return with_columns(result, docs, text, "n_words", "n_removed", "kept_sha256")


ORACLE = """
WITH words AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w
    FROM documents),
windows AS (
    SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS passage
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY passage) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS j FROM (SELECT doc_id, i, unnest(range(35)) AS k FROM twice)),
kept AS (
    SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.j) AS rest, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM words) p
    LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.j = p.j WHERE g.j IS NULL GROUP BY p.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
