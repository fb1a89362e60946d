"""Ranked lexical search: documents are grouped by the mask of the terms they share with an item, and
masks are scored in the order of the most that they can reach."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebeam.llm.blocks import sliced
from pricebeam.session import materialize

#: Bits of the filter that tells which words may be a term of an item. It is as large for any benchmark; with more
#: than some millions of different terms it lets more words pass, and never keeps one back.
GATE_BITS = 1 << 24
#: Bytes of item terms that tasks hold at a time.
ITEM_BYTES = 2 << 20
#: Documents that are scored before the next look at the bounds; doubled after each look.
STEP = 64
#: Bytes of a text that are cut into terms at a time.
PIECE = 1 << 20

#: Everything but letters, digits and non-ASCII separates terms; A-Z are lowered.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256))


def term_counts(text: str | None) -> Counter:
    """Terms `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`, A-Z lowered, as UTF-8, with their numbers."""
    data, counts, at = (text or "").encode().translate(TERM_BYTES), Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split())
        at = end
    return counts


def _postings(gate):
    """(doc, n, terms, times): documents with a term, and those of their terms that pass the gate."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, mask = gate.value, GATE_BITS - 1
        for batch in sliced(batches, text=1):
            sizes, terms, times, kept = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                counts = term_counts(text)
                if not counts:
                    continue
                kept.append(i)
                sizes.append(counts.total())
                mine = [t for t in counts if bits[(h := crc32(t) & mask) >> 3] >> (h & 7) & 1]
                terms.append(mine)
                times.append([counts[t] for t in mine])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.array(terms, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))],
                names=["doc", "n", "terms", "times"])
    return work


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = term_counts(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(counts), pa.int64()), pa.array(list(counts), pa.binary()),
                 pa.array(list(counts.values()), pa.int64())], names=["number", "term", "times"])


def _gate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(GATE_BITS, bool)
    for batch in batches:
        bits[[crc32(t) & GATE_BITS - 1 for t in batch.column(0).to_pylist()]] = True
    at = np.flatnonzero(np.packbits(bits, bitorder="little"))
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()),
                                      pa.array(np.packbits(bits, bitorder="little")[at], pa.int16())], names=["at", "bits"])


class Items:
    """A bounded block of items: terms with document counts, and each item's terms with weights."""

    def __init__(self, rows: list, documents: int, terms: int):
        self.documents, self.total = documents, terms
        self.vocabulary = sorted({x.term for x in rows})
        place = {t: i for i, t in enumerate(self.vocabulary)}
        mine: dict[int, list[tuple[int, int]]] = {}
        for x in rows:
            weight = x.times * math.floor(1000 * math.log((2 * documents + 2) / (2 * x.df + 1)))
            if weight > 0:  # a term of weight 0 adds nothing
                mine.setdefault(x.number, []).append((place[x.term], weight))
        self.items = {k: (np.array([t for t, _ in v]), np.array([w for _, w in v], np.int64)) for k, v in mine.items()}


class _Block:
    """Postings of the documents of a batch, by term, with each posting's share of a term's weight."""

    def __init__(self, batch: pa.RecordBatch, items: Items, vocabulary: pa.Array):
        lists = batch.column(2)
        owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
        term = pc.fill_null(pc.index_in(lists.flatten(), value_set=vocabulary), -1).to_numpy()
        times = batch.column(3).flatten().to_numpy()
        mine = term >= 0
        owner, term, times = owner[mine], term[mine], times[mine].astype(np.int64)
        length = np.array([75 + 25 * n * items.documents // items.total for n in batch.column(1).to_pylist()], np.int64)
        order = np.argsort(term, kind="stable")
        self.owner, times = owner[order], times[order]
        self.share = 1_000_000_000 * times // (1000 * times + 12 * length[self.owner])
        self.bounds = np.searchsorted(term[order], np.arange(len(vocabulary) + 1))
        self.n = batch.num_rows
        used = np.flatnonzero(np.diff(self.bounds))
        self.most = np.zeros(len(vocabulary), np.int64)
        if len(used):
            self.most[used] = np.maximum.reduceat(self.share, self.bounds[used])
        self.rank = pc.rank(batch.column(0), sort_keys="ascending", null_placement="at_end", tiebreaker="first").to_numpy()

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents with any of the terms, their masks in words of 64 bits)."""
        masks = np.zeros((self.n, -(-len(terms) // 64)), np.uint64)
        for k, t in enumerate(terms):
            masks[self.owner[self.bounds[t] : self.bounds[t + 1]], k >> 6] |= np.uint64(1 << (k & 63))
        docs = np.flatnonzero(masks.any(axis=1))
        return docs, masks[docs]

    def scores(self, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of documents, given in ascending order."""
        total = np.zeros(len(docs), np.int64)
        for t, w in zip(terms, weights):
            a, b = self.bounds[t], self.bounds[t + 1]
            if a < b:
                at = np.minimum(np.searchsorted(self.owner[a:b], docs), b - a - 1) + a
                total += np.where(self.owner[at] == docs, w * self.share[at], 0)
        return total

    def search(self, terms: np.ndarray, weights: np.ndarray, count: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores): the best `count` of this block, of those that score at least `least` and more than
        0. Groups of equal masks are taken by falling bound until no bound left reaches the last of the best."""
        used = self.bounds[terms] < self.bounds[terms + 1]
        terms, weights = terms[used], weights[used]
        if not len(terms) or (weights * self.most[terms]).sum() < least:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, masks = self.masks(terms)
        order = np.lexsort(masks.T)
        docs, masks = docs[order], masks[order]
        first = np.flatnonzero(np.concatenate([[True], (masks[1:] != masks[:-1]).any(axis=1)]))
        size = np.diff(np.append(first, len(docs)))
        groups, bound = masks[first], np.zeros(len(first), np.int64)
        for k, (t, w) in enumerate(zip(terms, weights)):
            bound[(groups[:, k >> 6] >> np.uint64(k & 63) & np.uint64(1)) > 0] += w * self.most[t]
        falling = np.argsort(-bound, kind="stable")
        ends = np.cumsum(size[falling])
        best_docs, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        done, step = 0, STEP
        while done < len(falling) and bound[falling[done]] >= max(least, 1):
            until = min(len(falling), int(np.searchsorted(ends, (ends[done - 1] if done else 0) + step)) + 1)
            taken = falling[done:until]
            taken = taken[bound[taken] >= max(least, 1)]
            starts = np.repeat(first[taken] - np.cumsum(size[taken]) + size[taken], size[taken])
            mine = np.sort(docs[starts + np.arange(len(starts))])
            score = self.scores(mine, terms, weights)
            best_docs, best = np.append(best_docs, mine), np.append(best, score)
            kept = np.flatnonzero(best >= max(least, 1))
            kept = kept[np.lexsort((self.rank[best_docs[kept]], -best[kept]))[:count]]
            best_docs, best = best_docs[kept], best[kept]
            if len(best) == count:
                least = max(least, int(best[-1]))
            done, step = until, step * 2
        return best_docs, best


def _searcher(shared, count: int, arrow: pa.DataType):
    """Each task keeps the best of every item over all its documents."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        vocabulary = pa.array(items.vocabulary, pa.binary())
        best: dict[int, list[tuple]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            block = _Block(batch, items, vocabulary)
            for number, (terms, weights) in items.items.items():
                have = best.setdefault(number, [])
                docs, scores = block.search(terms, weights, count, have[-1][0] if len(have) == count else 0)
                if len(docs):
                    keys = batch.column(0).take(pa.array(docs)).to_pylist()
                    have += zip(scores.tolist(), [k is None for k in keys], keys)
                    have.sort(key=lambda x: (-x[0], x[1], 0 if x[1] else x[2]))
                    del have[count:]
        for number, rows in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(rows), pa.int64()), pa.array([x[2] for x in rows], arrow),
                 pa.array([x[0] for x in rows], pa.int64())], names=["number", "doc", "score"])
    return work


def ranked_search(docs: DataFrame, items: DataFrame, count: int = 20, text: str = "text", doc_key: str = "doc_id",
                  key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item key, rank, doc key, score): for each row of `items` the `count` rows of `docs` with the highest score
    above 0, highest first, ties by ascending doc key, null keys last.

    Terms, weights and scores are whole numbers as `ORACLE` has them: a term weighs
    floor(1000 ln((2N + 2) / (2 df + 1))), a document's share of it falls with its length, and a term that the item
    repeats counts as often. Null, empty and blank texts have no terms: such documents do not count for N and are
    never found, such items have no rows. Repeated rows are documents and items of their own, so an item that
    occurs twice has its list twice. Empty tables give no rows.

    Documents are cut into terms once, and only those of their terms that pass a filter of the items' terms (of
    fixed size) are kept. Tasks hold items in blocks of bounded size, keep the best of each item over all their
    documents, and only these are shuffled.
    """
    spark = docs.sparkSession
    wanted = materialize(items.select(F.col(f"`{key}`").alias("item"), F.col(f"`{item_text}`").cast("string").alias("text"))
                         .withColumn("number", F.monotonically_increasing_id()), "items")
    terms = materialize(wanted.filter("text IS NOT NULL").select("number", "text")
                        .mapInArrow(_item_terms, "number long, term binary, times long"), "item-terms")
    bits = bytearray(GATE_BITS // 8)
    for x in (terms.select("term").mapInArrow(_gate, "at int, bits short")
              .groupBy("at").agg(F.bit_or("bits").alias("bits")).toLocalIterator()):
        bits[x.at] = x.bits
    thin = docs.select(F.col(f"`{doc_key}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc", thin.schema["doc"].dataType), T.StructField("n", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.BinaryType())), T.StructField("times", T.ArrayType(T.LongType()))])
    gate = spark.sparkContext.broadcast(bytes(bits))
    postings = materialize(thin.mapInArrow(_postings(gate), schema), "postings")
    documents, total = postings.agg(F.count("*"), F.sum("n")).first()
    held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weighed = materialize(terms.join(held, "term"), "weighed")
    size = weighed.agg(F.sum(F.octet_length("term") + 32)).first()[0] or 0
    blocks = max(1, -(-size // ITEM_BYTES))
    found = spark.createDataFrame([], T.StructType([T.StructField("number", T.LongType()), schema["doc"],
                                                    T.StructField("score", T.LongType())]))
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(schema["doc"].dataType)
    for b in range(blocks):
        rows = weighed.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == b).collect()
        if rows:
            shared = spark.sparkContext.broadcast(Items(rows, documents, total))
            found = found.union(postings.mapInArrow(_searcher(shared, count, arrow), found.schema))
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)
    return best.join(wanted.select("number", "item"), "number").select(
        F.col("item").alias(key), "rank", F.col("doc").alias(doc_key), "score")


ORACLE = """
WITH cut AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
wanted AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
total AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM cut WHERE len(terms) > 0),
held AS (
    SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM cut)
    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total),
shares AS (
    SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)) AS share FROM held, total),
scores AS (
    SELECT item_id, doc_id, sum(times * w * share)::BIGINT AS score
    FROM wanted JOIN weights USING (term) JOIN shares USING (term) GROUP BY item_id, doc_id),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
