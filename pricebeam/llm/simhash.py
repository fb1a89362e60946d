"""SimHash near-dedup: fingerprints over word shingles, linked through a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebeam.llm.blocks import BLOCK, PAYLOAD, ROW, TEXT, Blocks, packed, sliced, unused, with_columns
from pricebeam.llm.components import connected
from pricebeam.session import materialize

#: XXH64 seed (fixed value of the contract).
SEED = 42
#: Children of an index node.
FANOUT = 16
#: Queries that walk the index together, and pairs of query and node that are held at a time.
QUERIES, PAIRS = 2048, 1 << 18
#: A bucket with more fingerprints than this is cut by further bits, again and again.
BUCKET_LIMIT = 4096
#: A bucket with more than this is cut even if that leaves more pairs, since one task holds it.
BUCKET_MOST = 1 << 20
#: Fingerprints that one call of the index handles, over all of its buckets.
SLOT_FINGERPRINTS = 100_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64 bits; a bit is set if it is in over half of the shingles' hashes. No words: zero."""
    joined = b" ".join((text or "").encode().lower().split())
    if not joined:
        return 0
    raw = np.frombuffer(joined, np.uint8)
    space = np.flatnonzero(raw == 0x20)
    starts = [0, *(space + 1).tolist()]
    ends = [*space.tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    if len(starts) <= shingle:
        return digest(joined, SEED)
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:])], np.uint64)
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text") -> DataFrame:
    """The columns of `docs` and fingerprint (long)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            prints = np.array([fingerprint(x, shingle) for x in batch.column(0).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints.view(np.int64))],
                                             names=[TEXT, PAYLOAD, "fingerprint"])

    thin = packed(docs, text)
    schema = T.StructType([*thin.schema.fields, T.StructField("fingerprint", T.LongType())])
    return with_columns(thin.mapInArrow(work, schema), docs, text, "fingerprint")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each number in the reflected Gray code."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class GrayIndex:
    """Hierarchical index over the fingerprints of many buckets.

    Fingerprints are sorted by bucket, then by Gray rank, which puts fingerprints that differ in few
    bits close together. Runs of `FANOUT` make a node that keeps the bits all of them share; runs of
    nodes make the next level, up to one root per bucket. A child only compares the shared bits that
    its parent lacks, and differences add up on the way down.
    """

    def __init__(self, buckets: np.ndarray, prints: np.ndarray):
        order = np.lexsort((gray_rank(prints), buckets))
        self.order, self.prints = order, prints[order]
        bucket = buckets[order]
        self.levels = []  # from leaves up: (values, shared, first child, after the last child)
        values, shared = self.prints, np.full(len(prints), ~np.uint64(0))
        while True:
            new = np.ones(len(bucket), bool)
            new[1:] = bucket[1:] != bucket[:-1]
            first = np.flatnonzero(new)
            if len(first) == len(bucket) and self.levels:
                break
            place = np.arange(len(bucket)) - np.repeat(first, np.diff(np.append(first, len(bucket))))
            low = np.flatnonzero(place % FANOUT == 0)
            high = np.append(low[1:], len(bucket))
            ones = np.bitwise_and.reduceat(values & shared, low)
            zeros = np.bitwise_and.reduceat(~values & shared, low)
            self.levels.append((ones, ones | zeros, low, high))
            values, shared, bucket = ones, ones | zeros, bucket[low]
            if not len(bucket):
                break
        self.roots = bucket
        self.bucket = buckets[order]

    def labels(self, distance: int) -> np.ndarray:
        """For each fingerprint, in the order given, the place of its group's first member: groups are
        the components of all links of at most `distance` differing bits within a bucket. A node whose
        members are all in the query's own group is passed over: its links would join nothing."""
        n = len(self.prints)
        label = np.arange(n)
        near = np.flatnonzero((self.bucket[1:] == self.bucket[:-1])
                              & (np.bitwise_count(self.prints[1:] ^ self.prints[:-1]) <= distance))
        label = joined(label, near, near + 1)
        root_of = np.searchsorted(self.roots, self.bucket)
        for at in range(0, n, QUERIES):
            lows, highs = [label], [label]
            for _, _, first, _ in self.levels:
                lows.append(np.minimum.reduceat(lows[-1], first))
                highs.append(np.maximum.reduceat(highs[-1], first))
            query = np.arange(at, min(n, at + QUERIES))
            found = [np.zeros((2, 0), np.int64)]
            open_ = [(len(self.levels), query, root_of[query], np.zeros(len(query), np.int64), np.zeros(len(query), np.uint64))]
            while open_:  # depth first, so that no more than a few pieces of each level wait
                level, query, node, differ, shared = open_.pop()
                values, masks = (self.levels[level - 1][:2] if level else (self.prints, None))
                mask = ~np.uint64(0) if masks is None else masks[node]
                differ = differ + np.bitwise_count((self.prints[query] ^ values[node]) & mask & ~shared)
                own = (lows[level][node] == label[query]) & (highs[level][node] == label[query])
                keep = (differ <= distance) & ~own
                query, node, differ = query[keep], node[keep], differ[keep]
                if not level:
                    found.append(np.stack([query, node]))
                    continue
                shared = self.levels[level - 1][1][node]
                low, high = self.levels[level - 1][2][node], self.levels[level - 1][3][node]
                for a in range(0, len(node), PAIRS // FANOUT):
                    part = slice(a, a + PAIRS // FANOUT)
                    width = high[part] - low[part]
                    into = np.repeat(np.arange(len(width)), width)
                    child = low[part][into] + np.arange(len(into)) - np.repeat(np.cumsum(width) - width, width)
                    open_.append((level - 1, query[part][into], child, differ[part][into], shared[part][into]))
            query, node = np.concatenate(found, axis=1)
            label = joined(label, query, node)
        out = np.empty(n, np.int64)
        out[self.order] = self.order[label]
        return out


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the groups of a[i] and b[i] become one, for all i; a label is a member's place."""
    label = label.copy()
    while len(a):
        x, y = label[a], label[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        if not len(a):
            break
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def _parts_of(mask: int, parts: int) -> list[int]:
    """The set bits of a mask as `parts` masks of nearly as many bits each."""
    bits = [i for i in range(64) if mask >> i & 1]
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _candidates(prints: DataFrame, distance: int) -> DataFrame:
    """(mask, bucket, fp): each fingerprint in distance + 1 buckets, one for each band of its bits. Two
    fingerprints with at most `distance` differing bits agree in a whole band.

    A bucket over `BUCKET_LIMIT` fingerprints is cut by the same rule over the bits that it leaves open, again
    and again, as long as a cut halves the pairs in it. It does for fingerprints that merely share a band. Those
    that are near each other stay together, where the index passes over what is linked already, up to
    `BUCKET_MOST`.
    """
    parts, whole, keys = distance + 1, (1 << 64) - 1, ["mask", "bucket"]
    rows = prints.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in _parts_of(whole, parts)])).alias("mask"))
    rows = rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bucket"), F.lit(False).alias("settled"))
    while True:
        open_bits = 64 - F.bit_count("mask")
        large = materialize(rows.filter(~F.col("settled") & (open_bits >= parts)).groupBy(keys).count()
                            .filter(F.col("count") > BUCKET_LIMIT), "large")
        masks = [x[0] & whole for x in large.select("mask").distinct().collect()]  # masks, not buckets: few
        if not masks:
            return rows.select("mask", "bucket", "fp")
        finer = F.coalesce(*[F.when(F.col("mask") == _signed(m), F.array(*[F.lit(_signed(m | x)) for x in _parts_of(whole & ~m, parts)]))
                             for m in masks])
        cut = materialize(rows.filter(~F.col("settled")).join(large, keys)
                          .select("fp", *keys, "count", F.explode(finer).alias("inner"))
                          .withColumn("within", F.col("fp").bitwiseAND(F.col("inner"))), "cut")
        pairs = cut.groupBy(*keys, "count", "inner", "within").agg(F.count("*").alias("n")).groupBy(*keys, "count").agg(
            F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs"))
        pays = (F.col("pairs") * 2 <= F.col("count").cast("double") * F.col("count")) | (F.col("count") > BUCKET_MOST)
        judged = materialize(pairs.select(*keys, pays.alias("pays")), "judged")
        known = rows.join(judged, keys, "left").filter("pays IS NULL OR NOT pays").select(
            "fp", *keys, (F.col("settled") | F.col("pays").isNotNull()).alias("settled"))
        inner = cut.join(judged.filter("pays"), keys, "left_semi").select(
            "fp", F.col("inner").alias("mask"), F.col("within").alias("bucket"), F.lit(False).alias("settled"))
        rows = materialize(known.union(inner), "buckets")


def link_groups(prints: DataFrame, distance: int = 4) -> DataFrame:
    """(fingerprint, root) for each distinct non-null value of `prints.fingerprint` that is linked to
    another one, directly or through others, by at most `distance` differing bits."""
    distinct = materialize(prints.filter("fingerprint IS NOT NULL")
                           .select(F.col("fingerprint").alias("fp")).distinct(), "prints")
    spark = prints.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = max(least, distinct.count() * (distance + 1) // SLOT_FINGERPRINTS)

    def work(table: pa.Table) -> pa.Table:
        prints = table.column("fp").to_numpy().view(np.uint64)
        buckets = np.stack([table.column(c).to_numpy() for c in ("mask", "bucket")], axis=1)
        label = GrayIndex(np.unique(buckets, axis=0, return_inverse=True)[1].ravel(), prints).labels(distance)
        hung = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": prints[hung].view(np.int64), "b": prints[label[hung]].view(np.int64)})

    edges = (_candidates(distinct, distance)
             .withColumn("slot", F.pmod(F.xxhash64("mask", "bucket"), F.lit(slots)))
             .groupBy("slot").applyInArrow(work, "a long, b long"))
    return connected(edges).select(F.col("node").alias("fingerprint"), "root")


def near_groups(rows: DataFrame, distance: int = 4, key: str = "doc_id") -> DataFrame:
    """`rows` (with key and fingerprint) and component_id: the smallest key of the rows that links of at
    most `distance` bits reach, the row itself included.

    Equal fingerprints are one node, so copies cost nothing beyond one aggregation. Null keys never are
    the smallest; a group that has only null keys has a null component_id. Rows with a null
    fingerprint are groups by themselves.
    """
    groups = link_groups(rows, distance)
    lowest = (rows.filter("fingerprint IS NOT NULL").groupBy("fingerprint").agg(F.min(key).alias("low"))
              .join(groups, "fingerprint", "left")
              .withColumn("root", F.coalesce("root", "fingerprint")))
    lowest = materialize(lowest, "lowest")
    best = lowest.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = lowest.join(best, "root").select("fingerprint", "component_id")
    found = rows.drop("component_id").join(ids, "fingerprint", "left")
    return found.withColumn("component_id", F.when(F.col("fingerprint").isNull(), F.col(key))
                            .otherwise(F.col("component_id")))


def simhash_components(docs: DataFrame, shingle: int = 4, distance: int = 4, text: str = "text",
                       key: str = "doc_id") -> DataFrame:
    """(key, fingerprint as 16 hex digits, component_id) for each row of `docs`.

    Words are `[^\\x20\\x09-\\x0D]+` of the A-Z-lowered whole text; a text with fewer words than a
    shingle is one shingle, a null, empty or blank text has fingerprint zero and links like any other.
    Repeated ids are separate rows with one smallest id. An empty table gives no rows.
    """
    rows = materialize(with_fingerprints(docs.select(key, text), shingle, text).select(key, "fingerprint"),
                       "fingerprints")
    return near_groups(rows, distance, key).select(
        key, F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, shingle: int = 4, distance: int = 4, text: str = "text",
                      key: str = "doc_id") -> DataFrame:
    """The rows of `docs`, one for each group of `simhash_components`: that with the smallest key (null
    keys last; of rows with that key, one). Texts are written once, in blocks; only fingerprints and
    the numbers of the rows to keep are shuffled."""
    mine = unused("__key", docs)
    blocks = Blocks(docs.withColumn(mine, F.col(f"`{key}`")), text)
    own = blocks.table.select(BLOCK, ROW, F.col(PAYLOAD)[mine].alias("__key"), F.col(TEXT).alias("__text"))
    prints = materialize(with_fingerprints(own, shingle, "__text").drop("__text"), "fingerprints")
    place = F.struct(F.col("__key").isNull().alias("none"), F.col("__key").alias("key"), BLOCK, ROW)
    kept = (near_groups(prints.select(place.alias("place"), "fingerprint"), distance, key="place")
            .filter("place = component_id").select(f"place.{BLOCK}", f"place.{ROW}"))
    return with_columns(blocks.keeping(materialize(kept, "kept")), docs, text)
