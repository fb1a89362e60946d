"""Texts in blocks, and the exchange that tells every block about the rest of the corpus.

Substring operators ask one question of all windows of all texts: which of these hashes occur
elsewhere? Sending a row per window would shuffle the corpus many times over. Here

1. `write_blocks` writes the texts once to the shared folder, in blocks of a few MB, bucketed by
   block, so later steps meet their replies without moving the texts again;
2. each block sends its *distinct* hashes, sorted, cut into ranges of the hash ("buckets"): one row
   per block and bucket. A hash that fills a third of the corpus arrives once per block;
3. each bucket compares what the blocks sent and replies to each block in the same order.

Blocks compute the same hashes again when they read the replies, so only hashes and flags travel.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebeam.session import scratch_path

#: Bytes of text after which a block is closed. A longer text is a block by itself.
BLOCK_BYTES = 2 << 20
#: Columns of a block table, beside the caller's columns, which travel in one struct.
BLOCK, ROW, TEXT, PAYLOAD = "block", "row", "text", "payload"
#: What an operator noted about a whole block, beside its first row.
NOTE = "note"

ASK_SCHEMA = "bucket int, block long, hashes binary, extra binary"
REPLY_SCHEMA = "block long, kind int, bucket int, reply binary"


def _number_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    seq, row, size = 0, 0, 0
    for batch in batches:
        sizes = np.diff(_offsets(batch.column(TEXT)))
        blocks, rows = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for i, n in enumerate(sizes.tolist()):
            if size and size + n > BLOCK_BYTES:
                seq, row, size = seq + 1, 0, 0
            blocks[i], rows[i] = (task << 32) + seq, row
            row, size = row + 1, size + n + 16
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks), pa.array(rows, pa.int64()), batch.column(TEXT), batch.column(PAYLOAD)],
            names=[BLOCK, ROW, TEXT, PAYLOAD])


def _with_notes(note: Callable[[pa.Table], bytes]):
    """Numbered rows, and `note` of each block beside its first row. One block is held at a time."""
    def closed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        block = pa.Table.from_batches(parts).combine_chunks()
        notes = pa.array([note(block)] + [None] * (block.num_rows - 1), pa.binary())
        return block.append_column(NOTE, notes).combine_chunks().to_batches()[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in _number_blocks(batches):
            blocks = batch.column(BLOCK).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts, cuts[1:]):
                if b == a:
                    continue
                if held and held[0].column(BLOCK)[0].as_py() != blocks[a]:
                    yield closed(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield closed(held)
    return work


def sliced(batches: Iterator[pa.RecordBatch], text: int = 0, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of text, so that what a task makes of one batch stays
    small. `text` is the number of the text column."""
    for batch in batches:
        sizes = np.cumsum(np.diff(_offsets(batch.column(text))))
        cuts = [0, *(np.flatnonzero(np.diff(sizes // most)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def _offsets(column: pa.Array) -> np.ndarray:
    from pricebeam.llm.textarrays import column_bytes

    return column_bytes(column)[1]


def packed(docs: DataFrame, text: str = "text") -> DataFrame:
    """(text, payload): the text beside all columns as one struct, so that no name can clash."""
    return docs.select(F.col(f"`{text}`").cast("string").alias(TEXT),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]
                                or [F.lit(None).cast("int").alias("none")]).alias(PAYLOAD))


def unused(name: str, docs: DataFrame) -> str:
    """`name`, or a longer one if the caller has a column of that name."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_columns(result: DataFrame, docs: DataFrame, text: str, *new: str) -> DataFrame:
    """The caller's columns in their order, out of (text, payload), then the new ones. A new column
    replaces one of the caller's of the same name."""
    own = [result[TEXT].alias(c) if c == text else result[PAYLOAD][c].alias(c)
           for c in docs.columns if c not in new]
    return result.select(*own, *[result[c] for c in new])


class Blocks:
    """A block table and the exchange over it. `note` makes bytes of a block's rows that later steps need again;
    they stay beside the texts."""

    def __init__(self, docs: DataFrame, text: str = "text", note: Callable[[pa.Table], bytes] | None = None):
        self.spark = docs.sparkSession
        thin = packed(docs, text)
        schema = T.StructType([
            T.StructField(BLOCK, T.LongType()), T.StructField(ROW, T.LongType()), *thin.schema.fields,
            *([T.StructField(NOTE, T.BinaryType())] if note else [])])
        path = scratch_path(self.spark, "blocks")
        self.partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"pricebeam_blocks_{uuid.uuid4().hex}"
        (thin.mapInArrow(_with_notes(note) if note else _number_blocks, schema).write.bucketBy(self.partitions, BLOCK)
         .option("path", path).format("parquet").saveAsTable(name))
        self.table = self.spark.table(name)
        self.schema = self.table.schema
        self.count = blocks = self.table.select(F.count_distinct(BLOCK)).first()[0]
        #: Ranges of the hash; each gets as many hashes as a block or a few have.
        self.buckets = max(self.partitions, blocks // 4, 1)

    def each(self, work: Callable[[pa.Table], Iterator[tuple] | pa.Table], schema: str) -> DataFrame:
        """Apply `work` to each whole block."""
        def one(table: pa.Table) -> pa.Table:
            return work(in_order(table))

        return self.table.groupBy(BLOCK).applyInArrow(one, schema)

    def with_replies(self, replies: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table],
                     schema: str | T.StructType) -> DataFrame:
        """Apply `work` to each block and all replies to it. Texts stay in their buckets."""
        def one(table: pa.Table, answers: pa.Table) -> pa.Table:
            return work(in_order(table), answers.sort_by([("kind", "ascending"), ("bucket", "ascending")]))

        return self.table.groupBy(BLOCK).cogroup(replies.groupBy(BLOCK)).applyInArrow(one, schema)


    def keeping(self, rows: DataFrame) -> DataFrame:
        """(text, payload) of the rows that `rows` (block, row) lists. Only the lists are shuffled."""
        def one(table: pa.Table, kept: pa.Table) -> pa.Table:
            wanted = pc.is_in(table.column(ROW), value_set=kept.column(ROW).combine_chunks())
            return table.filter(wanted).select([TEXT, PAYLOAD])

        schema = T.StructType([self.schema[TEXT], self.schema[PAYLOAD]])
        return (self.table.groupBy(BLOCK).cogroup(rows.select(BLOCK, ROW).groupBy(BLOCK))
                .applyInArrow(one, schema))


def in_order(table: pa.Table) -> pa.Table:
    return table.sort_by(ROW).combine_chunks()


class Distinct:
    """Distinct keys of a block in order: `first` row of each, `inverse`, `counts`."""

    def __init__(self, *keys: np.ndarray):
        n = len(keys[0])
        order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
        new = np.zeros(n, bool)
        if n:
            new[0] = True
            for key in keys:
                ordered = key[order]
                new[1:] |= ordered[1:] != ordered[:-1]
        group = np.cumsum(new) - 1
        self.inverse = np.empty(n, np.int64)
        self.inverse[order] = group
        at = np.flatnonzero(new)
        self.first = order[at]
        self.counts = np.diff(np.append(at, n))
        self.keys = [key[self.first] for key in keys]
        self.order = order


def edges(buckets: int) -> np.ndarray:
    """The first hash of each bucket but bucket 0."""
    return np.array([(i << 64) // buckets for i in range(1, buckets)], dtype=np.uint64)


def asked(block: int, distinct: Distinct, extra: np.ndarray, buckets: int) -> pa.Table:
    """One row per bucket that this block has hashes for. `extra`: a row of bytes per hash."""
    cuts = np.concatenate([[0], np.searchsorted(distinct.keys[0], edges(buckets)), [len(distinct.first)]])
    used = np.flatnonzero(np.diff(cuts))
    width = len(distinct.keys)
    keys = np.stack(distinct.keys, axis=1) if width > 1 else distinct.keys[0]
    return pa.table({
        "bucket": pa.array(used, pa.int32()),
        "block": pa.array(np.full(len(used), block, np.int64)),
        "hashes": pa.array([keys[cuts[b] : cuts[b + 1]].tobytes() for b in used], pa.binary()),
        "extra": pa.array([extra[cuts[b] : cuts[b + 1]].tobytes() for b in used], pa.binary()),
    })


def compare(asks: DataFrame, work: Callable[[list[np.ndarray], np.ndarray, np.ndarray], np.ndarray],
            width: int, extra: str, kind: int = 0) -> DataFrame:
    """Reply to all blocks, bucket by bucket. `work` gets the bucket's keys (a list of `width` arrays),
    their extras and the number of the asking block of each, and returns one number per key."""
    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        hashes = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        sizes = np.array([len(x) // width for x in hashes])
        keys = np.concatenate(hashes).reshape(-1, width)
        extras = np.concatenate([np.frombuffer(x, extra) for x in table.column("extra").to_pylist()])
        said = work([np.ascontiguousarray(keys[:, i]) for i in range(width)], extras,
                    np.repeat(np.arange(len(sizes)), sizes))
        parts = np.split(said, np.cumsum(sizes)[:-1])
        return pa.table({
            "block": table.column("block"),
            "kind": pa.array(np.full(len(sizes), kind), pa.int32()),
            "bucket": table.column("bucket"),
            "reply": pa.array([x.tobytes() for x in parts], pa.binary()),
        })

    return asks.groupBy("bucket").applyInArrow(one, REPLY_SCHEMA)


def occurs_elsewhere(keys: list[np.ndarray], many: np.ndarray, _blocks: np.ndarray) -> np.ndarray:
    """1 for keys that more than one block sent, or one block has more than once."""
    same = Distinct(*keys)
    repeated = np.bincount(same.inverse, weights=many, minlength=len(same.first)) + same.counts > 1
    return repeated[same.inverse].astype(np.uint8)


def replies_of(answers: pa.Table, kind: int, dtype: str) -> np.ndarray:
    """All replies of a kind, in the order of the block's distinct keys."""
    kinds = answers.column("kind").to_numpy()
    parts = [np.frombuffer(x, dtype) for x, k in zip(answers.column("reply").to_pylist(), kinds) if k == kind]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)
