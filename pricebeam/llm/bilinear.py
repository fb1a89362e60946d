"""Language-model scoring: a log-bilinear model trained with noise-contrastive estimation in numpy.

The model predicts a token's class from the two tokens before it. Classes are the most frequent
training tokens, one each, and for all other tokens classes by the last two bytes of the word; within
those a token has its smoothed share of training counts, and one share is left for unseen words. So
every token has a probability, and the probabilities add up to one.

Counts of all training tokens are gathered through the block exchange, so no vocabulary is held by
one machine; what every task holds (the frequent tokens, the class sums, the model) has a fixed size.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebeam.llm.blocks import (
    ASK_SCHEMA, BLOCK, PAYLOAD, REPLY_SCHEMA, TEXT, Blocks, Distinct, asked, replies_of, unused, with_columns,
)
from pricebeam.llm.textarrays import Words, column_bytes, mixed, random_table
from pricebeam.session import materialize

#: Tokens with a class of their own, and classes of all the others.
FREQUENT, ENDINGS = 1000, 256
DIMENSIONS = 16
#: Tokens of a training step, noise samples that a step's tokens share, and passes over the corpus.
BATCH, NOISE, ROUNDS = 1024, 32, 1
LEARNING_RATE, FIRST_SQUARE = 0.06, 0.01
#: The token behind every text.
END = np.uint64(0x5EED0F7E47E4D000)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

ASKED = np.dtype([("count", "<i8"), ("ending", "<i4")])


class _Tokens:
    """Tokens of a block: the words of each text, A-Z lowered, and one end."""

    def __init__(self, table: pa.Table, fold: int):
        data, offsets = column_bytes(table.column(TEXT))
        data = LOWER[data]
        words = Words(data, offsets)
        texts = len(words.counts)
        at = np.arange(len(words.starts)) + words.text_of_word()
        n = len(words.starts) + texts
        self.keys = np.full(n, END, np.uint64)
        self.keys[at] = words.hashes(seed=21)
        #: The class that a token has if it is not frequent.
        self.ending = np.zeros(n, np.int64)
        last = data[words.ends - 1].astype(np.int64) if len(words.ends) else np.zeros(0, np.int64)
        before = np.where(words.ends - words.starts > 1, data[np.maximum(words.ends - 2, 0)], 0) if len(words.ends) else last
        self.ending[at] = (mixed((last * 256 + before).astype(np.uint64)) % np.uint64(ENDINGS)).astype(np.int64)
        self.first = words.first + np.arange(texts + 1)
        self.counts = words.counts + 1
        keys = table.column(PAYLOAD).combine_chunks()
        keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
        keys = keys.field(keys.type.num_fields - 1).to_pylist()  # `score_texts` puts the key last
        self.remainder = np.array([zlib.crc32(("" if x is None else x).encode()) % 5 for x in keys], np.int64)
        self.held_out = self.remainder == fold
        self.training = np.repeat(~self.held_out, self.counts)


def _ask(fold: int, buckets: int):
    def work(table: pa.Table) -> pa.Table:
        tokens = _Tokens(table, fold)
        distinct = Distinct(tokens.keys)
        extra = np.zeros(len(distinct.first), ASKED)
        extra["count"] = np.bincount(distinct.inverse, weights=tokens.training, minlength=len(distinct.first))
        extra["ending"] = tokens.ending[distinct.first]
        return asked(table.column(BLOCK)[0].as_py(), distinct, extra, buckets)
    return work


def _count(table: pa.Table) -> pa.Table:
    """Corpus counts of a bucket's tokens for each block that asked; and, for block -1, the bucket's own
    most frequent tokens and its sums by ending."""
    table = table.sort_by("block")
    keys = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    extra = np.concatenate([np.frombuffer(x, ASKED) for x in table.column("extra").to_pylist()])
    same = Distinct(np.concatenate(keys))
    total = np.bincount(same.inverse, weights=extra["count"], minlength=len(same.first)).astype(np.int64)
    parts = np.split(total[same.inverse], np.cumsum([len(x) for x in keys])[:-1])
    ending = extra["ending"][same.first].astype(np.int64)
    summary = np.zeros(ENDINGS * 2, np.int64)
    summary[:ENDINGS] = np.bincount(ending, weights=total, minlength=ENDINGS)
    summary[ENDINGS:] = np.bincount(ending, weights=total > 0, minlength=ENDINGS)
    top = np.lexsort((same.keys[0], -total))[:FREQUENT]
    top = top[total[top] > 0]
    listed = np.stack([same.keys[0][top].view(np.int64), total[top], ending[top]], axis=1)
    n, bucket = len(keys), table.column("bucket")[0].as_py()
    return pa.table({
        "block": pa.concat_arrays([*table.column("block").chunks, pa.array([-1, -1], pa.int64())]),
        "kind": pa.array([0] * n + [1, 2], pa.int32()),
        "bucket": pa.array([bucket] * (n + 2), pa.int32()),
        "reply": pa.array([x.tobytes() for x in parts] + [summary.tobytes(), listed.tobytes()], pa.binary()),
    })


def _merged(table: pa.Table) -> pa.Table:
    """Several buckets' sums by ending, and lists of most frequent tokens, as one of each."""
    kinds, replies = table.column("kind").to_pylist(), table.column("reply").to_pylist()
    sums = sum((np.frombuffer(x, np.int64) for x, k in zip(replies, kinds) if k == 1), np.zeros(ENDINGS * 2, np.int64))
    tokens = np.concatenate([np.zeros((0, 3), np.int64),
                             *(np.frombuffer(x, np.int64).reshape(-1, 3) for x, k in zip(replies, kinds) if k == 2)])
    top = np.lexsort((np.ascontiguousarray(tokens[:, 0]).view(np.uint64), -tokens[:, 1]))[:FREQUENT]
    return pa.table({"part": pa.array([0, 0], pa.int64()), "kind": pa.array([1, 2], pa.int32()),
                     "reply": pa.array([sums.tobytes(), tokens[top].tobytes()], pa.binary())})


@dataclass
class Vocabulary:
    """Frequent tokens in order of their hash, and counts of all classes: frequent tokens, then endings."""

    keys: np.ndarray
    counts: np.ndarray  # training tokens of each class
    distinct: np.ndarray  # distinct training tokens of each class
    total: int
    size: int

    @property
    def classes(self) -> int:
        return len(self.counts)

    def classes_of(self, tokens: _Tokens) -> np.ndarray:
        if not len(self.keys):
            return tokens.ending
        at = np.minimum(np.searchsorted(self.keys, tokens.keys), len(self.keys) - 1)
        return np.where(self.keys[at] == tokens.keys, at, len(self.keys) + tokens.ending)


def _vocabulary(counts: DataFrame, buckets: int) -> Vocabulary:
    """Buckets' summaries are merged in groups, then over the groups; one row of fixed size is collected."""
    schema = "part long, kind int, reply binary"
    parts = counts.filter("block = -1").select(F.pmod("bucket", F.lit(math.isqrt(buckets))).alias("part"), "kind", "reply")
    once = parts.groupBy("part").applyInArrow(_merged, schema)
    rows = {x["kind"]: np.frombuffer(x["reply"], np.int64)
            for x in once.groupBy(F.lit(0).alias("g")).applyInArrow(_merged, schema).collect()}
    sums = rows.get(1, np.zeros(ENDINGS * 2, np.int64))
    top = rows.get(2, np.zeros(0, np.int64)).reshape(-1, 3)
    tokens, distinct = sums[:ENDINGS].copy(), sums[ENDINGS:].copy()
    total, size = int(tokens.sum()), int(distinct.sum())
    np.subtract.at(tokens, top[:, 2], top[:, 1])
    np.subtract.at(distinct, top[:, 2], 1)
    keys = np.ascontiguousarray(top[:, 0]).view(np.uint64)
    order = np.argsort(keys)
    own = top[order, 1]
    return Vocabulary(keys[order], np.concatenate([own, tokens]), np.concatenate([np.ones(len(top), np.int64), distinct]),
                      total, size)


@dataclass
class Model:
    """Context vectors (the last for what is before a text), matrices of the two places before a token,
    prediction vectors and biases of the classes."""

    context: np.ndarray
    nearer: np.ndarray
    farther: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    @classmethod
    def initial(cls, vocabulary: Vocabulary) -> Model:
        n, d = vocabulary.classes, DIMENSIONS

        def noise(rows: int, seed: int) -> np.ndarray:
            return ((random_table(rows * d, seed) >> np.uint64(40)).astype(np.float64) / 2**24 - 0.5).reshape(rows, d)

        share = (vocabulary.counts + 0.5) / (vocabulary.counts + 0.5).sum()
        return cls(noise(n + 1, 31) * 0.4, np.eye(d), np.eye(d) * 0.5, noise(n, 32) * 0.4, np.log(share))

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.nearer, self.farther, self.target, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.arrays()])

    def with_flat(self, flat: np.ndarray) -> Model:
        parts, at = [], 0
        for x in self.arrays():
            parts.append(flat[at : at + x.size].reshape(x.shape))
            at += x.size
        return Model(*parts)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all classes after each class one place and two places before, as matrix products."""
        near = self.context @ self.nearer @ self.target.T + self.bias
        return near.astype(np.float32), (self.context @ self.farther @ self.target.T).astype(np.float32)


def _contexts(tokens: _Tokens, classes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The class one place and two places before each token; `start` before the text."""
    one, two = np.full(len(classes), start), np.full(len(classes), start)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    begin = tokens.first[:-1]
    one[begin] = start
    two[begin] = start
    second = begin[tokens.counts > 1] + 1
    two[second] = start
    return one, two


def train(model: Model, noise: np.ndarray, target: np.ndarray, one: np.ndarray, two: np.ndarray, seed: int) -> Model:
    """One pass of noise-contrastive estimation (Mnih and Teh 2012) with Adagrad. Each step tells its
    tokens from `NOISE` samples of the class distribution `noise`, which all tokens of the step share; other seeds
    give other samples."""
    context, nearer, farther, vectors, bias = (x.astype(np.float32) for x in model.arrays())
    params = [context, nearer, farther, vectors, bias]
    squares = [np.full_like(x, FIRST_SQUARE) for x in params]
    log_noise = (np.log(noise) + math.log(NOISE)).astype(np.float32)
    heap = np.cumsum(noise)

    def scatter(ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(ids, weights=rows[:, j], minlength=n) for j in range(rows.shape[1])], axis=1)

    # Steps take tokens from all over the block: neighbours say much the same.
    steps = max(1, -(-len(target) // BATCH))
    for step in range(steps):
        t, a, b = target[step::steps], one[step::steps], two[step::steps]
        uniform = (random_table(NOISE, (seed * 1_000_003 + step) % 2**63) >> np.uint64(11)).astype(np.float64) / 2**53
        sample = np.minimum(np.searchsorted(heap, uniform * heap[-1]), len(noise) - 1)
        ca, cb = context[a], context[b]
        hidden = ca @ nearer + cb @ farther
        good = np.einsum("ij,ij->i", hidden, vectors[t]) + bias[t] - log_noise[t]
        bad = hidden @ vectors[sample].T + (bias[sample] - log_noise[sample])
        up = 1 / (1 + np.exp(np.clip(good, -30, 30)))
        down = -1 / (1 + np.exp(-np.clip(bad, -30, 30)))
        g_hidden = up[:, None] * vectors[t] + down @ vectors[sample]
        g_vectors = scatter(t, up[:, None] * hidden, len(bias))
        np.add.at(g_vectors, sample, down.T @ hidden)
        g_bias = np.bincount(t, weights=up, minlength=len(bias))
        np.add.at(g_bias, sample, down.sum(axis=0))
        g_context = scatter(a, g_hidden @ nearer.T, len(context)) + scatter(b, g_hidden @ farther.T, len(context))
        for x, s, g in zip(params, squares, (g_context, ca.T @ g_hidden, cb.T @ g_hidden, g_vectors, g_bias)):
            g = (g / BATCH * 64).astype(np.float32)
            s += g * g
            x += LEARNING_RATE * g / np.sqrt(s)
    return Model(*(x.astype(np.float64) for x in params))


def _trained(blocks: Blocks, vocabulary: Vocabulary, model: Model, fold: int) -> Model:
    """The model after one pass over all blocks: each trains from `model`, the results are averaged by
    their numbers of tokens, first in groups, then over the groups."""
    noise = (vocabulary.counts + 0.5) / (vocabulary.counts + 0.5).sum()

    def work(table: pa.Table) -> pa.Table:
        tokens = _Tokens(table, fold)
        classes = vocabulary.classes_of(tokens)
        one, two = _contexts(tokens, classes, vocabulary.classes)
        use = np.flatnonzero(tokens.training)
        block = table.column(BLOCK)[0].as_py()
        flat = train(model, noise, classes[use], one[use], two[use], block + 1).flat() if len(use) else model.flat()
        return pa.table({"part": pa.array([block], pa.int64()),
                         "tokens": pa.array([len(use)], pa.int64()),
                         "model": pa.array([flat.astype(np.float32).tobytes()], pa.binary())})

    def mean(table: pa.Table) -> pa.Table:
        sizes = table.column("tokens").to_numpy()
        total = np.zeros(len(np.frombuffer(table.column("model")[0].as_py(), np.float32)))
        for size, x in zip(sizes, table.column("model")):
            total += float(size) * np.frombuffer(x.as_py(), np.float32)
        return pa.table({"part": pa.array([0], pa.int64()), "tokens": pa.array([int(sizes.sum())], pa.int64()),
                         "model": pa.array([(total / max(1, sizes.sum())).astype(np.float32).tobytes()], pa.binary())})

    schema = "part long, tokens long, model binary"
    parts = materialize(blocks.each(work, schema), "models")
    groups = max(1, math.isqrt(blocks.count))
    first = parts.groupBy(F.pmod(F.xxhash64("part"), F.lit(groups)).alias("g")).applyInArrow(mean, schema)
    done = first.filter("tokens > 0").groupBy(F.lit(0).alias("g")).applyInArrow(mean, schema).collect()
    if not done:
        return model
    return model.with_flat(np.frombuffer(done[0]["model"], np.float32).astype(np.float64))


def _normalisers(spark, model: Model, slices: int) -> np.ndarray:
    """log of the sum over all classes for every pair of contexts, by batches of matrix products."""
    near, far = model.tables()
    shared = spark.sparkContext.broadcast((near, far))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, far = shared.value
        for batch in batches:
            rows = []
            for a in batch.column(0).to_pylist():
                scores = far + near[a]
                top = scores.max(axis=1, keepdims=True)
                rows.append((np.log(np.exp(scores - top).sum(axis=1)) + top[:, 0]).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["a", "row"])

    rows = (spark.range(0, len(near), 1, slices).mapInArrow(work, "a long, row binary")).collect()
    out = np.zeros((len(near), len(far)), np.float32)
    for x in rows:
        out[x["a"]] = np.frombuffer(x["row"], np.float32)
    return out


def score_texts(docs: DataFrame, fold: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The columns of `docs`, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Tokens are words `[^\\x20\\x09-\\x0D]+`, A-Z lowered, then one end per text. Texts with crc32(key as
    text) mod 5 equal to `fold` are held out; all the others are learned from, in full. base_score is
    the add-half unigram's log10 probability of the text, score the model's. A null key counts as an
    empty text for the remainder; a null text is empty and has the end alone. If nothing is left to
    learn from, both scores give the only known event probability one. Repeated rows count as often as
    they occur; new columns replace those of the same names.
    """
    spark = docs.sparkSession
    blocks = Blocks(docs.withColumn(unused("__key", docs), F.col(f"`{key}`").cast("string")), text)
    asks = blocks.each(_ask(fold, blocks.buckets), ASK_SCHEMA)
    counts = materialize(asks.groupBy("bucket").applyInArrow(_count, REPLY_SCHEMA), "counts")
    vocabulary = _vocabulary(counts, blocks.buckets)
    model = Model.initial(vocabulary)
    for _ in range(ROUNDS if vocabulary.total else 0):
        model = _trained(blocks, vocabulary, model, fold)
    near, far = model.tables()
    shared = spark.sparkContext.broadcast((near, far, _normalisers(spark, model, blocks.partitions)))
    within = np.log10(vocabulary.counts + 0.5 * (vocabulary.distinct + 1))
    frequent = len(vocabulary.keys)
    base_total = math.log10(vocabulary.total + 0.5 * (vocabulary.size + 1))

    def work(table: pa.Table, answers: pa.Table) -> pa.Table:
        near, far, normal = shared.value
        tokens = _Tokens(table, fold)
        count = replies_of(answers, 0, "i8")[Distinct(tokens.keys).inverse]
        classes = vocabulary.classes_of(tokens)
        one, two = _contexts(tokens, classes, vocabulary.classes)
        own = np.log10(count + 0.5)
        value = (near[one, classes] + far[two, classes] - normal[one, two]).astype(np.float64) / math.log(10)
        value += np.where(classes < frequent, 0.0, own - within[classes])
        begin = tokens.first[:-1]

        def sums(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, begin) if len(begin) else x[:0]

        return pa.table({
            TEXT: table.column(TEXT), PAYLOAD: table.column(PAYLOAD), "held_out": pa.array(tokens.held_out),
            "n_tokens": pa.array(tokens.counts, pa.int64()), "n_known": pa.array(sums((count > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(begin), vocabulary.total), pa.int64()),
            "base_score": pa.array(sums(own - base_total), pa.float64()), "score": pa.array(sums(value), pa.float64())})

    new = {"held_out": T.BooleanType(), "n_tokens": T.LongType(), "n_known": T.LongType(), "train_tokens": T.LongType(),
           "base_score": T.DoubleType(), "score": T.DoubleType()}
    schema = T.StructType([T.StructField(TEXT, T.StringType()), blocks.schema[PAYLOAD],
                           *[T.StructField(k, v) for k, v in new.items()]])
    return with_columns(blocks.with_replies(counts.filter("block >= 0"), work, schema), docs, text, *new)
