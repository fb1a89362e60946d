"""Token counts of a byte-level BPE vocabulary, by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pricebeam.llm.blocks import PAYLOAD, TEXT, packed, sliced, with_columns

#: The byte-level pre-tokenizer's pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of text that are split before their new pre-tokens are merged together.
CHUNK = 1 << 20
#: Pre-tokens whose counts a Python worker keeps; the memory is emptied when it is full.
REMEMBERED = 150_000


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 bytes stand for
    themselves, the others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class MergeTable:
    """Merges of a `tokenizers` BPE file as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get(
                "type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        vocab = model["vocab"]
        self.size = max(vocab.values()) + 1
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in byte_letters().items():
            self.byte_ids[byte] = vocab[letter]
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        into = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.into = keys[order], order, into[order]
        # Open addressing: a pair's place is found in one probe mostly.
        self.bits = max(8, int(len(keys) * 8).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        waiting = np.arange(len(keys))
        place = self._slot(self.keys)
        while len(waiting):
            free = self.slots[place] < 0
            self.slots[place[free]] = waiting[free]
            lost = self.slots[place] != waiting
            waiting, place = waiting[lost], (place[lost] + 1) & ((1 << self.bits) - 1)
        added = [x["content"] for x in spec.get("added_tokens", [])]
        #: Strings that the library takes out of a text as one token each.
        self.special = regex.compile("|".join(regex.escape(x) for x in sorted(added, key=len, reverse=True))) \
            if added else None
        self.pattern = regex.compile(PATTERN)
        #: Counts of pre-tokens, and of parts of texts between spaces.
        self.known: dict[str, int] = {}
        self.parts: dict[str, int] = {}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each pair in the sorted arrays (any number if absent), and whether it is there."""
        place = self._slot(keys)
        at = self.slots[place]
        there = (at >= 0) & (self.keys[at] == keys)
        left = np.flatnonzero((at >= 0) & ~there)
        while len(left):
            place[left] = (place[left] + 1) & ((1 << self.bits) - 1)
            now = self.slots[place[left]]
            good = (now >= 0) & (self.keys[now] == keys[left])
            at[left[good]], there[left[good]] = now[good], True
            left = left[(now >= 0) & ~good]
        return at, there

    def merged_counts(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left of each non-empty pre-token when no pair has a rank. Each round applies, in all
        sequences at once, every occurrence of the sequence's own lowest-rank pair, from the left."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out = lengths.copy()
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.arange(len(pieces))
        none = len(self.keys)
        while len(symbols):
            first = np.cumsum(lengths) - lengths
            last = np.zeros(len(symbols), bool)
            last[first + lengths - 1] = True
            key = np.empty(len(symbols), np.int64)
            key[:-1] = symbols[:-1] * self.size + symbols[1:]
            key[-1] = -1
            at, there = self._find(key)
            ranked = there & ~last
            rank = np.where(ranked, self.ranks[at], none)
            lowest = np.minimum.reduceat(rank, first)
            hit = ranked & (rank == np.repeat(lowest, lengths))
            # A pair of equal symbols can overlap itself: of neighbouring hits, every other one counts.
            place = np.arange(len(symbols))
            begin = hit.copy()
            begin[1:] &= ~hit[:-1]
            begin[first] = hit[first]
            hit &= (place - np.maximum.accumulate(np.where(begin, place, 0))) % 2 == 0
            symbols = np.where(hit, self.into[at], symbols)
            keep = np.ones(len(symbols), bool)
            keep[1:] = ~hit[:-1]
            lengths = np.add.reduceat(keep, first, dtype=np.int64)
            symbols = symbols[keep]
            out[owner] = lengths
            going = (lowest < none) & (lengths > 1)
            symbols = symbols[np.repeat(going, lengths)]
            lengths, owner = lengths[going], owner[going]
        return out

    def split(self, text: str) -> tuple[list[str], int]:
        """Parts whose counts add up to the text's, and the number of special tokens between them.

        No pre-token has a space before its end unless that begins it, so a text falls apart before
        every space that no white space follows. The space is not part of the key: the first part is
        marked by a leading NUL instead."""
        if self.special is not None and (pieces := self.special.split(text))[1:]:
            return [x for piece in pieces for x in self.split_plain(piece)], len(pieces) - 1
        return self.split_plain(text), 0

    @staticmethod
    def split_plain(text: str) -> list[str]:
        if "\0" in text:
            return ["\0" + text]
        parts = text.split(" ")
        if "" in parts or any(map(str.isspace, map(itemgetter(0), parts))):
            whole = [parts[0]]
            for part in parts[1:]:
                if not part or part[0].isspace():
                    whole[-1] += " " + part
                else:
                    whole.append(part)
            parts = whole
        parts[0] = "\0" + parts[0]
        return parts

    def counts(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        waiting: list[tuple[list[str], int]] = []
        size = 0
        for text in texts:
            waiting.append(self.split(text))
            size += len(text)
            if size >= CHUNK:
                out += self._counted(waiting)
                waiting, size = [], 0
        return out + self._counted(waiting)

    def _counted(self, split: list[tuple[list[str], int]]) -> list[int]:
        if len(self.parts) > REMEMBERED:
            self.parts = {}
        if len(self.known) > REMEMBERED:
            self.known = {}
        parts, known = self.parts, self.known
        new = set().union(*(x for x, _ in split)).difference(parts)
        if new:
            found = self.pattern.findall
            pieces = {x: found(x[1:] if x[0] == "\0" else " " + x) for x in new}
            fresh = list({y for x in pieces.values() for y in x}.difference(known))
            if fresh:
                known.update(zip(fresh, self.merged_counts([x.encode() for x in fresh]).tolist()))
            for x, own in pieces.items():
                parts[x] = sum(map(known.__getitem__, own))
        return [sum(map(parts.__getitem__, own)) + special for own, special in split]


@lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, text: str = "text") -> DataFrame:
    """The columns of `docs`, n_bytes, n_tokens and over_limit (more than `limit` tokens).

    `vocabulary` is the path, on every machine, of a byte-level BPE file of the `tokenizers` library;
    counts equal that library's with its defaults and no added begin or end: strings of special tokens
    within a text are one token. Null and empty texts have no bytes and no tokens. Nothing is
    shuffled; rows are independent, so repeated rows and ids have no meaning; new columns replace
    those of the same names.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merge_table(vocabulary)
        for batch in sliced(batches):
            texts = ["" if x is None else x for x in batch.column(0).to_pylist()]
            tokens = table.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(x.encode()) for x in texts], pa.int64()),
                 pa.array(tokens, pa.int64()), pa.array([x > limit for x in tokens], pa.bool_())],
                names=[TEXT, PAYLOAD, "n_bytes", "n_tokens", "over_limit"])

    thin = packed(docs, text)
    schema = T.StructType([*thin.schema.fields, T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return with_columns(thin.mapInArrow(work, schema), docs, text, "n_bytes", "n_tokens", "over_limit")
