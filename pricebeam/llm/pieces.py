"""SentencePiece encoding and decoding: Viterbi over an Aho-Corasick automaton of the pieces."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pricebeam.llm.blocks import PAYLOAD, TEXT, packed, sliced, with_columns

#: SentencePiece's mark for a space (fixed value).
MARK = "▁"
#: What the library takes off the lowest score for a character without a piece (fixed value).
UNKNOWN_PENALTY = 10.0
#: Scores are whole multiples of this, so sums are exact in any order and in 32 bits.
GRID = 1 / 1024
#: Words whose pieces a Python worker keeps; the memory is emptied when it is full.
REMEMBERED = 150_000


def rank_scores(scores: list[float]) -> list[float]:
    """Log-probabilities for a vocabulary whose scores only order its pieces, as merge ranks do: by
    Zipf's law the piece of rank r has a probability in proportion to 1 / r."""
    order = sorted(range(len(scores)), key=lambda i: -scores[i])
    total = math.log(sum(1 / r for r in range(1, len(scores) + 1)))
    out = [0.0] * len(scores)
    for r, i in enumerate(order, 1):
        out[i] = round((-math.log(r) - total) / GRID) * GRID
    return out


class Pieces:
    """A model file's pieces as an automaton, with the best segmentation of any text."""

    def __init__(self, path: str, scores: str = "model"):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.piece = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        byte = [model.is_byte(i) for i in range(n)]
        self.byte_id = {int(self.piece[i][3:5], 16): i for i in range(n) if byte[i]}
        self.unknown = model.unk_id()
        #: What each piece decodes to.
        self.bytes = [bytes([int(self.piece[i][3:5], 16)]) if byte[i] else b"" if model.is_control(i)
                      else " \u2047 ".encode() if i == self.unknown else self.piece[i].replace(MARK, " ").encode()
                      for i in range(n)]
        usual = [i for i in range(n) if not special[i] and not byte[i]]
        own = [model.get_score(i) for i in usual]
        given = rank_scores(own) if scores == "rank" else own
        #: Score of each piece that text is cut into.
        self.score = dict(zip(usual, given))
        self.lowest = min(given, default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for i in usual:
            self.automaton.add_word(self.piece[i], (len(self.piece[i]), self.score[i], i))
        self.automaton.make_automaton()
        #: Characters that are pieces by themselves.
        self.single = {self.piece[i] for i in usual if len(self.piece[i]) == 1}
        #: If marks only begin pieces, no piece reaches over the end of a word: words are cut alone.
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", self.piece[i]) for i in usual)
        self.known: dict[str, bytes] = {}

    def best(self, text: str) -> list[int]:
        """Ids of the segmentation with the highest sum of scores; of equal ones, the one whose last
        pieces are the longest. The automaton passes the text once; at each position its outputs, from
        the longest, relax the best score there. A character without a piece of its own is unknown."""
        n = len(text)
        score = [0.0] + [-math.inf] * n
        back = [0] * (n + 1)
        which = [self.unknown] * (n + 1)
        if self.single.issuperset(text):
            for at, (length, own, piece) in self.automaton.iter(text):
                start = at + 1 - length
                found = score[start] + own
                if found > score[at + 1]:
                    score[at + 1], back[at + 1], which[at + 1] = found, start, piece
        else:
            end = 0  # positions up to here are settled
            for at, (length, own, piece) in self.automaton.iter(text):
                while end < at:
                    end += 1
                    self._unknown(end, text, score, back, which)
                found = score[at + 1 - length] + own
                if found > score[at + 1]:
                    score[at + 1], back[at + 1], which[at + 1] = found, at + 1 - length, piece
            while end < n:
                end += 1
                self._unknown(end, text, score, back, which)
        out: list[int] = []
        while n:
            if which[n] == self.unknown and self.byte_id:
                out += [self.byte_id[b] for b in reversed(text[back[n] : n].encode())]
            else:
                out.append(which[n])
            n = back[n]
        return out[::-1]

    def _unknown(self, at: int, text: str, score: list[float], back: list[int], which: list[int]) -> None:
        """Relax position `at` by an unknown character, if that character is no piece."""
        if text[at - 1] not in self.single:
            found = score[at - 1] + self.lowest
            if found > score[at]:
                score[at], back[at], which[at] = found, at - 1, self.unknown

    def encode(self, text: str) -> np.ndarray:
        """Ids of the text (int32)."""
        normal = self.model.normalize(text)
        if not self.by_word:
            return np.array(self.best(normal), np.int32)
        words = normal.split(MARK)
        if words[0] or not all(words[1:]):  # runs of marks, or none at the beginning
            words = re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", normal)
            words = [x[1:] if x[0] == MARK else x + MARK for x in words]
        else:
            del words[0]
        # A key is a word without the mark before it; a word that has none ends in one instead.
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        try:
            packed_ids = b"".join(map(known.__getitem__, words))
        except KeyError:
            for word in set(words).difference(known):
                whole = word[:-1] if word[-1:] == MARK and word.strip(MARK) else MARK + word
                known[word] = np.array(self.best(whole), np.int32).tobytes()
            packed_ids = b"".join(map(known.__getitem__, words))
        out = np.frombuffer(packed_ids, np.int32)
        if not self.byte_id and len(out):  # without byte pieces, neighbouring unknown characters are one
            repeat = out == self.unknown
            repeat[1:] &= repeat[:-1].copy()
            repeat[0] = False
            out = out[~repeat]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text: pieces joined, byte pieces as UTF-8, marks as spaces, without the added first one."""
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


@lru_cache(maxsize=2)
def pieces_of(path: str, scores: str = "model") -> Pieces:
    return Pieces(path, scores)


def encode_pieces(docs: DataFrame, model: str, scores: str = "model", text: str = "text",
                  decoded: str | None = None) -> DataFrame:
    """The columns of `docs`, ids (array<int>) and n_pieces; with `decoded`, also the ids' text under that
    name, from the same pass.

    `model` is the path, on every machine, of a SentencePiece model file. With scores="model" the best
    segmentation is the library's for a unigram model; for files of other kinds, whose scores are
    merge ranks, scores="rank" gives each piece its Zipf probability. Null and empty texts have no
    pieces and decode to an empty text. Rows are independent and nothing is shuffled; new columns
    replace those of the same names.
    """
    new = {"ids": T.ArrayType(T.IntegerType()), "n_pieces": T.LongType()} | ({decoded: T.StringType()} if decoded else {})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model, scores)
        for batch in sliced(batches):
            parts = [pieces.encode(x) if x else np.zeros(0, np.int32) for x in batch.column(0).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in parts], dtype=np.int64)])
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            columns = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                       pa.array(np.diff(ends), pa.int64())]
            if decoded:
                columns.append(pa.array([pieces.decode(x.tolist()) for x in parts], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[TEXT, PAYLOAD, *new])

    thin = packed(docs, text)
    schema = T.StructType([*thin.schema.fields, *[T.StructField(k, v) for k, v in new.items()]])
    return with_columns(thin.mapInArrow(work, schema), docs, text, *new)


def decode_pieces(encoded: DataFrame, model: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """The columns of `encoded` and the decoded text of each row's ids; null ids give null."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            given = column.is_valid().to_pylist()
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_pylist()
            texts = [pieces.decode(flat[a:b].tolist()) if ok else None for ok, a, b in zip(given, ends, ends[1:])]
            kept = [i for i, name in enumerate(batch.schema.names) if name != to]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(texts, pa.string())],
                                             names=[*(batch.schema.names[i] for i in kept), to])

    schema = T.StructType([*[f for f in encoded.schema.fields if f.name != to], T.StructField(to, T.StringType())])
    return encoded.mapInArrow(work, schema)
