"""Substring dedup over bytes, by sorting suffixes deep-shallow."""

from __future__ import annotations

import hashlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pricebeam.llm.blocks import (
    ASK_SCHEMA, BLOCK, NOTE, PAYLOAD, REPLY_SCHEMA, TEXT, Blocks, Distinct, asked, compare, edges,
    occurs_elsewhere, replies_of, with_columns,
)
from pricebeam.llm.textarrays import RangeHash, column_bytes, marked, mixed, random_table
from pricebeam.session import materialize

#: Bytes of the grams among which each window chooses the one with the smallest hash.
GRAM = 16
#: Bytes that multikey quicksort orders before blind tries take over.
SHALLOW = 24
#: Reply bits: the whole segment (piece) occurs elsewhere; this block stands for it; its gram (core) is in
#: too many different ones.
REPEATED, SEND, HOT = 1, 2, 4
#: Different segments of a gram, and pieces of a core, beyond which they are told apart by more than that.
HOT_SEGMENTS = 500
#: Window starts of a piece: a hot segment is cut where the distance to its gram is a multiple of this.
PIECE = 24
#: Suffixes that are sorted at a time.
SORTED = 200_000

SEGMENT_SCHEMA = "bucket int, block long, grams binary, starts binary, lengths binary, sure binary, data binary"


def padded_words(data: np.ndarray, order: str) -> np.ndarray:
    """The 8 bytes from each position as one number; zeros follow the end."""
    room = np.zeros(len(data) + 8, np.uint8)
    room[: len(data)] = data
    return np.ndarray((len(data) + 1,), f"{order}u8", buffer=room, strides=(1,))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, in three passes (van Herk)."""
    n = len(values)
    if n < width:
        return values[:0]
    size = -(-n // width) * width
    room = np.full(size, ~np.uint64(0), np.uint64)
    room[:n] = values
    room = room.reshape(-1, width)
    ahead = np.minimum.accumulate(room, axis=1).ravel()
    back = np.minimum.accumulate(room[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


class _Runs:
    """Windows of a block, in runs that share the gram with the smallest hash (the leftmost of equals).
    Equal windows choose the same gram at the same place, so only runs of one gram need comparing.
    They are found once, when the block is written, and read from its note by all later steps."""

    def __init__(self, table: pa.Table, window: int):
        self.data, self.offsets = column_bytes(table.column(TEXT))
        note = table.column(NOTE)[0].as_py() if NOTE in table.column_names and table.num_rows else None
        if note is None:
            self._find(window)
        else:
            self._read(note, window)
        self.gram = self._grams(self.at)

    def _find(self, window: int) -> None:
        n = len(self.data)
        lengths = np.diff(self.offsets)
        long = lengths >= window
        valid = marked(self.offsets[:-1][long], self.offsets[1:][long] - window + 1, n)
        at = np.flatnonzero(valid)
        if not len(at):
            self.first = self.last = self.at = np.zeros(0, np.int64)
            self.segment = np.zeros(0, np.uint64)
            return
        ranked = (self._hashed(slice(None)) & ~np.uint64(0xFFFFFFFF)) | np.arange(n - GRAM + 1, dtype=np.uint64)
        chosen = (sliding_minimum(ranked, window - GRAM + 1)[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        #: First and last window start of each run, its gram's place, and the hash of all its bytes.
        self.first = at[first]
        self.last = at[np.append(first[1:], len(at)) - 1]
        self.at = chosen[first]
        del ranked, chosen, valid
        self.segment = self.hash.of(self.first, self.last + window)

    def note(self, window: int) -> bytes:
        """The runs as bytes; a gram's place and the last start lie within a window of the first start."""
        near = "<u2" if window < 1 << 16 else "<u4"
        return b"".join([self.segment.astype("<u8").tobytes(), self.first.astype("<u4").tobytes(),
                         (self.at - self.first).astype(near).tobytes(), (self.last - self.first).astype(near).tobytes()])

    def _read(self, note: bytes, window: int) -> None:
        near, width = ("<u2", 16) if window < 1 << 16 else ("<u4", 20)
        n = len(note) // width
        self.segment = np.frombuffer(note, "<u8", n)
        self.first = np.frombuffer(note, "<u4", n, 8 * n).astype(np.int64)
        self.at = self.first + np.frombuffer(note, near, n, 12 * n)
        self.last = self.first + np.frombuffer(note, near, n, (6 + width // 2) * n)

    def _hashed(self, where) -> np.ndarray:
        """Hashes of the grams at places `where`."""
        words = padded_words(self.data, "<")
        n = max(len(self.data) - GRAM + 1, 0)
        gram = words[:n][where] * np.uint64(0x9E3779B97F4A7C15)
        gram ^= gram >> np.uint64(29)
        gram += words[8 : n + 8][where] * np.uint64(0xC2B2AE3D27D4EB4F)
        return mixed(gram)

    def _grams(self, at: np.ndarray) -> np.ndarray:
        """Chosen hashes are small numbers; scrambled again they spread evenly over the buckets."""
        return mixed(self._hashed(at)) if len(at) else np.zeros(0, np.uint64)

    @cached_property
    def hash(self) -> RangeHash:
        return RangeHash(random_table(256, 3)[self.data])

    def window_hashes(self, starts: np.ndarray, window: int) -> Distinct:
        """128 bits for each window: two hashes over independent random numbers of the bytes."""
        second = RangeHash(random_table(256, 7)[self.data])
        return Distinct(self.hash.of(starts, starts + window), second.of(starts, starts + window))

    def pieces(self, which: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs `which` cut into pieces: (index into `which`, first and last window start, hash of the
        core, hash of all bytes). Windows of a piece are at similar distances from the gram, so all of
        them hold the bytes in the middle, the core; equal windows are in pieces with equal cores."""
        first, last, at = self.first[which], self.last[which], self.at[which]
        low, high = (at - last) // PIECE, (at - first) // PIECE  # classes of distance
        times = high - low + 1
        of = np.repeat(np.arange(len(which)), times)
        number = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
        latest = at[of] - number * PIECE  # the last start that the class can have
        begin, end = np.maximum(first[of], latest - PIECE + 1), np.minimum(last[of], latest)
        core = self.hash.of(latest, latest - PIECE + 1 + window)
        return of, begin, end, core, self.hash.of(begin, end + window)


def _ask(window: int, buckets: int):
    def work(table: pa.Table) -> pa.Table:
        runs = _Runs(table, window)
        distinct = Distinct(runs.gram, runs.segment)
        return asked(table.column(BLOCK)[0].as_py(), distinct, (distinct.counts > 1).astype(np.uint8), buckets)
    return work


def _ask_pieces(window: int, buckets: int):
    """The pieces of the segments of hot grams, each asked for by the block that stands for its segment."""
    def work(table: pa.Table, answers: pa.Table) -> pa.Table:
        pieces = _hot_pieces(table, answers, window)
        if pieces is None:
            return NOTHING_ASKED
        _, _, _, distinct, many, _ = pieces
        return asked(table.column(BLOCK)[0].as_py(), distinct, many, buckets)
    return work


def _hot_pieces(table: pa.Table, answers: pa.Table, window: int, runs: _Runs | None = None):
    """(first and last start of each piece, the piece of each of these, their distinct keys, whether one of
    its copies is sure to occur elsewhere, runs); None if the block stands for no hot segment."""
    reply = replies_of(answers, 0, "u1") if answers.num_rows else np.zeros(0, np.uint8)
    hot = np.flatnonzero((reply & (HOT | SEND)) == HOT | SEND)
    if not len(hot) or not table.num_rows:
        return None
    runs = runs or _Runs(table, window)
    which = Distinct(runs.gram, runs.segment).first[hot]
    of, begin, end, core, whole = runs.pieces(which, window)
    distinct = Distinct(core, whole)
    sure = (reply[hot] & REPEATED > 0)[of]
    many = (np.bincount(distinct.inverse, weights=sure, minlength=len(distinct.first)) + distinct.counts > 1)
    return begin, end, distinct.inverse, distinct, many.astype(np.uint8), runs


def _ask_windows(window: int, buckets: int):
    """The single windows of the pieces of hot cores, each asked for by the block that stands for its piece."""
    def work(table: pa.Table, answers: pa.Table) -> pa.Table:
        found = _hot_windows(table, answers, window)
        if found is None:
            return NOTHING_ASKED
        _, distinct, many = found
        return asked(table.column(BLOCK)[0].as_py(), distinct, many, buckets)
    return work


def _hot_windows(table: pa.Table, answers: pa.Table, window: int, runs: _Runs | None = None, pieces=None):
    """(starts of the windows, their distinct keys, whether one of its copies is sure to occur elsewhere);
    None if the block stands for no hot piece."""
    reply = replies_of(answers, 2, "u1") if answers.num_rows else np.zeros(0, np.uint8)
    hot = np.flatnonzero((reply & (HOT | SEND)) == HOT | SEND)
    if not len(hot):
        return None
    begin, end, _, distinct, _, runs = pieces or _hot_pieces(table, answers, window, runs)
    piece = distinct.first[hot]
    sizes = end[piece] - begin[piece] + 1
    starts = np.repeat(begin[piece] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    windows = runs.window_hashes(starts, window)
    sure = np.repeat(reply[hot] & REPEATED > 0, sizes)
    many = np.bincount(windows.inverse, weights=sure, minlength=len(windows.first)) + windows.counts > 1
    return starts, windows, many.astype(np.uint8)


def _judge(hot_segments: int):
    """Segments that occur twice are covered as they are. If a gram has different segments, the first
    sender of each is asked for its bytes; copies are never sent twice."""
    def work(keys: list[np.ndarray], many: np.ndarray, _blocks: np.ndarray) -> np.ndarray:
        same = Distinct(*keys)
        repeated = np.bincount(same.inverse, weights=many, minlength=len(same.first)) + same.counts > 1
        gram = Distinct(same.keys[0])
        several = gram.counts[gram.inverse]
        reply = repeated[same.inverse].astype(np.uint8) * np.uint8(REPEATED)
        reply[same.first[several > 1]] |= np.uint8(SEND)
        reply[same.first[several > hot_segments]] |= np.uint8(HOT)
        return reply
    return work


NOTHING_ASKED = pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.int64()),
                          "hashes": pa.array([], pa.binary()), "extra": pa.array([], pa.binary())})


def _send(window: int, buckets: int):
    """Bytes of the segments that have to be compared, and of the pieces of hot ones. Neither hot segments nor
    hot pieces are sent."""
    def work(table: pa.Table, answers: pa.Table) -> pa.Table:
        out = {k: [] for k in ("bucket", "block", "grams", "starts", "lengths", "sure", "data")}
        if table.num_rows and answers.num_rows:
            runs = _Runs(table, window)
            distinct = Distinct(runs.gram, runs.segment)
            reply = replies_of(answers, 0, "u1")
            chosen = np.flatnonzero((reply & (HOT | SEND)) == SEND)
            run = distinct.first[chosen]
            parts = [(distinct.keys[0][chosen], runs.first[run], runs.last[run] + window, reply[chosen] & REPEATED)]
            pieces = _hot_pieces(table, answers, window, runs)
            if pieces is not None:
                begin, end, _, distinct, _, _ = pieces
                reply = replies_of(answers, 2, "u1")
                chosen = np.flatnonzero((reply & (HOT | SEND)) == SEND)
                piece = distinct.first[chosen]
                parts.append((distinct.keys[0][chosen], begin[piece], end[piece] + window, reply[chosen] & REPEATED))
            keys, starts, ends, sure = (np.concatenate(x) for x in zip(*parts))
            by = np.argsort(keys, kind="stable")
            keys, starts, ends, sure = keys[by], starts[by], ends[by], sure[by].astype(np.uint8)
            cuts = np.concatenate([[0], np.searchsorted(keys, edges(buckets)), [len(keys)]])
            raw = runs.data.tobytes()
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                own = slice(cuts[b], cuts[b + 1])
                out["bucket"].append(b)
                out["block"].append(table.column(BLOCK)[0].as_py())
                out["grams"].append(keys[own].tobytes())
                out["starts"].append(starts[own].astype(np.int64).tobytes())
                out["lengths"].append((ends - starts)[own].astype(np.int64).tobytes())
                out["sure"].append(sure[own].tobytes())
                out["data"].append(b"".join(raw[x:y] for x, y in zip(starts[own].tolist(), ends[own].tolist())))
        types = (pa.int32(), pa.int64(), *[pa.binary()] * 5)
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), types)})
    return work


def deep_shallow_sort(data: np.ndarray, starts: np.ndarray, depth: int,
                      shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes at `starts` by their first `depth` bytes.

    Multikey quicksort splits groups by 8 bytes at a time, to `shallow` bytes. Each group that is left
    has a long common prefix; it becomes a blind trie: every member is compared once with the group's
    leader, and branches off at the depth and byte of the first difference; members that branch off at
    the same place make the next group. All groups take a step at a time.

    Returns the order (indices into `starts`) and, for each place in it, whether the suffix there
    equals the one before it in all `depth` bytes. Bytes behind the end count as zero.
    """
    words = padded_words(data, ">")
    n, end = len(starts), len(words) - 1

    def key(which: np.ndarray, at: int) -> np.ndarray:
        found = words[np.minimum(starts[which] + at, end)].astype(np.uint64)
        return found >> np.uint64(8 * (at + 8 - depth)) if at + 8 > depth else found

    order = np.arange(n)
    new = np.zeros(n + 1, bool)  # where a group begins
    new[[0, n]] = True
    for at in range(0, min(shallow, depth), 8):
        _split(order, new, _open(new), lambda w: key(w, at))
    same = np.zeros(n, bool)
    settled = np.zeros(n, bool)
    at = min(shallow, depth)
    if at == depth:
        same[1:] = ~new[1:n]
        return order, same
    while True:
        places = _open(new)
        places = places[~settled[places]]
        if not len(places):
            return order, same
        first = np.maximum.accumulate(np.where(new[:n], np.arange(n), 0))[places]
        member, leader = order[places], order[first]
        branch = np.full(len(places), -1, np.int64)
        left = np.arange(len(places))
        for a in range(at, depth, 8):
            mine, theirs = key(member[left], a), key(leader[left], a)
            differ = mine != theirs
            hit = left[differ]
            size = min(8, depth - a)
            bit = 63 - _high_bit((mine ^ theirs)[differ]) - 8 * (8 - size)
            byte = a + bit // 8
            shift = (8 * (size - 1 - bit // 8)).astype(np.uint64)
            own = ((mine[differ] >> shift) & np.uint64(255)).astype(np.int64)
            less = mine[differ] < theirs[differ]
            branch[hit] = np.where(less, byte * 256 + own, (2 * depth + 1 - byte) * 256 + own)
            left = left[~differ]
        equal = branch < 0
        branch[equal] = depth * 256  # between the smaller and the larger
        _split_by(order, new, places, first, branch)
        # Members equal to their leader are together now; they need no further comparison.
        group = np.lexsort((branch, first))
        done = places[equal[group]]
        settled[done] = True
        again = done[~new[done]]
        same[again] = True


def _high_bit(x: np.ndarray) -> np.ndarray:
    """Place of the highest set bit."""
    place = np.zeros(len(x), np.int64)
    x = x.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = x >= (np.uint64(1) << np.uint64(step))
        place[big] += step
        x[big] >>= np.uint64(step)
    return place


def _open(new: np.ndarray) -> np.ndarray:
    """Places in groups of two or more."""
    return np.flatnonzero(~(new[:-1] & new[1:]))


def _split(order: np.ndarray, new: np.ndarray, places: np.ndarray, key) -> None:
    if len(places):
        first = np.maximum.accumulate(np.where(new[:-1], np.arange(len(order)), 0))[places]
        _split_by(order, new, places, first, key(order[places]))


def _split_by(order: np.ndarray, new: np.ndarray, places: np.ndarray, first: np.ndarray, key: np.ndarray) -> None:
    """Order the members at `places` within their groups by key; equal keys make the new groups."""
    by = np.lexsort((key, first))
    order[places] = order[places][by]
    key = key[by]
    new[places[1:][(key[1:] != key[:-1]) & (first[1:] == first[:-1])]] = True


def _sort(window: int, at_once: int):
    def work(table: pa.Table) -> pa.Table:
        def column(name: str, dtype: str) -> list[np.ndarray]:
            return [np.frombuffer(x, dtype) for x in table.column(name).to_pylist()]

        lengths = column("lengths", "i8")
        asked_by = np.repeat(np.arange(len(lengths)), [len(x) for x in lengths])
        length, start = np.concatenate(lengths), np.concatenate(column("starts", "i8"))
        sure = np.concatenate(column("sure", "u1")) > 0
        grams = np.concatenate(column("grams", "u8"))
        data = np.concatenate(column("data", "u1"))
        base = np.cumsum(length) - length
        by_gram = np.argsort(grams, kind="stable")
        last = np.append(grams[by_gram][1:] != grams[by_gram][:-1], True)
        total = np.cumsum((length - window + 1)[by_gram])
        owners, places = [], []
        begin = 0
        while begin < len(by_gram):
            done = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, done + at_once, side="right")))
            while not last[end - 1]:
                end += 1
            own = by_gram[begin:end]
            begin = end
            windows = (length - window + 1)[own]
            of = np.repeat(own, windows)
            inner = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
            # Only these segments' bytes, one after the other.
            sizes = length[own]
            shift = np.cumsum(sizes) - sizes
            bytes_ = data[np.repeat(base[own] - shift, sizes) + np.arange(sizes.sum())]
            starts = np.repeat(shift, windows) + inner
            twice = np.zeros(len(of), bool)
            # A gram with more suffixes than are sorted at a time: equal strings are in one part.
            parts = -(-len(of) // at_once)
            part = (RangeHash(random_table(256, 5)[bytes_]).of(starts, starts + window) % np.uint64(parts)
                    if parts > 1 else np.zeros(len(of), np.uint64))
            for i in range(parts):
                mine = np.flatnonzero(part == i)
                order, same = deep_shallow_sort(bytes_, starts[mine], window)
                twice[mine[order]] = same | np.append(same[1:], False)
            twice &= ~sure[of]
            owners.append(asked_by[of[twice]])
            places.append((start[of] + inner)[twice])
        owner, at = np.concatenate(owners), np.concatenate(places)
        blocks = table.column("block").to_numpy()[owner]
        by = np.argsort(blocks, kind="stable")
        values, begin = np.unique(blocks[by], return_index=True)
        parts = np.split(at[by], begin[1:]) if len(values) else []
        return pa.table({
            "block": pa.array(values, pa.int64()),
            "kind": pa.array(np.ones(len(values)), pa.int32()),
            "bucket": pa.array(np.full(len(values), table.column("bucket")[0].as_py()), pa.int32()),
            "reply": pa.array([x.astype(np.int64).tobytes() for x in parts], pa.binary()),
        })
    return work


def _cut(window: int):
    def work(table: pa.Table, answers: pa.Table) -> pa.Table:
        runs = _Runs(table, window)
        n, offsets = len(runs.data), runs.offsets
        gone = np.zeros(n, bool)
        if answers.num_rows:
            reply = replies_of(answers, 0, "u1")
            if len(runs.first):
                whole = reply[Distinct(runs.gram, runs.segment).inverse] & REPEATED > 0
                gone |= marked(runs.first[whole], runs.last[whole] + window, n)
            pieces = _hot_pieces(table, answers, window, runs)
            if pieces is not None:
                begin, end, inverse, _, _, _ = pieces
                whole = replies_of(answers, 2, "u1")[inverse] & REPEATED > 0
                gone |= marked(begin[whole], end[whole] + window, n)
                windows = _hot_windows(table, answers, window, runs, pieces)
                if windows is not None:
                    starts, distinct, _ = windows
                    twice = starts[replies_of(answers, 3, "u1")[distinct.inverse] > 0]
                    gone |= marked(twice, twice + window, n)
            at = replies_of(answers, 1, "i8")
            gone |= marked(at, at + window, n)
        inner = np.zeros(n + 1, bool)
        inner[1:n] = gone[: max(n - 1, 0)]
        inner[offsets] = False  # no run goes on into the next text
        begins = np.flatnonzero(gone & ~inner[:n])
        after = np.zeros(n + 1, bool)
        after[:n] = gone
        after[offsets[:-1]] = False
        ends = np.flatnonzero(gone & ~after[1:]) + 1 if n else begins
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[offsets[1:]] - total[offsets[:-1]]
        raw = runs.data[~gone].tobytes()
        bounds = (offsets - total[offsets]).tolist()
        kept = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
        spans = np.searchsorted(begins, offsets)
        text_of = np.repeat(np.arange(len(kept)), np.diff(spans))
        pairs = pa.StructArray.from_arrays(
            [pa.array(begins - offsets[text_of], pa.int64()), pa.array(ends - offsets[text_of], pa.int64())],
            names=["start", "end"])
        return pa.table({
            TEXT: pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()),
            PAYLOAD: table.column(PAYLOAD),
            "n_bytes": pa.array(np.diff(offsets), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(np.diff(spans), pa.int64()),
            "spans": pa.ListArray.from_arrays(pa.array(spans, pa.int32()), pairs),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        })
    return work


def remove_repeated_bytes(docs: DataFrame, window: int = 200, text: str = "text",
                          hot_segments: int = HOT_SEGMENTS, sorted_at_once: int = SORTED) -> DataFrame:
    """Remove each byte covered by a `window`-byte string that also starts anywhere else.

    Texts are UTF-8 bytes; strings lie within one row and are judged on the input. Windows are
    gathered in runs by their gram with the smallest hash. A run whose whole bytes occur elsewhere is
    covered at once; runs of one gram that differ send their bytes, one copy each, to the bucket of
    the gram, where all their suffixes are sorted and equal neighbours found. A gram in very many
    different runs (a passage that many texts share) is not one group: its runs are cut into pieces
    that are judged again by most of their bytes, and only pieces that share these meet. If very many
    different pieces share these, too, their single windows are compared by 128 bits.

    Returns the columns of `docs` with the text that is left (a character of which only some bytes are
    left goes too), n_bytes, n_removed, n_spans, spans (start and end byte), and kept_sha256 over the
    bytes left. Null and empty texts have no bytes. Rows are not told apart by any column, so repeated
    ids and nulls are ordinary rows; new columns replace those of the same names.
    """
    if window < 2 * GRAM:
        raise ValueError(f"window must be at least {2 * GRAM} bytes")
    blocks = Blocks(docs, text, lambda block: _Runs(block, window).note(window))
    judged = materialize(compare(blocks.each(_ask(window, blocks.buckets), ASK_SCHEMA), _judge(hot_segments), 2, "u1"), "judged")
    asks = blocks.with_replies(judged, _ask_pieces(window, blocks.buckets), ASK_SCHEMA)
    judged = judged.union(materialize(compare(asks, _judge(hot_segments), 2, "u1", kind=2), "judged"))
    asks = blocks.with_replies(judged, _ask_windows(window, blocks.buckets), ASK_SCHEMA)
    windows = materialize(compare(asks, occurs_elsewhere, 2, "u1", kind=3), "windows")
    segments = blocks.with_replies(judged, _send(window, blocks.buckets), SEGMENT_SCHEMA)
    sorted_windows = materialize(segments.groupBy("bucket").applyInArrow(_sort(window, sorted_at_once), REPLY_SCHEMA), "sorted")
    new = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(),
           "spans": T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                              T.StructField("end", T.LongType())])),
           "kept_sha256": T.StringType()}
    schema = T.StructType([T.StructField(TEXT, T.StringType()), blocks.schema[PAYLOAD],
                           *[T.StructField(k, v) for k, v in new.items()]])
    result = blocks.with_replies(judged.union(windows).union(sorted_windows), _cut(window), schema)
    return with_columns(result, docs, text, *new)
