"""Approximate nearest neighbours: NN-descent builds a graph by Spark joins, queries walk it greedily.

Vectors are dealt by a hash of their node number into slots of a few thousand. A slot is one row of
packed arrays, so a round of the descent or of the walk moves a row per pair of slots, not one per edge,
and each slot gets a vector once, however many of its nodes ask for it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from pricebeam.llm.textarrays import mixed
from pricebeam.session import discard, materialize, scratch_path

#: Neighbours of a node, and how many of the nodes that point at it are sampled in each round.
NEIGHBOURS, REVERSE = 48, 48
#: Candidates that one local join offers to one of its members.
OFFERS = 6
#: The first lists: about the best so many of a leaf of each of a few trees, which cut the nodes by direction at medians
#: of a sample of so many a leaf, and of a run in random order, without which no path would lead from one leaf to another.
#: A leaf has between LEAST_LEAF and LEAF nodes, a sixteenth of all.
FIRST, TREES, LEAST_LEAF, LEAF, LEAF_SAMPLED, LEAVES, RUN = 16, 8, 128, 4096, 64, 4096, 128
#: Nodes of a slot, and numbers in the vectors of one.
SLOT_NODES, SLOT_NUMBERS = 2048, 1 << 17
#: A walk meets wider slots, so that a query's vector is sent to fewer: nodes and numbers of one, slots below which they
#: are not joined, and queries whose pools are one row.
WIDE_NODES, WIDE_NUMBERS, WIDE_FROM, HOME = 16384, 1 << 22, 32, 1024
#: The descent ends when under this share of all neighbours changed in a round, or after so many rounds.
SETTLED, ROUNDS = 0.02, 12
#: Best nodes a search keeps, and how many of them it opens in a round.
POOL, OPENED = 128, 24
#: Nodes of the largest norm from which every search starts too, where norms differ.
LONGEST = 32
#: Best nodes whose exact scores decide.
EXACT = 48
#: The pool is doubled until the sampled queries find this share of their true nearest, or it holds all nodes.
RECALL, SAMPLED = 0.95, 100
#: From so many queries on, the sampled ones walk alone until the pool is known.
ALONE = 10_000
#: Numbers in a matrix that a task multiplies at a time, and in those of small products, which stay in the cache.
CELLS, SMALL = 1 << 21, 1 << 18
#: Offers that a task holds before it drops all but the best of each node, and bytes of a batch of messages.
HELD, BATCH = 1 << 19, 1 << 26

STATE = ("slot int, ids binary, vecs binary, norms binary, near binary, sims binary, fresh binary, changed long")
WIDE = "slot int, ids binary, vecs binary, norms binary, near binary"
POOLS = "slot int, ids binary, vecs binary, near binary, sims binary, open binary, left long"
#: Messages: `to` and `kind` are the slots that get and send them.
EDGES = "to int, kind int, node binary, other binary, fresh binary"
SENT = "to int, kind int, ids binary, vecs binary, norms binary, least binary, node binary, other binary, fresh binary"
SCORES = "to int, kind int, node binary, other binary, score binary"
OPENING = "to int, kind int, node binary"
LISTS = "to int, kind int, node binary, near binary"
WANTED = "to int, kind int, at binary, other binary, query binary, vecs binary, least binary"


def slot_of(nodes: np.ndarray, slots: int) -> np.ndarray:
    return (mixed(nodes.astype(np.uint64)) % np.uint64(slots)).astype(np.int32)


def _array(table: pa.Table, name: str, kind: str, row: int = 0) -> np.ndarray:
    return np.frombuffer(table.column(name)[row].as_buffer(), kind)


def _flat(table: pa.Table, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The arrays of all rows, one behind the other, and their lengths; read in place if they are one chunk."""
    size, parts, lengths = np.dtype(kind).itemsize, [np.empty(0, kind)], [np.empty(0, np.int64)]
    for chunk in table.column(name).chunks:
        if len(chunk):
            wide = pa.types.is_large_binary(chunk.type)
            ends = np.frombuffer(chunk.buffers()[1], np.int64 if wide else np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
            lengths.append(np.diff(ends).astype(np.int64) // size)
            if ends[-1] > ends[0]:
                parts.append(np.frombuffer(chunk.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind))
    return parts[-1] if len(parts) <= 2 else np.concatenate(parts), np.concatenate(lengths)


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Row i holds the values from starts[i] to starts[i + 1]."""
    width = values.itemsize * int(np.prod(values.shape[1:], dtype=np.int64))
    begin, end = int(starts[0]), int(starts[-1])
    offsets = ((starts - begin) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values[begin:end]))])


def _rows(schema: str, to: np.ndarray, kind: np.ndarray | int, *columns: tuple[np.ndarray, np.ndarray]) -> pa.Table:
    """Rows of `schema`: (to, kind) and columns of (values, starts); in batches of which each holds its bytes."""
    names = [f.split()[0] for f in schema.split(", ")]
    arrow = pa.schema([(n, pa.int32()) for n in names[:2]] + [(n, pa.binary()) for n in names[2:]])
    kind = np.full(len(to), kind, np.int32) if np.isscalar(kind) else kind.astype(np.int32)
    size = sum(np.diff(s) * v.itemsize * int(np.prod(v.shape[1:], dtype=np.int64)) for v, s in columns)
    batch, out, begin = np.cumsum(size) // BATCH if len(to) else size, [], 0
    for end in [*(np.flatnonzero(np.diff(batch)) + 1).tolist(), len(to)]:
        if end > begin:
            out.append(pa.RecordBatch.from_arrays(
                [pa.array(to[begin:end].astype(np.int32)), pa.array(kind[begin:end]), *(_binary(v, s[begin : end + 1]) for v, s in columns)], schema=arrow))
        begin = end
    return pa.Table.from_batches(out, arrow)


def _none(schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in schema.split(", "))]).empty_table()


def _dealt(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by key that keeps the order of equal keys, the distinct keys, and where each begins in it."""
    order = _ordered(keys)
    keys = keys[order]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return order, keys[begin], np.append(begin, len(keys))


def _ordered(keys: np.ndarray) -> np.ndarray:
    """A stable order of numbers from 0 on. Sorting packed numbers is many times as fast as ordering rows."""
    bits = max(1, len(keys)).bit_length()
    if not len(keys) or int(keys.max()) >> (62 - bits):
        return np.argsort(keys, kind="stable")
    return np.sort((keys.astype(np.int64) << bits) | np.arange(len(keys))) & ((1 << bits) - 1)


def _ranks(keys: np.ndarray) -> np.ndarray:
    """The place of each row among the rows of its key; `keys` is sorted."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    return np.arange(len(keys)) - np.repeat(at, np.diff(np.append(at, len(keys))))


def _pairs(of: np.ndarray, other: np.ndarray) -> np.ndarray:
    """A number for each pair, in the order of (of, other)."""
    if not len(of):
        return np.empty(0, np.int64)
    least, most = int(other.min()), int(other.max())
    if (int(of.max()) + 1) * (most - least + 1) >= 1 << 61:
        least, other = 0, np.unique(other, return_inverse=True)[1]
        most = int(other.max())
    return of.astype(np.int64) * (most - least + 1) + (other - least)


def best_of(of: np.ndarray, other: np.ndarray, score: np.ndarray, mark: np.ndarray, most: int) -> np.ndarray:
    """Positions of the best `most` distinct others of each `of`, ordered by (of, best first). Of equal
    entries that with the smallest mark stays; equal scores go by the smaller other."""
    order = _ordered(_pairs(of, other) * 2 + (mark > 0))
    same = np.zeros(len(of), bool)
    same[1:] = (of[order][1:] == of[order][:-1]) & (other[order][1:] == other[order][:-1])
    order = order[~same]
    order = order[np.argsort(-score[order], kind="stable")]
    order = order[_ordered(of[order])]
    return order[_ranks(of[order]) < most]


class _Slot:
    """The packed state of a slot, as far as it is read."""

    def __init__(self, table: pa.Table, dims: int, most: int):
        self.slot = table.column("slot")[0].as_py()
        shapes = {"ids": ("i8", -1), "vecs": ("f4", (-1, dims)), "norms": ("f8", -1), "near": ("i8", (-1, most)),
                  "sims": ("f8", (-1, most)), "fresh": ("?", (-1, most))}
        for name in table.column_names:
            if name in shapes:
                setattr(self, name, _array(table, name, shapes[name][0]).reshape(shapes[name][1]))

    def edges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the node, neighbour, fresh) of all neighbours."""
        place, column = np.nonzero(self.near >= 0)
        return place, self.near[place, column], self.fresh[place, column]

    def place(self, nodes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ids, nodes)


def _point(dims: int, most: int, slots: int):
    """Each slot tells the slots of its nodes' neighbours who points at them."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = _Slot(pa.Table.from_batches([batch.slice(i, 1)]), dims, most)
                place, near, fresh = s.edges()
                order, to, starts = _dealt(slot_of(near, slots))
                yield from _rows(EDGES, to, s.slot, (near[order], starts), (s.ids[place[order]], starts), (fresh[order], starts)).to_batches()
    return work


def _send(dims: int, most: int, slots: int):
    """A slot samples who points at its nodes. It sends each of its vectors once to every slot that has a node which
    its node points at, or which points at its node."""
    def work(state: pa.Table, edges: pa.Table) -> pa.Table:
        if not state.num_rows:
            return _none(SENT)
        s = _Slot(state, dims, most)
        (node, length), (other, _), (fresh, _) = (_flat(edges, c, k) for c, k in (("node", "i8"), ("other", "i8"), ("fresh", "?")))
        asked = np.repeat(edges.column("kind").to_numpy().astype(np.int64), length)
        at = s.place(node)
        order = np.lexsort((mixed(other.astype(np.uint64) ^ mixed(node.astype(np.uint64))), ~fresh, at))
        kept = order[_ranks(at[order]) < REVERSE]
        place, column = np.nonzero(s.near >= 0)
        meets = np.concatenate([asked, slot_of(s.near[place, column], slots)]) * len(s.ids) + np.concatenate([at, place])
        meets = np.unique(meets)
        to, at = np.divmod(meets[meets // len(s.ids) != s.slot], len(s.ids))
        _, to, starts = _dealt(to)
        none = np.zeros(len(to), np.int64)  # the sample goes along in a row to the slot itself
        to, starts, sample = np.append(to, s.slot), np.append(starts, starts[-1]), np.append(none, [0, len(kept)])
        return _rows(SENT, to, s.slot, (s.ids[at], starts), (s.vecs[at], starts), (s.norms[at], starts), (s.sims[at, -1], starts),
                     (node[kept], sample), (other[kept], sample), (fresh[kept], sample))
    return work


def _join(dims: int, most: int, slots: int):
    """All that meet in a node's list, its own neighbours and those that point at it, are compared."""
    def work(state: pa.Table, sent: pa.Table) -> pa.Table:
        if not state.num_rows or not sent.num_rows:
            return _none(SCORES)
        s = _Slot(state, dims, most)
        ids, norms, least = (np.concatenate([_flat(sent, c, k)[0], own]) for c, k, own in (
            ("ids", "i8", s.ids), ("norms", "f8", s.norms), ("least", "f8", s.sims[:, -1])))
        vecs = np.concatenate([_flat(sent, "vecs", "f4")[0].reshape(-1, dims), s.vecs])
        by = np.argsort(ids)
        known = ids[by]
        place, other, fresh = s.edges()
        node, points, seen = (_flat(sent, c, k)[0] for c, k in (("node", "i8"), ("other", "i8"), ("fresh", "?")))
        at = np.concatenate([place, np.arange(len(s.ids)), s.place(node)])
        member = np.concatenate([by[np.searchsorted(known, other)], len(ids) - len(s.ids) + np.arange(len(s.ids)),
                                 by[np.searchsorted(known, points)]])
        new = np.concatenate([fresh, np.zeros(len(s.ids), bool), seen])
        order = _ordered((at * len(ids) + member) * 2 + ~new)
        at, member, new = at[order], member[order], new[order]
        first = np.ones(len(at), bool)
        first[1:] = (at[1:] != at[:-1]) | (member[1:] != member[:-1])
        at, member, new = at[first], member[first], new[first]
        order = _ordered(at * 2 + ~new)  # the new ones of each list first
        at, member, new = at[order], member[order], new[order]
        begin = np.searchsorted(at, np.arange(len(s.ids) + 1))
        size, news = np.diff(begin), np.bincount(at[new], minlength=len(s.ids))
        order = np.lexsort((size, news))
        order = order[news[order] > 0]
        held, waiting, i = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)), [], 0
        while i < len(order):
            j, width = i + 1, int(size[order[i]])
            while j < len(order):
                wider = max(width, int(size[order[j]]))
                if (j - i + 1) * wider * max(int(news[order[j]]), dims) > SMALL:
                    break
                j, width = j + 1, wider
            nodes = order[i:j]
            real = np.arange(width) < size[nodes][:, None]
            who = member[np.where(real, begin[nodes][:, None] + np.arange(width), begin[nodes][:, None])]
            waiting += _offers(who, vecs, norms, least, news[nodes], real)
            if sum(len(x[0]) for x in waiting) > HELD:
                held, waiting = _best_offers([held, *waiting], most), []
            i = j
        a, b, score = _best_offers([held, *waiting], most)
        a, b = ids[a], ids[b]
        order, to, starts = _dealt(slot_of(a, slots))
        return _rows(SCORES, to, s.slot, (a[order], starts), (b[order], starts), (score[order], starts))
    return work


def _best_offers(offers: list[tuple[np.ndarray, ...]], most: int) -> tuple[np.ndarray, ...]:
    a, b, score = (np.concatenate(x) for x in zip(*offers))
    kept = best_of(a, b, score, np.zeros(len(a), np.int8), most)
    return a[kept], b[kept], score[kept]


def _offers(who: np.ndarray, vecs: np.ndarray, norms: np.ndarray, least: np.ndarray, news: np.ndarray,
            real: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """(member, other, score): for each member of each list the best others that its own list would
    take, of the pairs in which at least one is new there. The first `news` of a list are its new ones."""
    some, width = int(news.max()), who.shape[1]
    exact = vecs[who].astype(np.float64)
    scaled = exact * norms[who][:, :, None]
    new = np.arange(width) < news[:, None]
    out = [_best_pairs(who[:, :some], who, exact[:, :some] @ scaled.transpose(0, 2, 1), least, new[:, :some], real)]
    if (news < real.sum(axis=1)).any():  # the new ones to the old ones
        out.append(_best_pairs(who, who[:, :some], exact @ scaled[:, :some].transpose(0, 2, 1), least, real & ~new, new[:, :some]))
    return out


def _best_pairs(who: np.ndarray, others: np.ndarray, sims: np.ndarray, least: np.ndarray, rows: np.ndarray,
                columns: np.ndarray) -> tuple[np.ndarray, ...]:
    sims += np.where(columns, 0.0, -np.inf)[:, None, :]
    both = np.arange(min(sims.shape[1:]))
    sims[:, both, both] = -np.inf
    wanted = sims > np.where(rows, least[who], np.inf)[:, :, None]
    if sims.shape[2] > OFFERS:
        sims[~wanted] = -np.inf
        top = np.argpartition(sims, -OFFERS, axis=2)[:, :, -OFFERS:]
        score = np.take_along_axis(sims, top, axis=2)
        node, row, column = np.nonzero(score > -np.inf)
        return who[node, row], others[node, top[node, row, column]], score[node, row, column]
    node, row, column = np.nonzero(wanted)
    return who[node, row], others[node, column], sims[node, row, column]


def _merge(dims: int, most: int):
    """A slot's lists after the offers of all slots."""
    def work(state: pa.Table, offers: pa.Table) -> pa.Table:
        if not state.num_rows:
            return _none(STATE)
        s = _Slot(state, dims, most)
        place, column = np.nonzero(s.near >= 0)
        (a, _), (b, _), (score, _) = (_flat(offers, c, k) for c, k in (("node", "i8"), ("other", "i8"), ("score", "f8")))
        of, other = np.concatenate([place, s.place(a)]), np.concatenate([s.near[place, column], b])
        return _packed(s.slot, s.ids, s.vecs, s.norms, of, other, np.concatenate([s.sims[place, column], score]),
                       np.arange(len(of)) >= len(place), most)
    return work


def _packed(slot: int, ids: np.ndarray, vecs: np.ndarray, norms: np.ndarray, of: np.ndarray, other: np.ndarray,
            score: np.ndarray, new: np.ndarray, most: int) -> pa.Table:
    kept = best_of(of, other, score, new, most)
    of, other, score, new = of[kept], other[kept], score[kept], new[kept]
    rank = _ranks(of)
    near, sims = np.full((len(ids), most), -1, np.int64), np.full((len(ids), most), -np.inf)
    fresh = np.zeros((len(ids), most), bool)
    near[of, rank], sims[of, rank], fresh[of, rank] = other, score, new
    return pa.table({"slot": [slot], "ids": [ids.tobytes()], "vecs": [vecs.tobytes()], "norms": [norms.tobytes()],
                     "near": [near.tobytes()], "sims": [sims.tobytes()], "fresh": [fresh.tobytes()],
                     "changed": [int(new.sum())]}, _none(STATE).schema)


def _scaled(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors divided by a power of two, to at most 2, and its exponent. So 32 bits hold what a float held, and
    only further digits of a double are rounded. Shorter vectors count as padded with zeros."""
    exact, length = np.zeros((len(vectors), dims)), np.diff(vectors.offsets.to_numpy())
    exact[np.arange(dims) < length[:, None]] = vectors.flatten().to_numpy()
    exponent = np.frexp(np.abs(exact).max(axis=1, initial=0))[1] - 1
    return np.ldexp(exact, -exponent[:, None]), exponent


def _directions(scaled: np.ndarray) -> np.ndarray:
    return scaled / np.sqrt(np.square(scaled).sum(axis=1, keepdims=True))


def _tree(sample: np.ndarray, depth: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The planes and cuts of each level. A cell is cut between two means of its part of a sample, at the median."""
    rng, cell, levels = np.random.default_rng(seed), np.zeros(len(sample), np.int64), []
    for level in range(depth):
        planes, cuts = np.zeros((1 << level, sample.shape[1])), np.zeros(1 << level)
        order, cells, starts = _dealt(cell)
        for c, begin, end in zip(cells, starts, starts[1:]):
            some = sample[order[begin:end]]
            one, two = some[rng.integers(len(some))], some[rng.integers(len(some))]
            for _ in range(4):
                along = some @ (one - two)
                side = along > np.median(along)
                if side.any():
                    one, two = some[side].mean(axis=0), some[~side].mean(axis=0)
            planes[c] = one - two
            cuts[c] = np.median(some @ planes[c])
        levels.append((planes, cuts))
        cell = _below(cell, sample, planes, cuts)
    return levels


def _below(cell: np.ndarray, directions: np.ndarray, planes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return 2 * cell + (np.einsum("ij,ij->i", directions, planes[cell]) > cuts[cell])


def _in_leaves(dims: int, largest: int, trees: list[list[tuple[np.ndarray, np.ndarray]]], runs: int):
    """(leaf, node, vec, norm) for each tree and for a hash: the scaled vector, and its scale in units of 2**`largest`."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scaled, exponent = _scaled(batch.column("vector"), dims)
            directions, nodes = _directions(scaled), batch.column("node").to_numpy()
            rows = [pa.array(nodes), _binary(scaled.astype(np.float32), np.arange(len(nodes) + 1)), pa.array(np.ldexp(1.0, exponent - largest))]
            for number, levels in enumerate([*trees, None]):
                cell = np.zeros(len(nodes), np.int64)
                for planes, cuts in levels or ():
                    cell = _below(cell, directions, planes, cuts)
                if levels is None:
                    cell, number = slot_of(nodes, runs).astype(np.int64), -1
                yield pa.RecordBatch.from_arrays([pa.array(number * (1 << 32) + cell), *rows], names=["leaf", "node", "vec", "norm"])
    return work


def _first_lists(dims: int, slots: int):
    """(slot, node, vec, norm, near, sims): the best of each leaf; the vector is in the rows of one tree."""
    def work(table: pa.Table) -> pa.Table:
        tree = table.column("leaf")[0].as_py() >> 32
        nodes, norms = table.column("node").to_numpy(), table.column("norm").to_numpy()
        vecs = _flat(table, "vec", "f4")[0].reshape(-1, dims)
        order = np.argsort(mixed(nodes.astype(np.uint64)))
        if tree < 0:
            parts = [order[i : i + RUN] for i in range(0, len(order), RUN)]
        else:
            parts = np.array_split(order, -(-len(order) // (2 * LEAF)))
        near, sims, lengths = [], [], []
        for part in parts:
            exact = vecs[part].astype(np.float64)
            scaled, best = (exact * norms[part][:, None]).T, min(FIRST, len(part) - 1)
            step = max(1, CELLS // len(part))
            for at in range(0, len(part), step):
                score = exact[at : at + step] @ scaled
                score[np.arange(len(score)), at + np.arange(len(score))] = -np.inf
                # So many groups of columns have a score of at least the least that is kept: only these need be ordered.
                groups = np.maximum.reduceat(score, np.arange(0, len(part), max(1, len(part) // (4 * FIRST))), axis=1)
                least = -np.partition(-groups, best - 1, axis=1)[:, best - 1] if best and groups.shape[1] > best else np.full(len(score), -np.inf)
                row, column = np.divmod(np.flatnonzero(score >= least[:, None]), len(part))
                near.append(nodes[part[column]])
                sims.append(score[row, column])
                lengths.append(np.bincount(row, minlength=len(score)))
        order, starts = np.concatenate(parts), np.append(0, np.cumsum(np.concatenate(lengths)))
        held = np.zeros((0, dims), np.float32) if tree else vecs[order]
        return pa.table({
            "slot": slot_of(nodes[order], slots), "node": nodes[order], "vec": _binary(held, np.zeros(len(order) + 1, np.int64) if tree else np.arange(len(order) + 1)),
            "norm": norms[order], "near": _binary(np.concatenate(near), starts), "sims": _binary(np.concatenate(sims), starts)})
    return work


def _pack_slot(dims: int, most: int):
    def work(table: pa.Table) -> pa.Table:
        (near, length), (sims, _), (vecs, held) = (_flat(table, c, k) for c, k in (("near", "i8"), ("sims", "f8"), ("vec", "f4")))
        holding = np.flatnonzero(held)
        nodes, norms = table.column("node").to_numpy(), table.column("norm").to_numpy()
        order = holding[np.argsort(nodes[holding])]
        ids, vecs = nodes[order], vecs.reshape(-1, dims)[np.searchsorted(holding, order)]
        of = np.repeat(np.searchsorted(ids, nodes), length)
        return _packed(table.column("slot")[0].as_py(), ids, vecs, norms[order], of, near, sims, np.ones(len(of), bool), most)
    return work


class _Kept:
    """A table of slots, bucketed by slot, so that what meets it is shuffled alone."""

    def __init__(self, rows: DataFrame, label: str):
        self.spark = rows.sparkSession
        self.path, self.name = scratch_path(self.spark, label), f"pricebeam_{label}_{uuid.uuid4().hex}"
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows.write.bucketBy(parts, "slot").option("path", self.path).format("parquet").saveAsTable(self.name)
        self.table = self.spark.table(self.name)

    def total(self, column: str) -> int:
        return sum(x[0] for x in self.table.select(column).collect())

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.name}")
        discard(self.spark, self.path)


class NeighbourGraph:
    """The graph over (node, vector): vectors are arrays of doubles, finite and not zero, node numbers are
    distinct. `drop` removes it."""

    def __init__(self, nodes: DataFrame, neighbours: int = NEIGHBOURS):
        self.spark, self.most = nodes.sparkSession, neighbours
        size = nodes.agg(F.count("*"), F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs)))).first()
        self.count, self.dims = size[0], size[1] or 1
        #: Slots follow the nodes alone, never the session's partitions: each pair of slots may exchange a row.
        slots = max(1, self.count // min(SLOT_NODES, max(SLOT_NODES // 8, SLOT_NUMBERS // self.dims)))
        self.wide = max(min(slots, WIDE_FROM), self.count // min(WIDE_NODES, max(SLOT_NODES, WIDE_NUMBERS // self.dims)))
        self.slots = -(-slots // self.wide) * self.wide
        #: Scales are relative to the largest, so that scores do not overflow.
        largest = int(np.frexp(size[2] or 1.0)[1]) - 1
        leaved = nodes.select("node", "vector").mapInArrow(
            _in_leaves(self.dims, largest, self._trees(nodes), -(-self.count // LEAF) or 1), "leaf long, node long, vec binary, norm double")
        listed = leaved.groupBy("leaf").applyInArrow(
            _first_lists(self.dims, self.slots), "slot int, node long, vec binary, norm double, near binary, sims binary")
        self.state = _Kept(listed.groupBy("slot").applyInArrow(_pack_slot(self.dims, self.most), STATE), "graph")
        self.rounds = 0
        while self.rounds < ROUNDS and self.count > 1:
            self.rounds += 1
            if self._round() <= SETTLED * self.count * min(self.most, self.count - 1):
                break

    def _trees(self, nodes: DataFrame) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """Trees over a sample of the nodes. Only where lists begin depends on them."""
        leaf = min(LEAF, max(LEAST_LEAF, self.count // 16))
        depth = (min(LEAVES, max(1, -(-self.count // leaf))) - 1).bit_length()
        if not depth:
            return [[]]
        share = min(1.0, (LEAF_SAMPLED << depth) / self.count)
        sample = [x.vector for x in nodes.select("vector").sample(share, seed=11).collect()]
        if not sample:
            return [[]]
        directions = _directions(_scaled(pa.array(sample, pa.list_(pa.float64())), self.dims)[0])
        return [_tree(directions, depth, seed) for seed in range(TREES)]

    def _round(self) -> int:
        """Every node's neighbours of neighbours are offered to each other; the number of changes."""
        slots = self.state.table.drop("changed")
        edges = slots.select("slot", "ids", "near", "fresh").mapInArrow(_point(self.dims, self.most, self.slots), EDGES)
        sent = slots.drop("fresh").groupBy("slot").cogroup(edges.groupBy("to")).applyInArrow(_send(self.dims, self.most, self.slots), SENT)
        offers = slots.groupBy("slot").cogroup(sent.groupBy("to")).applyInArrow(_join(self.dims, self.most, self.slots), SCORES)
        after = _Kept(slots.drop("fresh").groupBy("slot").cogroup(offers.groupBy("to")).applyInArrow(_merge(self.dims, self.most), STATE), "graph")
        self.state.drop()
        self.state = after
        return after.total("changed")

    def search(self, queries: DataFrame, count: int = 20, pool: int = POOL) -> DataFrame:
        """(query, node): the best nodes that a greedy walk from each query node finds, itself among them.
        `queries` has a column node. How wide a walk must be depends on the vectors, so a sample of the queries
        is compared with all nodes, and walks with twice the pool as long as it misses too many of its `count`
        nearest. All walk with the pool that is found so."""
        queries = materialize(queries.select("node").distinct(), "wanted")
        truth, asked = self._truth(queries, count), queries.count()
        sample = queries.filter(F.col("node").isin(list({x.query for x in truth})))
        self.pool, kept = max(pool, 4 * count), max(EXACT, 2 * count)
        lists, packed = self.state, None
        if self.wide < self.slots:
            lists = packed = _Kept(self.state.table.select(*WIDE.replace(",", "").split()[::2]).withColumn("slot", F.col("slot") % self.wide)
                                   .groupBy("slot").applyInArrow(_widened(self.dims, self.most), WIDE), "wide")
        found = None if asked >= ALONE else self._walk(lists, queries, asked, self.pool, kept)
        while True:
            self.recall = self._share(truth, found if found is not None else self._walk(lists, sample, SAMPLED, self.pool, kept), count)
            if self.recall >= RECALL or self.pool >= self.count:
                break
            self.pool, found = 2 * self.pool, None
        if found is None:
            found = self._walk(lists, queries, asked, self.pool, kept)
        if packed:
            packed.drop()
        return found.select("query", "node")

    def _walk(self, lists: _Kept, queries: DataFrame, asked: int, pool: int, kept: int) -> DataFrame:
        """(query, node, score): a walk opens its best unopened nodes, meets their neighbours, keeps the best
        `pool` by inner product, and ends when all of these are opened; the best `kept` of each. The queries of a
        slot are cut into homes of some hundreds."""
        opened = OPENED * min(4, -(-pool // POOL))
        homes = max(1, -(-asked // (self.wide * HOME)))
        wanted = queries.mapInArrow(_slotted(self.wide), "node long, slot int")
        vectors, near = lists.table.select("slot", "ids", "vecs", "norms"), lists.table.select("slot", "ids", "near")
        pools = _Kept(vectors.groupBy("slot").cogroup(wanted.groupBy("slot"))
                      .applyInArrow(_begin(self.dims, self.most, pool, homes, self._longest()), POOLS), "pools")
        while pools.total("left") > 0:
            here = pools.table.drop("left")
            opening = here.select("slot", "ids", "near", "open").mapInArrow(_open(self.dims, pool, opened, self.wide), OPENING)
            listed = near.groupBy("slot").cogroup(opening.groupBy("to")).applyInArrow(_listed(self.dims, self.most), LISTS)
            met = here.groupBy("slot").cogroup(listed.groupBy("to")).applyInArrow(_wanted(self.dims, self.most, pool, opened, self.wide), WANTED)
            scored = vectors.groupBy("slot").cogroup(met.groupBy("to")).applyInArrow(_score(self.dims, self.most), SCORES)
            after = _Kept(here.groupBy("slot").cogroup(scored.groupBy("to")).applyInArrow(_keep(self.dims, pool, opened), POOLS), "pools")
            pools.drop()
            pools = after
        found = materialize(pools.table.mapInArrow(_unpack(pool, kept), "query long, node long, score double"), "found")
        pools.drop()
        return found

    def _truth(self, queries: DataFrame, count: int) -> list[Row]:
        """(query, node, score) of the `count` nearest of a sample of the queries among all nodes, by one pass."""
        sample = [x.node for x in queries.orderBy(F.xxhash64("node"), "node").limit(SAMPLED).collect()]
        wanted = self.state.table.select("slot", "ids", "vecs").mapInArrow(_vectors(self.dims, self.most, sample), "node long, vec binary")
        asked = {x.node: bytes(x.vec) for x in wanted.collect()}
        best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
        scored = self.state.table.select("slot", "ids", "vecs", "norms").mapInArrow(_compared(self.dims, self.most, asked, count), "query long, node long, score double")
        return scored.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= count).collect()

    def _share(self, truth: list[Row], found: DataFrame, count: int) -> float:
        """The share of the true nearest that are found, or that are no nearer than the last one found."""
        lists: dict[int, dict[int, float]] = {x.query: {} for x in truth}
        for x in found.filter(F.col("query").isin(list(lists))).collect():
            lists[x.query][x.node] = x.score
        last = {q: sorted(x.values(), reverse=True)[count - 1] if len(x) >= count else -np.inf for q, x in lists.items()}
        missed = sum(x.node not in lists[x.query] and x.score - last[x.query] > 1e-12 * abs(x.score) for x in truth)
        return 1 - missed / max(1, len(truth))

    def _longest(self) -> list[tuple[int, bytes, float]]:
        """A few nodes of the largest norm, if norms differ: with unequal lengths the largest inner
        products are often not near in direction."""
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    s = _Slot(pa.Table.from_batches([batch.slice(i, 1)]), self_dims, self_most)
                    lengths = np.sqrt(np.einsum("ij,ij->i", s.vecs, s.vecs, dtype=np.float64)) * s.norms
                    top = np.argsort(-lengths, kind="stable")[:LONGEST]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s.ids[top]), pa.array([x.tobytes() for x in s.vecs[top]], pa.binary()),
                         pa.array(s.norms[top]), pa.array(lengths[top]), pa.array(np.full(len(top), lengths.min()))],
                        names=["node", "vec", "norm", "length", "least"])

        self_dims, self_most = self.dims, self.most
        rows = self.state.table.select("slot", "ids", "vecs", "norms").mapInArrow(work, "node long, vec binary, norm double, length double, least double")
        top = rows.orderBy(F.desc("length"), "node").limit(LONGEST).collect()
        least = rows.agg(F.min("least")).first()[0]
        if not top or top[0].length <= 1.05 * least:
            return []
        return [(x.node, bytes(x.vec), x.norm) for x in top]

    def drop(self) -> None:
        self.state.drop()


def _vectors(dims: int, most: int, wanted: list[int]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = _Slot(pa.Table.from_batches([batch.slice(i, 1)]), dims, most)
                at = np.flatnonzero(np.isin(s.ids, wanted))
                yield pa.RecordBatch.from_arrays([pa.array(s.ids[at]), pa.array([x.tobytes() for x in s.vecs[at]], pa.binary())],
                                                 names=["node", "vec"])
    return work


def _compared(dims: int, most: int, asked: dict[int, bytes], count: int):
    """(query, node, score): the `count` best of each slot for each of a few queries."""
    queries = np.array(list(asked), np.int64)
    vecs = np.frombuffer(b"".join(asked.values()), np.float32).reshape(-1, dims).astype(np.float64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                s = _Slot(pa.Table.from_batches([batch.slice(i, 1)]), dims, most)
                score = vecs @ s.vecs.astype(np.float64).T * s.norms
                top = np.argsort(-score, axis=1, kind="stable")[:, :count]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(queries, top.shape[1])), pa.array(s.ids[top].ravel()),
                     pa.array(np.take_along_axis(score, top, axis=1).ravel())], names=["query", "node", "score"])
    return work


def _slotted(slots: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = slot_of(batch.column("node").to_numpy(), slots)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(slot)], names=["node", "slot"])
    return work


def _widened(dims: int, most: int):
    """The slots of a wide slot as one."""
    def work(table: pa.Table) -> pa.Table:
        ids, vecs, norms, near = (_flat(table, c, k)[0] for c, k in (("ids", "i8"), ("vecs", "f4"), ("norms", "f8"), ("near", "i8")))
        order = np.argsort(ids)
        return pa.table({"slot": [table.column("slot")[0].as_py()], "ids": [ids[order].tobytes()], "vecs": [vecs.reshape(-1, dims)[order].tobytes()],
                         "norms": [norms[order].tobytes()], "near": [near.reshape(-1, most)[order].tobytes()]}, _none(WIDE).schema)
    return work


def _pool_table(slot: int, ids: np.ndarray, vecs: np.ndarray, of: np.ndarray, other: np.ndarray, score: np.ndarray,
                opened: np.ndarray, pool: int) -> pa.Table:
    kept = best_of(of, other, score, ~opened, pool)
    of, other, score, opened = of[kept], other[kept], score[kept], opened[kept]
    rank = _ranks(of)
    near, sims = np.full((len(ids), pool), -1, np.int64), np.full((len(ids), pool), -np.inf)
    open_ = np.zeros((len(ids), pool), bool)
    near[of, rank], sims[of, rank], open_[of, rank] = other, score, ~opened
    return pa.table({"slot": [slot], "ids": [ids.tobytes()], "vecs": [np.ascontiguousarray(vecs).tobytes()],
                     "near": [near.tobytes()], "sims": [sims.tobytes()], "open": [open_.tobytes()],
                     "left": [int(open_.sum())]}, _none(POOLS).schema)


def _begin(dims: int, most: int, pool: int, homes: int, longest: list[tuple[int, bytes, float]]):
    """A walk begins at its query's own node, and at the longest vectors."""
    def work(state: pa.Table, queries: pa.Table) -> pa.Table:
        if not state.num_rows or not queries.num_rows:
            return _none(POOLS)
        s, out = _Slot(state, dims, most), []
        wanted = np.unique(queries.column("node").to_numpy())
        for home, ids in enumerate(np.array_split(wanted, homes)):
            if not len(ids):
                continue
            at = s.place(ids)
            exact = s.vecs[at].astype(np.float64)
            of, other = [np.arange(len(ids))], [ids]
            score = [np.square(exact).sum(axis=1) * s.norms[at]]
            for node, vec, norm in longest:
                of.append(np.arange(len(ids)))
                other.append(np.full(len(ids), node))
                score.append(exact @ np.frombuffer(vec, np.float32).astype(np.float64) * norm)
            of, other, score = np.concatenate(of), np.concatenate(other), np.concatenate(score)
            out.append(_pool_table(s.slot * homes + home, ids, s.vecs[at], of, other, score, np.zeros(len(of), bool), pool))
        return pa.concat_tables(out)
    return work


class _Pool:
    def __init__(self, table: pa.Table, dims: int, pool: int):
        self.slot = table.column("slot")[0].as_py()
        shapes = {"ids": ("i8", -1), "vecs": ("f4", (-1, dims)), "near": ("i8", (-1, pool)), "sims": ("f8", (-1, pool)), "open": ("?", (-1, pool))}
        for name in table.column_names:
            if name in shapes:
                setattr(self, name, _array(table, name, shapes[name][0]).reshape(shapes[name][1]))

    def opening(self, opened: int) -> np.ndarray:
        """Which entries are opened next: the best of those not opened."""
        return self.open & (np.cumsum(self.open, axis=1) <= opened)


def _open(dims: int, pool: int, opened: int, slots: int):
    """Homes ask the slots of the nodes that their walks open."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                p = _Pool(pa.Table.from_batches([batch.slice(i, 1)]), dims, pool)
                node = np.unique(p.near[p.opening(opened)])
                order, to, starts = _dealt(slot_of(node, slots))
                yield from _rows(OPENING, to, p.slot, (node[order], starts)).to_batches()
    return work


def _listed(dims: int, most: int):
    """The neighbours of the nodes that a home asks for."""
    def work(state: pa.Table, opening: pa.Table) -> pa.Table:
        if not state.num_rows or not opening.num_rows:
            return _none(LISTS)
        s = _Slot(state, dims, most)
        node, length = _flat(opening, "node", "i8")
        starts = np.append(0, np.cumsum(length))
        return _rows(LISTS, opening.column("kind").to_numpy(), s.slot, (node, starts), (s.near[s.place(node)], starts))
    return work


def _wanted(dims: int, most: int, pool: int, opened: int, slots: int):
    """Which nodes a home's walks meet, without those in their pools, goes to the nodes' slots, with the vector of each
    query and the score to beat once a slot."""
    def work(table: pa.Table, listed: pa.Table) -> pa.Table:
        if not table.num_rows or not listed.num_rows:
            return _none(WANTED)
        p = _Pool(table, dims, pool)
        node, near = _flat(listed, "node", "i8")[0], _flat(listed, "near", "i8")[0].reshape(-1, most)
        by = np.argsort(node)
        query, column = np.nonzero(p.opening(opened))
        near = near[by[np.searchsorted(node[by], p.near[query, column])]]
        row, column = np.nonzero(near >= 0)
        held, place = np.nonzero(p.near >= 0)
        of, other = np.concatenate([held, query[row]]), np.concatenate([p.near[held, place], near[row, column]])
        pairs = _pairs(of, other)
        order = _ordered(pairs * 2 + (np.arange(len(of)) >= len(held)))  # what a pool holds comes before what is met
        pairs = pairs[order]
        first = np.append(True, pairs[1:] != pairs[:-1])
        order = order[first & (order >= len(held))]
        of, other = of[order], other[order]
        order, to, starts = _dealt(slot_of(other, slots))
        of, other = of[order], other[order]
        begins = np.zeros(len(of), bool)
        begins[starts[:-1]] = True
        begins[1:] |= of[1:] != of[:-1]
        sent, number = of[begins], np.cumsum(begins) - 1
        queries = np.append(number[starts[:-1]], len(sent)) if len(of) else starts
        at = number - np.repeat(queries[:-1], np.diff(starts))
        return _rows(WANTED, to, p.slot, (at.astype(np.int32), starts), (other, starts), (sent.astype(np.int32), queries),
                     (p.vecs[sent], queries), (p.sims[sent, -1], queries))
    return work


def _score(dims: int, most: int):
    """Queries get the scores of the nodes met here that beat their worst."""
    def work(state: pa.Table, rows: pa.Table) -> pa.Table:
        if not state.num_rows or not rows.num_rows:
            return _none(SCORES)
        s = _Slot(state, dims, most)
        (at, length), (node, _), (query, queries) = (_flat(rows, c, k) for c, k in (("at", "i4"), ("other", "i8"), ("query", "i4")))
        vecs, least = _flat(rows, "vecs", "f4")[0].reshape(-1, dims), _flat(rows, "least", "f8")[0]
        of, other = at + np.repeat(np.cumsum(queries) - queries, length), s.place(node)
        score = np.empty(len(of))
        step = max(1, SMALL // dims)
        for i in range(0, len(of), step):
            score[i : i + step] = np.einsum("ij,ij->i", vecs[of[i : i + step]].astype(np.float64), s.vecs[other[i : i + step]].astype(np.float64))
        score *= s.norms[other]
        better = score > least[of]
        starts = np.append(0, np.cumsum(better))[np.append(0, np.cumsum(length))]
        return _rows(SCORES, rows.column("kind").to_numpy(), s.slot, (query[of[better]], starts), (node[better], starts), (score[better], starts))
    return work


def _keep(dims: int, pool: int, opened: int):
    """The pools after a round."""
    def work(table: pa.Table, scored: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _none(POOLS)
        p = _Pool(table, dims, pool)
        of, column = np.nonzero(p.near >= 0)
        done = ~(p.open & ~p.opening(opened))[of, column]
        (query, _), (other, _), (score, _) = (_flat(scored, c, k) for c, k in (("node", "i4"), ("other", "i8"), ("score", "f8")))
        return _pool_table(p.slot, p.ids, p.vecs, np.concatenate([of, query]), np.concatenate([p.near[of, column], other]),
                           np.concatenate([p.sims[of, column], score]), np.append(done, np.zeros(len(query), bool)), pool)
    return work


def _unpack(pool: int, kept: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, near, sims in zip(*(batch.column(c).to_pylist() for c in ("ids", "near", "sims"))):
                near = np.frombuffer(near, np.int64).reshape(-1, pool)[:, :kept]
                of, column = np.nonzero(near >= 0)
                score = np.frombuffer(sims, np.float64).reshape(-1, pool)[of, column]
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids, np.int64)[of]), pa.array(near[of, column]), pa.array(score)],
                                                 names=["query", "node", "score"])
    return work


def nearest(vectors: DataFrame, queries: DataFrame, count: int = 20, key: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `queries` the `count` rows of `vectors` found with
    the largest inner product in doubles, nearest first, ties to the smaller key, null keys last.

    `queries` are rows of `vectors` (same columns), and a query's own row is no candidate. Null and zero
    vectors and those that hold a null or a non-finite number take no part, as queries neither; a shorter
    vector counts as padded with zeros. Equal vectors are one node of the graph, of which only the first
    `count` + 1 keys can matter. Repeated keys are separate rows; one of them is the query's own. The
    graph and the walk compare vectors of 32-bit numbers in doubles; the order of what is found and the scores
    are exact. Empty tables and single rows give no rows.
    """
    spark: SparkSession = vectors.sparkSession
    rows, asking = _usable(vectors, key, vector), _usable(queries, key, vector)
    # A hash stands before the vector, so that sorting seldom compares vectors.
    order = Window.partitionBy("hash", "vector").orderBy(F.col("id").asc_nulls_last())
    few = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= count + 1)
    nodes = materialize(few.groupBy("hash", "vector").agg(F.sort_array(F.collect_list(F.struct("place", "id"))).alias("members"))
                        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    asking = materialize(asking.join(nodes.select("hash", "vector", "node"), ["hash", "vector"]).select("id", "node"), "queries")
    if asking.isEmpty():
        return spark.createDataFrame([], f"query_id {dict(vectors.dtypes)[key]}, rank int, vec_id {dict(vectors.dtypes)[key]}, score double")
    graph = NeighbourGraph(nodes.select("node", "vector"))
    found = graph.search(asking.select("node"), count + 1)
    graph.drop()
    mine = nodes.select(F.col("node").alias("query"), F.col("vector").alias("mine"))
    product = F.aggregate(F.zip_with("mine", "vector", lambda x, y: F.coalesce(x * y, F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
    scored = (found.join(nodes, "node").join(mine, "query")
              .select("query", product.alias("score"), F.explode("members.id").alias("member")))
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("member").asc_nulls_last())
    lists = (scored.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= count + 1)
             .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "member", "score"))).alias("best")))
    own = F.array_position(F.transform("best.member", lambda x: F.coalesce(x.cast("string"), F.lit("null"))),
                           F.coalesce(F.col("id").cast("string"), F.lit("null")))
    others = F.when(own > 0, F.filter("best", lambda x, i: i != own - 1)).otherwise(F.col("best"))
    return (asking.join(lists, asking["node"] == lists["query"])
            .select("id", F.posexplode(F.slice(others, 1, count)).alias("at", "found"))
            .select(F.col("id").alias("query_id"), (F.col("at") + 1).cast("int").alias("rank"),
                    F.col("found.member").alias("vec_id"), F.col("found.score").alias("score")))


def _usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) of the vectors that take part."""
    wide = rows.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (wide.filter(F.col("vector").isNotNull() & ~odd & F.exists("vector", lambda x: x != 0.0))
            .select("id", "vector", F.xxhash64("vector").alias("hash")))
