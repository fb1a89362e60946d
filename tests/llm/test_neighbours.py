"""Nearest neighbours by NN-descent against all inner products."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from pricebeam.llm import descent
from pricebeam.llm.descent import RECALL, NeighbourGraph, best_of, nearest

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, ids, count):
    """(query, rank) -> (id, score) over usable rows, each query's own row left out."""
    usable = [(i, np.array(v, float)) for i, v in rows
              if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    found = {}
    for at, (i, v) in enumerate(usable):
        if i in ids:
            others = sorted((-float(v @ w), j is None, j or 0) for k, (j, w) in enumerate(usable) if k != at)
            found.setdefault(i, []).append([(None if none else j, -s) for s, none, j in others[:count]])
    return found


def listed(frame):
    lists = {}
    for x in frame.collect():
        lists.setdefault(x.query_id, {})[x.rank] = (x.vec_id, x.score)
    return {q: [x[r] for r in sorted(x)] for q, x in lists.items()}


def recall(got, expected, count):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in lists[0]}) for q, lists in expected.items())
    return hits / sum(len(lists[0]) for lists in expected.values())


@pytest.mark.parametrize("stretch", [False, True])
def test_recall_and_exact_scores(spark, stretch):
    """Few clusters in many dimensions; with `stretch` norms differ by up to three times."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 32)) + 2 * rng.standard_normal((10, 32))[rng.integers(0, 10, 3000)]
    if stretch:
        x *= rng.uniform(0.5, 1.5, (3000, 1))
    x = x.astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = listed(nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20))
    expected = brute(rows, set(range(0, 3000, 20)), 20)
    assert set(got) == set(expected)
    assert recall(got, expected, 20) >= 0.9
    for q, found in got.items():
        assert len(found) == 20 and len({i for i, _ in found}) == 20 and q not in {i for i, _ in found}
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        for i, score in found:
            assert score == pytest.approx(float(x[q].astype(float) @ x[i].astype(float)), rel=1e-12)


def test_groups_tighter_than_a_byte_are_told_apart(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((10, 32))[rng.integers(0, 10, 3000)] + 0.002 * rng.standard_normal((3000, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = listed(nearest(vectors, vectors.filter("vec_id % 100 = 0"), 20))
    assert recall(got, brute(rows, set(range(0, 3000, 100)), 20), 20) >= 0.95


def test_the_pool_widens_until_a_sample_is_found(spark):
    """Vectors without groups in many dimensions, where a narrow walk misses most."""
    x = np.random.default_rng(10).standard_normal((2500, 96))
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, vector array<double>")
    graph = NeighbourGraph(nodes, neighbours=8)
    found = graph.search(nodes.filter("node % 25 = 0"), 6, pool=24).collect()
    graph.drop()
    assert graph.pool > 24 and graph.recall >= RECALL
    top = np.argsort(-(x[::25] @ x.T), axis=1)[:, :6]
    hits = {(r.query, r.node) for r in found}
    assert sum((25 * i, int(n)) in hits for i, near in enumerate(top) for n in near) >= RECALL * 600


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(60)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = listed(nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20))
    expected = brute(rows, {0, 20, 40}, 20)
    for q in (0, 20, 40):
        assert [i for i, _ in got[q]] == [i for i, _ in expected[q][0]]


def test_hot_copies_ties_and_odd_vectors(spark):
    """A third of all rows are one vector; ties go to the smaller id, and copies of a query are candidates."""
    rng = np.random.default_rng(6)
    common = rng.standard_normal(8).astype(np.float32).tolist()
    rows = [(i, common) for i in range(100)] + [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(100, 300)]
    rows += [(400, None), (420, []), (440, [0.0] * 8), (460, [None] + [1.0] * 7), (480, [float("nan")] * 8),
             (500, [float("inf")] + [1.0] * 7), (520, [1.0, 2.0]), (None, [3.0] * 8), (540, common)]
    vectors = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit(1)).withColumn("slot", F.lit("x"))
    got = listed(nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20))
    padded = [(i, None if not v or None in v else [*v, *[0.0] * (8 - len(v))]) for i, v in rows]
    expected = brute(padded, set(range(0, 541, 20)), 20)
    assert set(got) == set(expected) and not set(got) & {400, 420, 440, 460, 480, 500}
    for q in (0, 20, 40, 60, 80, 540):
        assert [i for i, _ in got[q]] == [i for i in range(21) if i != q][:20]
    assert recall(got, expected, 20) >= 0.95


def test_repeated_ids_few_rows_and_nothing(spark):
    vectors = spark.createDataFrame([(20, [1.0, 0.0]), (20, [1.0, 0.0]), (7, [0.5, 1.0])], SCHEMA)
    got = sorted(tuple(x) for x in nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20).collect())
    assert got == [(20, 1, 20, 1.0)] * 2 + [(20, 2, 7, 0.5)] * 2
    one = vectors.limit(1)
    assert nearest(one, one, 20).collect() == []
    none = vectors.filter("false")
    assert nearest(none, none, 20).collect() == []
    assert nearest(vectors, none, 20).dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]


def test_best_of_keeps_the_first_of_equals():
    of, other = np.array([1, 0, 0, 0, 1]), np.array([5, 7, 7, 8, 6])
    kept = best_of(of, other, np.array([1.0, 2.0, 2.0, 3.0, 1.0]), np.array([0, 1, 0, 0, 0]), 2)
    assert kept.tolist() == [3, 2, 0, 4]


def test_first_lists_of_leaves_settle_in_few_rounds(spark, monkeypatch):
    """Vectors without groups. Small slots and leaves, so that most neighbours are in other ones; slots are joined for the walk."""
    monkeypatch.setattr(descent, "SLOT_NODES", 128)
    monkeypatch.setattr(descent, "WIDE_FROM", 4, raising=False)
    monkeypatch.setattr(descent, "WIDE_NODES", 512, raising=False)
    monkeypatch.setattr(descent, "ALONE", 100, raising=False)
    x = np.random.default_rng(11).standard_normal((4000, 48)).astype(np.float32)
    nodes = spark.createDataFrame([(7 * i, v.tolist()) for i, v in enumerate(x)], "node long, vector array<double>")
    graph = NeighbourGraph(nodes)
    found = graph.search(nodes.filter("node % 140 = 0"), 10).collect()
    graph.drop()
    assert graph.slots > 4 * graph.wide > 4
    top = np.argsort(-(x[::20].astype(float) @ x.T.astype(float)), axis=1)[:, :10]
    hits = {(r.query // 7, r.node // 7) for r in found}
    assert sum((20 * i, int(n)) in hits for i, near in enumerate(top) for n in near) >= RECALL * 2000
    assert graph.rounds <= 4


def test_a_walk_sends_each_slot_one_row_with_each_vector_once():
    """What a home's queries meet: each pair once, none that a pool holds, the vector once a slot."""
    rng, slots, most, dims, pool = np.random.default_rng(12), 16, 6, 8, 10
    x = rng.standard_normal((500, dims)).astype(np.float32)
    near = np.array([rng.choice(500, most, replace=False) for _ in range(500)])
    queries = np.arange(0, 500, 20)
    of, other = np.repeat(np.arange(25), 4), np.concatenate([rng.choice(500, 4, replace=False) for _ in queries])
    home = descent._pool_table(3, queries, x[queries], of, other, np.einsum("ij,ij->i", x[queries[of]], x[other]), np.zeros(100, bool), pool)
    asked = pa.Table.from_batches(list(descent._open(dims, pool, 2, slots)(home.to_batches())))
    assert asked.num_rows <= slots
    opened = [row.tolist() for row in descent._Pool(home, dims, pool).near[:, :2]]
    assert set(descent._flat(asked, "node", "i8")[0].tolist()) == {n for row in opened for n in row}

    def state(slot):
        ids = np.flatnonzero(descent.slot_of(np.arange(500), slots) == slot)
        return pa.table({"slot": [slot], "ids": [ids.tobytes()], "vecs": [x[ids].tobytes()], "norms": [np.ones(len(ids)).tobytes()], "near": [near[ids].tobytes()]})

    def of_slot(table, slot):
        return table.filter(pa.compute.equal(table.column("to"), slot))

    listed = pa.concat_tables([descent._listed(dims, most)(state(i), of_slot(asked, i)) for i in range(slots)])
    met = descent._wanted(dims, most, pool, 2, slots)(home, listed)
    assert sorted(met.column("to").to_pylist()) == sorted(set(met.column("to").to_pylist()))
    scored = pa.concat_tables([descent._score(dims, most)(state(i), of_slot(met, i)) for i in range(slots)])
    query, node, score = (descent._flat(scored, c, k)[0] for c, k in (("node", "i4"), ("other", "i8"), ("score", "f8")))
    held = {(q, n) for q, n in zip(of.tolist(), other.tolist())}
    expected = {(q, int(n)) for q, row in enumerate(opened) for n in near[row].ravel()} - held
    assert len(query) == len(expected) and {*zip(query.tolist(), node.tolist())} == expected
    assert np.allclose(score, np.einsum("ij,ij->i", x[queries[query]].astype(float), x[node].astype(float)))
    assert len(descent._flat(met, "query", "i4")[0]) <= len({(q, s) for (q, n), s in zip(expected, descent.slot_of(np.array([n for _, n in expected]), slots).tolist())})
