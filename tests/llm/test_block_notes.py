"""Runs of windows are found once, when a block is written, and read from its note afterwards."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricebeam.llm import blocks, suffixes


@pytest.mark.parametrize("window", [32, 200, 70_000])
def test_runs_are_read_and_not_found_again(window, monkeypatch):
    rng = np.random.default_rng(window)
    texts = ["".join(map(chr, rng.integers(97, 123, n))) for n in (0, 31, 500, 3000, 150_000)] + [None, "é" * 400]
    table = pa.table({"text": pa.array(texts, pa.string())})
    found = suffixes._Runs(table, window)
    assert len(found.first)
    noted = table.append_column(blocks.NOTE, pa.array([found.note(window)] + [None] * 6, pa.binary()))

    def never(*_):
        raise AssertionError("runs are found again")

    monkeypatch.setattr(suffixes, "sliding_minimum", never)
    read = suffixes._Runs(noted, window)
    for name in ("first", "last", "at", "gram", "segment"):
        assert np.array_equal(getattr(read, name), getattr(found, name)), name


def test_each_block_has_its_note_beside_its_first_row(spark):
    docs = spark.range(200).selectExpr("id", "IF(id % 7 = 0, NULL, repeat('x', CAST(id % 90 * 2000 AS INT))) AS text")

    def work(batches):
        for batch in blocks._with_notes(lambda block: str(block.num_rows).encode())(batches):
            assert batch.num_rows and batch.column("note").null_count == batch.num_rows - 1
            yield batch

    schema = "block long, row long, text string, payload struct<id: long>, note binary"
    rows = blocks.packed(docs.repartition(3)).mapInArrow(work, schema).localCheckpoint()
    assert rows.select("payload.id").distinct().count() == rows.count() == 200
    sizes = rows.groupBy("block").agg(F.count("*").alias("n"), F.max("note").cast("string").alias("noted"),
                                      F.count_if((F.col("row") == 0) == F.col("note").isNotNull()).alias("right"))
    assert sizes.filter("n != noted or right != n").count() == 0 and sizes.count() > 3
