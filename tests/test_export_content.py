"""An export whose files hold other values than were sent fails, whatever their number."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricebeam.sources import export
from pricebeam.sources.export import SinkVerificationError, content_sum, export_csv

DAY = dt.date(2024, 1, 31)
SCHEMA = "value double, date date, index string, daily_return double, monthly_return double"
ROWS = [(1.5, DAY, "a", None, 2.0), (float("nan"), None, None, float("inf"), -0.0), (1e-300, DAY, " b, \"c\" ", 0.1 + 0.2, None),
        (None, None, "", None, None)]


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(ROWS * 3, SCHEMA)


def total(df):
    return df.agg(content_sum(df.schema).alias("n")).first()["n"]


def test_awkward_values_pass(frame, scratch):
    assert export_csv(frame.repartition(5), scratch("out"), DAY).rows == 12


@pytest.mark.parametrize("change", [
    lambda df: df.withColumn("value", F.when(F.col("value") == "1.5", "1.6").otherwise(F.col("value"))),
    lambda df: df.withColumn("index", F.when(F.col("index") == "a", "A").otherwise(F.col("index"))),
    # A value in the column next to its own.
    lambda df: df.withColumns({"daily_return": F.col("monthly_return"), "monthly_return": F.col("daily_return")}),
])
def test_a_changed_value_fails(frame, scratch, monkeypatch, change):
    read = export.read_csv_text
    monkeypatch.setattr(export, "read_csv_text", lambda *a: change(read(*a)))
    with pytest.raises(SinkVerificationError, match="other values"):
        export_csv(frame, scratch("out"), DAY)


def test_the_sum_knows_copies_and_places_but_no_order(spark, frame):
    assert total(frame) == total(frame.orderBy(F.rand(1)).repartition(7))
    once = spark.createDataFrame(ROWS, SCHEMA)
    assert total(once) != total(once.union(once.limit(1)))
    left, right = (spark.createDataFrame([(a, None, "x", b, None)], SCHEMA) for a, b in ((1.0, None), (None, 1.0)))
    assert total(left) != total(right)
    assert total(once.limit(0)) == 0
