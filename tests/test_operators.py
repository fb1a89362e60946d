import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window, functions as F

from pricebeam.functions import with_frame_volatility, with_returns
from pricebeam.operators import comparison, rollups
from pricebeam.operators.changes import row_changes, snapshot_changes
from pricebeam.operators.dedupe import dedupe_latest
from pricebeam.operators.series import date_range, tag_series, union_series
from pricebeam.operators.sliced import over_series
from pricebeam.operators.upsert import DuplicateKeyError, duplicate_keys, require_unique, upsert, upsert_computed

D = dt.date


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- dedupe ---

def test_newest_load_wins(spark):
    df = spark.createDataFrame(
        [("a", 1, 10.0), ("a", 2, 20.0), ("a", 2, 15.0), ("b", 1, None)], "k string, load int, v double")
    assert rows_of(dedupe_latest(df, ["k"], ["load"])) == [("a", 2, 20.0), ("b", 1, None)]


def test_unique_order_gives_the_same(spark):
    rng = random.Random(1)
    data = [(rng.randrange(20), i, rng.choice([None, float(i)])) for i in range(500)]
    df = spark.createDataFrame(data, "k int, load int, v double")
    assert rows_of(dedupe_latest(df, ["k"], ["load"])) == rows_of(
        dedupe_latest(df, ["k"], ["load"], unique_order=True))


def test_dedupe_reduces_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS load", "id AS v")
    for unique in (True, False):
        plan = dedupe_latest(df, ["k"], ["load"], unique)._jdf.queryExecution().executedPlan().toString()
        before_shuffle = plan.split("Exchange")[-1]
        assert "partial_max" in before_shuffle


# --- sliced windows ---

def tick_data(spark, seed):
    rng = random.Random(seed)
    data = []
    for i in range(900):
        series = None if i % 9 == 0 else ("hot" if i % 3 else f"s{rng.randrange(40)}")
        price = rng.choice([None, 0.0, -5.0]) if rng.random() < 0.1 else rng.uniform(50, 150)
        data.append((series, D(2024, 1, 1) + dt.timedelta(days=rng.randrange(20)), i, price))
    return spark.createDataFrame(data, "s string, day date, i int, v double")


@pytest.mark.parametrize("max_rows, lookback", [(5, 29), (40, 29), (100, 20), (400, 3), (10_000, 29)])
def test_slices_equal_the_plain_window(spark, max_rows, lookback):
    df = tick_data(spark, max_rows)

    def compute(frame, window):
        out = with_frame_volatility(frame, window, "v", lookback + 1)
        lags = {"r1": 1, "r_far": lookback}
        return with_returns(out, window, "v", fill="none", lags=lags).withColumn(
            "prices", F.collect_list("v").over(window.rowsBetween(-lookback, 0)))

    plain = compute(df, Window.partitionBy("s").orderBy("day", "i"))
    sliced = over_series(df, ["s"], ["day", "i"], lookback, compute, max_rows)
    assert sliced.columns == plain.columns
    assert rows_of(sliced.withColumn("volatility", F.col("volatility").cast("string"))) == rows_of(
        plain.withColumn("volatility", F.col("volatility").cast("string")))


def test_a_hot_series_spreads_over_tasks(spark):
    df = spark.range(20_000).selectExpr("'hot' AS s", "id AS i", "cast(id % 7 + 1 AS double) AS v")
    seen = {}

    def compute(frame, window):
        if "_slice" in frame.columns:
            seen["largest"] = frame.groupBy("s", "_slice").count().agg(F.max("count")).first()[0]
        return frame.withColumn("m", F.max("v").over(window.rowsBetween(-9, 0)))

    assert over_series(df, ["s"], ["i"], 9, compute, 2_000).count() == 20_000
    assert seen["largest"] < 6_000


def test_tasks_follow_the_rows(spark, monkeypatch):
    """Many short series in few shuffle partitions: no task may hold much more than the limit."""
    from pricebeam.operators import sliced

    monkeypatch.setattr(sliced, "MAX_ROWS_PER_TASK", 500)
    def compute(frame, window):
        return frame.withColumns({"prior": F.lag("v").over(window), "task": F.spark_partition_id()})

    for rows, series, most in ((20_000, 4000, 1_000), (8_000, 4, 2_000)):  # plain windows; all series in slices
        df = spark.range(rows).selectExpr(f"id % {series} AS s", "id AS i", "cast(id AS double) AS v")
        result = over_series(df, ["s"], ["i"], 1, compute, 500).localCheckpoint()
        assert result.groupBy("task").count().agg(F.max("count")).first()[0] <= most
        assert result.filter(F.col("prior") == F.col("v") - series).count() == rows - series


# --- rollups ---

WEEK = [(D(2024, 6, 10), 100.0), (D(2024, 6, 11), 102.0), (D(2024, 6, 12), 98.0),
        (D(2024, 6, 13), 103.0), (D(2024, 6, 14), 101.0)]


@pytest.mark.parametrize("seed", range(3))
def test_weekly_performance_ignores_row_order(spark, seed):
    data = [(d, "a", v, None) for d, v in WEEK]
    random.Random(seed).shuffle(data)
    df = spark.createDataFrame(data, "date date, index_name string, value double, daily_return double")
    row = rollups.weekly_performance(df.repartition(3)).first()
    assert (row.week_start, row.avg_value, row.volatility) == (D(2024, 6, 10), 100.8, 0.5515)
    assert row.weekly_return == pytest.approx(5 / 98)
    prices = rollups.weekly_price_arrays(df).first().prices
    assert prices == [v for _, v in WEEK]


def test_weekly_performance_with_gaps(spark):
    data = [(D(2024, 6, 10), "one", 5.0), (D(2024, 6, 11), "one", None),
            (D(2024, 6, 10), "none", None), (D(2024, 6, 16), "zero", 0.0),
            (D(2024, 6, 15), "zero", 1.0), (D(2024, 6, 14), "gap", 100.0),
            (D(2024, 6, 12), "gap", None), (D(2024, 6, 10), "gap", 98.0), (D(2024, 6, 15), "gap", 102.0)]
    df = spark.createDataFrame(data, "date date, index_name string, value double")
    found = {r.index_name: r for r in rollups.weekly_performance(df).collect()}
    assert found["one"].volatility == 0.0 and found["none"].volatility == 0.0
    assert found["none"].avg_value is None
    assert str(found["zero"].volatility) == "nan" and found["zero"].weekly_return is None
    # Two log returns; their population deviation is half their distance.
    spread = abs(math.log(100 / 98) - math.log(102 / 100)) / 2
    assert found["gap"].volatility == round(spread * math.sqrt(252), 4) == 0.0032


def test_rollup_tables(spark):
    data = [(D(2024, 6, 30), "a", 1.0, 0.1, 0.5), (D(2024, 7, 1), "a", 3.0, 0.3, 0.7),
            (D(2024, 7, 2), "a", 5.0, None, 0.2)]
    df = spark.createDataFrame(
        data, "date date, index_name string, index_value double, daily_return double, monthly_return double")
    assert rows_of(rollups.monthly_max_return(df)) == [
        (D(2024, 6, 1), "a", 0.5), (D(2024, 7, 1), "a", 0.7)]
    assert rows_of(rollups.weekly_averages(df)) == [
        (D(2024, 6, 24), "a", 1.0, 0.1), (D(2024, 7, 1), "a", 4.0, 0.3)]
    as_of = F.lit(D(2024, 7, 1))
    assert rows_of(rollups.current_month_max_return(df, as_of)) == [(D(2024, 7, 1), "a", 0.7)]
    assert rows_of(rollups.monthly_average(df)) == [
        (D(2024, 6, 1), "a", 1.0), (D(2024, 7, 1), "a", 4.0)]


def long_series(spark, days=120):
    rng = random.Random(5)
    data = [(D(2024, 1, 1) + dt.timedelta(days=i), "a", rng.uniform(90, 110), rng.uniform(-.1, .1))
            for i in range(days)]
    return spark.createDataFrame(
        data, "date date, index_name string, value double, daily_return double")


def test_refresh_windows_are_whole_unless_strict(spark):
    df, as_of = long_series(spark), F.lit(D(2024, 4, 16))
    full = {r.date: r.volatility for r in rollups.daily_performance(df).collect()}
    recent = rollups.recent_daily_performance(df, as_of).collect()
    assert len(recent) == 31 and all(full[r.date] == r.volatility for r in recent)
    strict = rollups.recent_daily_performance(df, as_of, strict_reference=True).collect()
    assert len(strict) == 31 and any(full[r.date] != r.volatility for r in strict)

    weekly = {r.week_start: r for r in
              rollups.weekly_performance(df.filter(F.col("date") <= as_of)).collect()}
    for row in rollups.recent_weekly_performance(df, as_of).collect():
        assert row.avg_value == pytest.approx(weekly[row.week_start].avg_value)
    cut = rollups.recent_weekly_performance(df, as_of, strict_reference=True).orderBy("week_start").first()
    assert cut.avg_value != pytest.approx(weekly[cut.week_start].avg_value)


# --- upsert ---

def test_upsert(spark):
    target = spark.createDataFrame([("A", 1, 1), ("B", 1, 2), ("C", 1, 3)], "k string, n int, v int")
    source = spark.createDataFrame([("B", 1, 20), ("D", 1, 4), (None, 1, 9)], "k string, n int, v int")
    assert rows_of(upsert(target, source, ["k", "n"])) == sorted(
        [("A", 1, 1), ("B", 1, 20), ("C", 1, 3), ("D", 1, 4), (None, 1, 9)], key=repr)
    assert rows_of(upsert_computed(target, source, ["k", "n"])) == rows_of(upsert(target, source, ["k", "n"]))
    again = upsert(upsert(target, source.dropna(), ["k", "n"]), source.dropna(), ["k", "n"])
    assert again.count() == 4


def test_upsert_guard(spark):
    source = spark.createDataFrame([("B", 1), ("B", 1)], "k string, n int")
    assert rows_of(duplicate_keys(source, ["k", "n"])) == [("B", 1, 2)]
    with pytest.raises(DuplicateKeyError):
        require_unique(source, ["k", "n"])
    require_unique(spark.createDataFrame([(None, 1), (None, 1), ("B", 1)], "k string, n int"), ["k", "n"])


# --- changes, series, comparison ---

def test_snapshot_changes(spark):
    before = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", None), ("E", None)], "k string, v double")
    after = spark.createDataFrame([("A", 1.0), ("B", 3.0), ("C", None), ("D", 4.0)], "k string, v double")
    assert rows_of(snapshot_changes(before, after, ["k"])) == sorted(
        [("B", 3.0, "update"), ("D", 4.0, "insert"), ("E", None, "delete")], key=repr)
    assert rows_of(row_changes(before, after)) == sorted(
        [("B", 3.0, "insert"), ("D", 4.0, "insert"), ("B", 2.0, "delete"), ("E", None, "delete")], key=repr)


def test_series_helpers(spark):
    a = spark.createDataFrame([("SP500", D(2024, 1, 1), 1.0)], "series_id string, date date, v double")
    b = spark.createDataFrame([(2.0, "OTHER", D(2024, 1, 2))], "v double, series_id string, date date")
    both = union_series([a, b])
    assert both.count() == 2
    names = {"SP500": "S&P500"}
    assert rows_of(tag_series(both, names)) == [(D(2024, 1, 1), 1.0, "S&P500")]
    dimension = spark.createDataFrame(list(names.items()), "series_id string, index_name string")
    assert rows_of(tag_series(both, dimension)) == rows_of(tag_series(both, names))
    assert date_range(both, F.lit(D(2024, 1, 2)), F.lit(D(2024, 1, 2))).count() == 1


def test_comparison(spark):
    data = [(D(2024, 1, 1) + dt.timedelta(days=i), n, 10.0 + i * s, float(i * s % 5))
            for i in range(10) for n, s in (("x", 1), ("y", 2), ("z", 3))]
    df = spark.createDataFrame(data, "date date, index_name string, value double, daily_return double")
    assert {r.rebased for r in comparison.rebased(df).filter("date = '2024-01-01'").collect()} == {100.0}
    last = comparison.moving_average(df, rows=2).filter("date = '2024-01-10' AND index_name = 'x'").first()
    assert last.moving_average == 18.5
    pairs = {(r.index_a, r.index_b): r.correlation
             for r in comparison.return_correlation(df).collect()}
    joined = df.alias("a").join(df.alias("b"), "date").filter("a.index_name < b.index_name").groupBy(
        "a.index_name", "b.index_name").agg(F.corr("a.daily_return", "b.daily_return")).collect()
    assert len(pairs) == 3
    for a, b, c in joined:
        assert pairs[a, b] == pytest.approx(c)


@pytest.mark.parametrize("max_rows", [10_000, 7])
def test_padding_over_slices_equals_the_plain_window(spark, max_rows):
    """Long gaps, a series without any price, ties and null keys; slices shorter than the gaps."""
    from pricebeam.operators.sliced import filled_over_series, returns_over_series

    rng = random.Random(4)
    data = [(n, rng.randrange(60), i, rng.choice([None] * 8 + [rng.uniform(1, 9)])) for n in ("a", "b", None) for i in range(150)]
    data += [("empty", 1, i, None) for i in range(40)]
    df = spark.createDataFrame(data, "name string, day int, seq int, value double")
    window = Window.partitionBy("name").orderBy("day", "seq", "value")
    plain = df.withColumn("filled", F.last("value", ignorenulls=True).over(
        window.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    lags = {"one": 1, "many": 9}
    returns = plain.withColumns({n: F.try_divide("filled", F.lag("filled", k).over(window)) - 1 for n, k in lags.items()})

    def rows(frame):
        return sorted(map(repr, frame.collect()))

    assert rows(filled_over_series(df, ["name"], ["day", "seq"], "value", "filled", max_rows)) == rows(plain)
    found = returns_over_series(df, ["name"], ["day", "seq"], "value", lags, max_rows=max_rows)
    assert rows(found) == rows(returns.drop("filled"))
