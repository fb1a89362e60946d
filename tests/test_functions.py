import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from pricebeam.functions import (
    array_volatility,
    as_of_date,
    date_text,
    month_start,
    normalize,
    register_functions,
    trailing_days,
    week_start,
    with_frame_volatility,
    with_returns,
)

NAN = float("nan")
VOLATILITY_CASES = [
    ([100, 102, 98, 103, 101], 0.5515), ([100, 102], 0.0), ([100], 0.0), ([], 0.0), (None, 0.0),
    ([1, 2, 1], 11.0034), ([1, 0, 1], NAN), ([100, None], NAN), ([None, None], NAN),
    ([100, None, 102, 98], 0.4747), ([1, 1, 1], 0.0), ([-1, -1, -1], 0.0), ([1, -1, 1], NAN),
    ([0, 0, 1], NAN),
]


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def floats(values):
    return None if values is None else [None if v is None else float(v) for v in values]


def test_array_volatility(spark):
    rows = [(i, floats(a)) for i, (a, _) in enumerate(VOLATILITY_CASES)]
    df = spark.createDataFrame(rows, "i int, a array<double>")
    register_functions(spark)
    df.createOrReplaceTempView("arrays")
    direct = df.select("i", array_volatility("a")).collect()
    by_name = spark.sql("SELECT i, calculate_volatility(a) FROM arrays").collect()
    for found in (direct, by_name):
        for i, value in found:
            assert same(value, VOLATILITY_CASES[i][1]), VOLATILITY_CASES[i]


def test_sql_literals(spark):
    register_functions(spark)
    row = spark.sql("SELECT normalize_exchange_rate(1.5), normalize_index_value(-2), "
                    "calculate_volatility(array(100, 102, 98, 103, 101))").first()
    assert tuple(row) == (1.0, -1.0, 0.5515)


def test_normalize(spark):
    cases = [(1.5, 1.0), (-2.0, -1.0), (0.0, 0.0), (None, 0.0), (NAN, NAN), (-0.0, 0.0),
             (float("inf"), NAN)]
    df = spark.createDataFrame([(v, e) for v, e in cases], "v double, e double")
    for found, expected in df.select(normalize("v"), "e").collect():
        assert same(found, expected)


@pytest.mark.parametrize("fill, expected", [
    ("pad", [None, 0.1, 0.0, 12 / 11 - 1, -0.25]),
    ("none", [None, 0.1, None, None, -0.25]),
])
def test_pct_change(spark, fill, expected):
    prices = [10.0, 11.0, None, 12.0, 9.0]
    df = spark.createDataFrame([("a", i, p) for i, p in enumerate(prices)],
                               "k string, i int, v double")
    out = with_returns(df, Window.partitionBy("k").orderBy("i"), "v", fill, {"r": 1})
    for (found,), want in zip(out.orderBy("i").select("r").collect(), expected):
        assert found is None if want is None else found == pytest.approx(want, abs=1e-12)


def test_pct_change_of_zero_is_null(spark):
    df = spark.createDataFrame([("a", 0, 0.0), ("a", 1, 5.0)], "k string, i int, v double")
    out = with_returns(df, Window.partitionBy("k").orderBy("i"), "v", lags={"r": 1})
    assert [r.r for r in out.orderBy("i").collect()] == [None, None]


def test_returns_share_one_exchange(spark):
    df = spark.createDataFrame([("a", 0, 1.0)], "k string, i int, v double")
    out = with_returns(df, Window.partitionBy("k").orderBy("i"), "v")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def numpy_volatility(frame):
    prices = np.array([p for p in frame if p is not None], dtype=float)
    if len(prices) < 2:
        return 0.0
    with np.errstate(all="ignore"):
        returns = np.log(prices[1:] / prices[:-1])
        return float(round(np.std(returns) * np.sqrt(252), 4))


@pytest.mark.parametrize("rows", [4, 21, 30])
def test_frame_volatility_against_numpy(spark, rows):
    rng = np.random.default_rng(rows)
    data = []
    for series in range(4):
        prices = rng.lognormal(4, 0.3, 300)
        odd = rng.random(300)
        for i in range(300):
            price = float(prices[i])
            if odd[i] < 0.15:
                price = None
            elif series % 2 and odd[i] < 0.17:
                price = 0.0
            elif series % 2 and odd[i] < 0.19:
                price = -price
            data.append((series, i, price))
    df = spark.createDataFrame(data, "k int, i int, v double")
    out = with_frame_volatility(df, Window.partitionBy("k").orderBy("i"), "v", rows)
    series = {k: [p for s, _, p in data if s == k] for k in range(4)}
    seen_nan = 0
    for k, i, found in out.select("k", "i", "volatility").collect():
        expected = numpy_volatility(series[k][max(0, i - rows + 1):i + 1])
        seen_nan += math.isnan(expected)
        assert same(found, expected) or found == pytest.approx(expected, abs=1.01e-4), (k, i)
    assert seen_nan


def test_dates(spark):
    day, as_of = F.lit(dt.date(2024, 6, 16)), as_of_date("2024-07-16")
    row = spark.range(1).select(
        week_start(day), month_start(day), date_text(day), date_text(day, "yyyyMMdd"),
        trailing_days(day, as_of, 30), trailing_days(day, as_of, 29),
        trailing_days(F.lit(dt.date(2024, 7, 17)), as_of, 30)).first()
    assert tuple(row) == (dt.date(2024, 6, 10), dt.date(2024, 6, 1), "2024-06-16", "20240616",
                          True, False, False)
