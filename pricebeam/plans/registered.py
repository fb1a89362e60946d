"""Every registered query with the SQL that must give the same rows.

Doubles are rounded to six places on both sides, volatility to its own four.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricebeam.functions import (
    as_of_date,
    date_text,
    normalize,
    register_functions,
    trailing_days,
    with_frame_volatility,
    with_returns,
)
from pricebeam.operators import comparison, rollups
from pricebeam.operators.changes import row_changes, snapshot_changes
from pricebeam.operators.dedupe import dedupe_latest
from pricebeam.operators.series import date_range, tag_series, union_series, unlisted_series
from pricebeam.operators.sliced import over_series, returns_over_series
from pricebeam.operators.upsert import duplicate_keys, upsert_computed
from pricebeam.plans import views
from pricebeam.plans.harmonize import daily_metrics, harmonize, with_volatility
from pricebeam.sources.adapters import (
    AS_OF,
    PART_TICK_ORDER,
    daily_series,
    daily_series_with_gaps,
    order_ticks,
    part_ticks,
    raw_series,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Display names of the five order series.
PRIORITY_NAMES = {
    "1-URGENT": "URGENT",
    "2-HIGH": "HIGH",
    "3-MEDIUM": "MEDIUM",
    "4-NOT SPECIFIED": "NOT SPECIFIED",
    "5-LOW": "LOW",
}
SNAPSHOT_DAY = dt.date(2001, 7, 15)


def registered(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def r6(column: Column | str, name: str | None = None) -> Column:
    source = F.col(column) if isinstance(column, str) else column
    return F.round(source, 6).alias(name or column)


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily series as the performance operators read it: date, index_name, value, daily_return."""
    return raw_series(spark, sf_dir).withColumnRenamed("index_value", "value").drop("monthly_return")


# SQL of the series. `p` one price per day, `p0` the same with gaps, `pr` with returns.
P = """
ticks AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS index_name,
                 o_totalprice AS index_value, o_orderkey AS seq FROM orders),
p AS (SELECT * FROM ticks
      QUALIFY row_number() OVER (PARTITION BY date, index_name ORDER BY seq DESC) = 1),
p0 AS (SELECT date, index_name, seq,
              CASE WHEN seq % 11 = 0 THEN NULL ELSE index_value END AS index_value FROM p),
pr AS (SELECT *,
         index_value / lag(index_value, 1) OVER (PARTITION BY index_name ORDER BY date) - 1
           AS daily_return,
         index_value / lag(index_value, 30) OVER (PARTITION BY index_name ORDER BY date) - 1
           AS monthly_return
       FROM p)
"""


def frame_volatility_sql(rows: int, source: str = "p", value: str = "index_value") -> str:
    """Trailing-frame volatility of a series without gaps, as a CTE `vol`."""
    return f"""
lr AS (SELECT *, ln({value} / lag({value}) OVER (PARTITION BY index_name ORDER BY date)) AS r
       FROM {source}),
vol AS (SELECT *, CASE WHEN count({value}) OVER (PARTITION BY index_name ORDER BY date
                         ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW) < 2 THEN 0.0
                  ELSE round(stddev_pop(r) OVER (PARTITION BY index_name ORDER BY date
                         ROWS BETWEEN {rows - 2} PRECEDING AND CURRENT ROW) * sqrt(252), 4)
                  END AS volatility
        FROM lr)
"""


def weekly_performance_sql(source: str = "pr", where: str = "true", name: str = "wp") -> str:
    """Weekly performance over a series without gaps, as a CTE."""
    return f"""
{name}_r AS (SELECT date_trunc('week', date)::DATE AS week_start, index_name, index_value AS v,
               ln(index_value / lag(index_value) OVER (
                 PARTITION BY index_name, date_trunc('week', date) ORDER BY date)) AS r
             FROM {source} WHERE {where}),
{name} AS (SELECT week_start, index_name, avg(v) AS avg_value,
             (max(v) - min(v)) / min(v) AS weekly_return,
             CASE WHEN count(v) < 2 THEN 0.0 ELSE round(stddev_pop(r) * sqrt(252), 4) END
               AS volatility
           FROM {name}_r GROUP BY ALL)
"""


# --- returns -----------------------------------------------------------------------------------

@registered("daily_return", f"""WITH {P}
SELECT date, index_name, round(daily_return, 6) AS daily_return FROM pr""")
def daily_return(spark, sf_dir):
    return raw_series(spark, sf_dir).select("date", "index_name", r6("daily_return"))


@registered("monthly_return_30", f"""WITH {P}
SELECT date, index_name, round(monthly_return, 6) AS monthly_return FROM pr""")
def monthly_return_30(spark, sf_dir):
    return raw_series(spark, sf_dir).select("date", "index_name", r6("monthly_return"))


@registered("pct_change_padded", f"""WITH {P},
filled AS (SELECT date, index_name, last_value(index_value IGNORE NULLS) OVER (
             PARTITION BY index_name ORDER BY date
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM p0)
SELECT date, index_name,
  round(v / lag(v, 1) OVER (PARTITION BY index_name ORDER BY date) - 1, 6) AS daily_return,
  round(v / lag(v, 30) OVER (PARTITION BY index_name ORDER BY date) - 1, 6) AS monthly_return
FROM filled""")
def pct_change_padded(spark, sf_dir):
    gaps = daily_series_with_gaps(spark, sf_dir)
    return with_returns(gaps, rollups.daily_series_window()).select(
        "date", "index_name", r6("daily_return"), r6("monthly_return"))


@registered("pct_change_strict", f"""WITH {P}
SELECT date, index_name, round(index_value / lag(index_value, 1) OVER (
  PARTITION BY index_name ORDER BY date) - 1, 6) AS daily_return FROM p0""")
def pct_change_strict(spark, sf_dir):
    gaps = daily_series_with_gaps(spark, sf_dir)
    return with_returns(gaps, rollups.daily_series_window(), fill="none",
                        lags={"daily_return": 1}).select("date", "index_name", r6("daily_return"))


@registered("daily_return_by_part", """
SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS index_name, l_orderkey AS order_key,
  l_linenumber AS line_number, l_extendedprice AS value,
  round(l_extendedprice / lag(l_extendedprice) OVER (PARTITION BY l_partkey
    ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) - 1, 6) AS daily_return
FROM lineitem""")
def daily_return_by_part(spark, sf_dir):
    def compute(df, window):
        return with_returns(df, window, "value", fill="none", lags={"daily_return": 1})

    result = over_series(part_ticks(spark, sf_dir), ["index_name"], PART_TICK_ORDER, 1, compute)
    return result.withColumn("daily_return", r6("daily_return"))


# --- normalize, dedupe, harmonize ----------------------------------------------------------------

@registered("normalize_value", f"""WITH {P}
SELECT date, index_name, coalesce(sign(index_value), 0)::DOUBLE AS value_sign,
  coalesce(sign(index_value / lag(index_value) OVER (PARTITION BY index_name ORDER BY date) - 1), 0)
    ::DOUBLE AS return_sign
FROM p0""")
def normalize_value(spark, sf_dir):
    gaps = with_returns(daily_series_with_gaps(spark, sf_dir), rollups.daily_series_window(),
                        fill="none", lags={"daily_return": 1})
    return gaps.select("date", "index_name", normalize("index_value").alias("value_sign"),
                       normalize("daily_return").alias("return_sign"))


@registered("dedupe_latest", f"WITH {P} SELECT date, index_name, index_value, seq FROM p")
def dedupe_latest_query(spark, sf_dir):
    return daily_series(spark, sf_dir)


@registered("dedupe_by_part", """
SELECT date, index_name, order_key, line_number, value FROM (
  SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS index_name, l_orderkey AS order_key,
         l_linenumber AS line_number, l_extendedprice AS value FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY date, index_name
                           ORDER BY order_key DESC, line_number DESC, value DESC) = 1""")
def dedupe_by_part(spark, sf_dir):
    return dedupe_latest(part_ticks(spark, sf_dir), ["date", "index_name"],
                         ["order_key", "line_number"])


HARMONIZED_COLUMNS = """CAST(date AS TIMESTAMP) AS timestamp, index_name, index_value AS value,
  round(daily_return, 6) AS daily_return, round(monthly_return, 6) AS monthly_return"""


@registered("harmonize", f"""WITH {P},
twice AS (SELECT * FROM pr UNION ALL SELECT * FROM pr)
SELECT DISTINCT {HARMONIZED_COLUMNS} FROM twice""")
def harmonize_query(spark, sf_dir):
    raw = raw_series(spark, sf_dir)
    return harmonize(raw.unionByName(raw)).select(
        "timestamp", "index_name", "value", r6("daily_return"), r6("monthly_return"))


@registered("harmonized_with_volatility", f"""WITH {P},
signs AS (SELECT *, coalesce(sign(index_value), 0)::DOUBLE AS normalized_value FROM pr),
{frame_volatility_sql(30, "signs", "normalized_value")}
SELECT {HARMONIZED_COLUMNS}, normalized_value, volatility FROM vol""")
def harmonized_with_volatility(spark, sf_dir):
    return with_volatility(harmonize(raw_series(spark, sf_dir))).select(
        "timestamp", "index_name", "value", r6("daily_return"), r6("monthly_return"),
        "normalized_value", "volatility")


# --- frame windows -------------------------------------------------------------------------------

@registered("rolling_volatility_21", f"""WITH {P}, {frame_volatility_sql(21)}
SELECT date, index_name, index_value, volatility FROM vol""")
def rolling_volatility_21(spark, sf_dir):
    return with_frame_volatility(
        daily_series(spark, sf_dir).drop("seq"), rollups.daily_series_window(), "index_value", 21)


@registered("rolling_volatility_21_nulls", f"""WITH {P},
framed AS (SELECT date, index_name, list(index_value) FILTER (WHERE index_value IS NOT NULL) OVER (
             PARTITION BY index_name ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS a
           FROM p0)
SELECT date, index_name, CASE WHEN a IS NULL OR len(a) < 2 THEN 0.0
  ELSE round(list_stddev_pop(list_transform(range(2, len(a) + 1), lambda i: ln(a[i] / a[i - 1])))
             * sqrt(252), 4) END AS volatility
FROM framed""")
def rolling_volatility_21_nulls(spark, sf_dir):
    gaps = daily_series_with_gaps(spark, sf_dir)
    return with_frame_volatility(gaps, rollups.daily_series_window(), "index_value", 21).select(
        "date", "index_name", "volatility")


@registered("rolling_prices_21", f"""WITH {P},
framed AS (SELECT date, index_name, list(index_value) FILTER (WHERE index_value IS NOT NULL) OVER (
             PARTITION BY index_name ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS a
           FROM p0)
SELECT date, index_name, coalesce(array_to_string(
  list_transform(a, lambda v: CAST(round(v * 100) AS BIGINT)::VARCHAR), ','), '') AS cents FROM framed""")
def rolling_prices_21(spark, sf_dir):
    framed = rollups.frame_prices(daily_series_with_gaps(spark, sf_dir), 21, "index_value")
    cents = F.transform("prices", lambda v: F.round(v * 100).cast("bigint").cast("string"))
    return framed.select("date", "index_name", F.array_join(cents, ",").alias("cents"))


@registered("rolling_volatility_30_price", f"""WITH {P}, {frame_volatility_sql(30)}
SELECT date, index_name, index_value, volatility FROM vol""")
def rolling_volatility_30_price(spark, sf_dir):
    return with_frame_volatility(
        daily_series(spark, sf_dir).drop("seq"), rollups.daily_series_window(), "index_value", 30)


def _tick_volatility_sql(series: str, order: str, columns: str, table: str) -> str:
    return f"""
WITH lr AS (SELECT *, ln(value / lag(value) OVER w) AS r,
              count(value) OVER (PARTITION BY {series} ORDER BY {order}
                ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS n
            FROM ({table}) t WINDOW w AS (PARTITION BY {series} ORDER BY {order}))
SELECT {columns}, CASE WHEN n < 2 THEN 0.0 ELSE round(stddev_pop(r) OVER (
    PARTITION BY {series} ORDER BY {order} ROWS BETWEEN 28 PRECEDING AND CURRENT ROW)
    * sqrt(252), 4) END AS volatility
FROM lr"""


@registered("rolling_volatility_30_price_by_part", _tick_volatility_sql(
    "index_name", "date, order_key, line_number, value",
    "date, index_name, value, order_key, line_number",
    """SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS index_name, l_orderkey AS order_key,
       l_linenumber AS line_number, l_extendedprice AS value FROM lineitem"""))
def rolling_volatility_30_price_by_part(spark, sf_dir):
    return over_series(part_ticks(spark, sf_dir), ["index_name"], PART_TICK_ORDER, 29,
                       lambda df, window: with_frame_volatility(df, window, "value", 30))


@registered("rolling_volatility_30_long_series", _tick_volatility_sql(
    "index_name", "date, seq", "date, index_name, value, seq",
    """SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS index_name,
       o_totalprice AS value, o_orderkey AS seq FROM orders"""))
def rolling_volatility_30_long_series(spark, sf_dir):
    """Five undeduplicated series, each a fifth of all rows, always cut into slices."""
    ticks = order_ticks(spark, sf_dir).withColumnRenamed("index_value", "value")
    rows = max(ticks.count() // 8, 1)
    return over_series(ticks, ["index_name"], ["date", "seq"], 29,
                       lambda df, window: with_frame_volatility(df, window, "value", 30),
                       max_rows=rows)


@registered("pct_change_padded_long_series", """
WITH t AS (SELECT CAST(l_shipdate AS DATE) AS date, l_partkey % 7 AS index_name, l_orderkey AS order_key, l_linenumber AS line_number,
    l_partkey AS part, CASE WHEN l_orderkey % 5 > 0 THEN NULL ELSE l_extendedprice END AS value FROM lineitem),
f AS (SELECT *, last_value(value IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS padded, row_number() OVER w AS n FROM t
    WINDOW w AS (PARTITION BY index_name ORDER BY date, order_key, line_number, part, value NULLS FIRST))
SELECT date, index_name, order_key, line_number, part, value,
  round(padded / lag(padded, 1) OVER w - 1, 6) AS daily_return, round(padded / lag(padded, 30) OVER w - 1, 6) AS monthly_return
FROM f WINDOW w AS (PARTITION BY index_name ORDER BY n)""")
def pct_change_padded_long_series(spark, sf_dir):
    """Seven long series of line items, four in five prices missing, always cut into slices."""
    ticks = part_ticks(spark, sf_dir).select(
        "date", (F.col("index_name") % 7).alias("index_name"), "order_key", "line_number", F.col("index_name").alias("part"),
        F.when(F.col("order_key") % 5 == 0, F.col("value")).alias("value"))
    rows = max(ticks.count() // 20, 1)
    found = returns_over_series(ticks, ["index_name"], ["date", "order_key", "line_number", "part"], "value",
                                {"daily_return": 1, "monthly_return": 30}, max_rows=rows)
    return found.withColumns({c: r6(c) for c in ("daily_return", "monthly_return")})


# --- metric tables -------------------------------------------------------------------------------

@registered("daily_index_metrics", f"""WITH {P}
SELECT date, index_name, index_value, round(daily_return, 6) AS daily_return FROM pr""")
def daily_index_metrics(spark, sf_dir):
    return daily_metrics(harmonize(raw_series(spark, sf_dir))).withColumn(
        "daily_return", r6("daily_return"))


@registered("weekly_index_metrics", f"""WITH {P}
SELECT date_trunc('week', date)::DATE AS week, index_name,
  round(avg(index_value), 6) AS avg_index_value, round(avg(daily_return), 6) AS avg_daily_return
FROM pr GROUP BY ALL""")
def weekly_index_metrics(spark, sf_dir):
    return rollups.weekly_averages(raw_series(spark, sf_dir)).select(
        "week", "index_name", r6("avg_index_value"), r6("avg_daily_return"))


@registered("weekly_index_metrics_by_part", """
WITH r AS (SELECT date_trunc('week', l_shipdate)::DATE AS week, l_partkey AS index_name,
  l_extendedprice AS v, l_extendedprice / lag(l_extendedprice) OVER (PARTITION BY l_partkey
    ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) - 1 AS daily_return
FROM lineitem)
SELECT week, index_name, round(avg(v), 6) AS avg_index_value,
  round(avg(daily_return), 6) AS avg_daily_return FROM r GROUP BY ALL""")
def weekly_index_metrics_by_part(spark, sf_dir):
    def compute(df, window):
        return with_returns(df, window, "value", fill="none", lags={"daily_return": 1})

    returns = over_series(part_ticks(spark, sf_dir), ["index_name"], PART_TICK_ORDER, 1, compute)
    return rollups.weekly_averages(returns, value="value").select(
        "week", "index_name", r6("avg_index_value"), r6("avg_daily_return"))


@registered("monthly_index_metrics", f"""WITH {P}
SELECT date_trunc('month', date)::DATE AS month, index_name,
  round(max(monthly_return), 6) AS monthly_return FROM pr GROUP BY ALL""")
def monthly_index_metrics(spark, sf_dir):
    return rollups.monthly_max_return(raw_series(spark, sf_dir)).withColumn(
        "monthly_return", r6("monthly_return"))


WEEKLY_PERFORMANCE_COLUMNS = """week_start, index_name, round(avg_value, 6) AS avg_value,
  round(weekly_return, 6) AS weekly_return, volatility"""


def _rounded_weekly_performance(df: DataFrame) -> DataFrame:
    return df.select("week_start", "index_name", r6("avg_value"), r6("weekly_return"), "volatility")


def _rounded_daily_performance(df: DataFrame) -> DataFrame:
    return df.select("date", "index_name", "value", r6("daily_return"), "volatility")


@registered("weekly_performance", f"""WITH {P}, {weekly_performance_sql()}
SELECT {WEEKLY_PERFORMANCE_COLUMNS} FROM wp""")
def weekly_performance(spark, sf_dir):
    return _rounded_weekly_performance(rollups.weekly_performance(priced(spark, sf_dir)))


@registered("weekly_price_arrays", f"""WITH {P}
SELECT date_trunc('week', date)::DATE AS week_start, index_name, array_to_string(
  list(CAST(round(index_value * 100) AS BIGINT)::VARCHAR ORDER BY date), ',') AS cents
FROM p GROUP BY ALL""")
def weekly_price_arrays(spark, sf_dir):
    weekly = rollups.weekly_price_arrays(priced(spark, sf_dir))
    cents = F.transform("prices", lambda v: F.round(v * 100).cast("bigint").cast("string"))
    return weekly.select("week_start", "index_name", F.array_join(cents, ",").alias("cents"))


@registered("daily_performance", f"""WITH {P}, {frame_volatility_sql(21, "pr")}
SELECT date, index_name, index_value AS value, round(daily_return, 6) AS daily_return, volatility
FROM vol""")
def daily_performance(spark, sf_dir):
    return _rounded_daily_performance(rollups.daily_performance(priced(spark, sf_dir)))


# --- lookbacks -----------------------------------------------------------------------------------

@registered("current_month_metrics", f"""WITH {P}
SELECT date_trunc('month', date)::DATE AS month, index_name,
  round(max(monthly_return), 6) AS monthly_return FROM pr
WHERE date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31' GROUP BY ALL""")
def current_month_metrics(spark, sf_dir):
    return rollups.current_month_max_return(raw_series(spark, sf_dir), as_of_date(AS_OF)).withColumn(
        "monthly_return", r6("monthly_return"))


@registered("last_30_days", f"""WITH {P} SELECT date, index_name, index_value FROM p
WHERE date BETWEEN DATE '2001-07-31' - 30 AND DATE '2001-07-31'""")
def last_30_days(spark, sf_dir):
    return daily_series(spark, sf_dir).filter(
        trailing_days("date", as_of_date(AS_OF), 30)).drop("seq")


@registered("last_4_weeks", f"""WITH {P} SELECT date, index_name, index_value FROM p
WHERE date BETWEEN DATE '2001-07-31' - 28 AND DATE '2001-07-31'""")
def last_4_weeks(spark, sf_dir):
    return daily_series(spark, sf_dir).filter(
        trailing_days("date", as_of_date(AS_OF), 28)).drop("seq")


@registered("recent_daily_performance_strict", f"""WITH {P},
recent AS (SELECT * FROM pr WHERE date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31'),
{frame_volatility_sql(21, "recent")}
SELECT date, index_name, index_value AS value, round(daily_return, 6) AS daily_return, volatility
FROM vol""")
def recent_daily_performance_strict(spark, sf_dir):
    return _rounded_daily_performance(rollups.recent_daily_performance(
        priced(spark, sf_dir), as_of_date(AS_OF), strict_reference=True))


@registered("recent_weekly_performance_strict", f"""WITH {P},
{weekly_performance_sql(where="date BETWEEN DATE '2001-07-03' AND DATE '2001-07-31'")}
SELECT {WEEKLY_PERFORMANCE_COLUMNS} FROM wp""")
def recent_weekly_performance_strict(spark, sf_dir):
    return _rounded_weekly_performance(rollups.recent_weekly_performance(
        priced(spark, sf_dir), as_of_date(AS_OF), strict_reference=True))


# --- upserts -------------------------------------------------------------------------------------

def _before_snapshot() -> Column:
    return F.col("date") < F.lit(SNAPSHOT_DAY)


@registered("upsert_monthly", f"""WITH {P},
t AS (SELECT date_trunc('month', date)::DATE AS month, index_name, max(monthly_return) AS v
      FROM pr WHERE date < DATE '2001-07-15' GROUP BY ALL),
s AS (SELECT date_trunc('month', date)::DATE AS month, index_name, max(monthly_return) AS v
      FROM pr WHERE date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31' GROUP BY ALL)
SELECT coalesce(s.month, t.month) AS month, coalesce(s.index_name, t.index_name) AS index_name,
  round(CASE WHEN s.month IS NULL THEN t.v ELSE s.v END, 6) AS monthly_return
FROM t FULL OUTER JOIN s ON t.month = s.month AND t.index_name = s.index_name""")
def upsert_monthly(spark, sf_dir):
    raw = raw_series(spark, sf_dir)
    target = rollups.monthly_max_return(raw.filter(_before_snapshot()))
    source = rollups.current_month_max_return(raw, as_of_date(AS_OF))
    return upsert_computed(target, source, ["month", "index_name"]).withColumn(
        "monthly_return", r6("monthly_return"))


@registered("upsert_daily_performance", f"""WITH {P},
old AS (SELECT * FROM pr WHERE date < DATE '2001-07-15'),
upto AS (SELECT * FROM pr WHERE date <= DATE '2001-07-31'),
t AS (WITH {frame_volatility_sql(21, "old")} SELECT * FROM vol),
s AS (WITH {frame_volatility_sql(21, "upto")} SELECT * FROM vol WHERE date >= DATE '2001-07-01')
SELECT coalesce(s.date, t.date) AS date, coalesce(s.index_name, t.index_name) AS index_name,
  CASE WHEN s.date IS NULL THEN t.index_value ELSE s.index_value END AS value,
  round(CASE WHEN s.date IS NULL THEN t.daily_return ELSE s.daily_return END, 6) AS daily_return,
  CASE WHEN s.date IS NULL THEN t.volatility ELSE s.volatility END AS volatility
FROM t FULL OUTER JOIN s ON t.date = s.date AND t.index_name = s.index_name""")
def upsert_daily_performance(spark, sf_dir):
    rows = priced(spark, sf_dir)
    target = rollups.daily_performance(rows.filter(_before_snapshot()))
    source = rollups.recent_daily_performance(rows, as_of_date(AS_OF))
    return _rounded_daily_performance(upsert_computed(target, source, ["date", "index_name"]))


@registered("upsert_weekly_performance", f"""WITH {P},
{weekly_performance_sql(where="date < DATE '2001-07-15'", name="t")},
{weekly_performance_sql(where="date BETWEEN DATE '2001-07-02' AND DATE '2001-07-31'", name="s")}
SELECT coalesce(s.week_start, t.week_start) AS week_start,
  coalesce(s.index_name, t.index_name) AS index_name,
  round(CASE WHEN s.week_start IS NULL THEN t.avg_value ELSE s.avg_value END, 6) AS avg_value,
  round(CASE WHEN s.week_start IS NULL THEN t.weekly_return ELSE s.weekly_return END, 6)
    AS weekly_return,
  CASE WHEN s.week_start IS NULL THEN t.volatility ELSE s.volatility END AS volatility
FROM t FULL OUTER JOIN s ON t.week_start = s.week_start AND t.index_name = s.index_name""")
def upsert_weekly_performance(spark, sf_dir):
    rows = priced(spark, sf_dir)
    target = rollups.weekly_performance(rows.filter(_before_snapshot()))
    source = rollups.recent_weekly_performance(rows, as_of_date(AS_OF))
    return _rounded_weekly_performance(upsert_computed(target, source, ["week_start", "index_name"]))


# --- filters, unions, tags, changes, checks ------------------------------------------------------

@registered("date_range", f"""WITH {P} SELECT date, index_name, index_value FROM p
WHERE date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'""")
def date_range_query(spark, sf_dir):
    days = F.lit(dt.date(1998, 1, 1)), F.lit(dt.date(1999, 12, 31))
    return date_range(daily_series(spark, sf_dir), *days).drop("seq")


@registered("union_series", """
SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS index_name, o_totalprice AS index_value FROM orders
UNION ALL SELECT CAST(l_shipdate AS DATE), CAST(l_partkey AS VARCHAR), l_extendedprice FROM lineitem""")
def union_series_query(spark, sf_dir):
    """The series of two tables in one frame; each table is scanned once."""
    parts = part_ticks(spark, sf_dir).select(
        "date", F.col("index_name").cast("string").alias("index_name"), F.col("value").alias("index_value"))
    return union_series([order_ticks(spark, sf_dir).select("date", "index_name", "index_value"), parts])


@registered("unlisted_series", f"""WITH {P}
SELECT index_name AS series_id, count(*) AS rows FROM p
WHERE index_name NOT IN ('1-URGENT', '2-HIGH') GROUP BY ALL""")
def unlisted_series_query(spark, sf_dir):
    series = daily_series(spark, sf_dir).drop("seq").withColumnRenamed("index_name", "series_id")
    return unlisted_series(series, {k: PRIORITY_NAMES[k] for k in ("1-URGENT", "2-HIGH")})


@registered("series_tagging", f"""WITH {P}
SELECT date, CASE index_name WHEN '1-URGENT' THEN 'URGENT' WHEN '2-HIGH' THEN 'HIGH'
  WHEN '3-MEDIUM' THEN 'MEDIUM' WHEN '4-NOT SPECIFIED' THEN 'NOT SPECIFIED' ELSE 'LOW' END
  AS index_name, index_value, 'orders' AS source FROM p""")
def series_tagging(spark, sf_dir):
    series = daily_series(spark, sf_dir).drop("seq").withColumnRenamed("index_name", "series_id")
    return tag_series(series, PRIORITY_NAMES).withColumn("source", F.lit("orders"))


def _snapshots(spark, sf_dir):
    """The series of one day, and a later state: newer rows, low prices gone, high ones corrected."""
    series = daily_series(spark, sf_dir).drop("seq")
    price = F.col("index_value")
    later = series.filter(price >= 50_000).withColumn(
        "index_value", F.when(price > 400_000, price + 1).otherwise(price))
    return series.filter(_before_snapshot()), later


SNAPSHOT_SQL = f"""WITH {P},
b AS (SELECT date, index_name, index_value FROM p WHERE date < DATE '2001-07-15'),
a AS (SELECT date, index_name,
        index_value + CASE WHEN index_value > 400000 THEN 1 ELSE 0 END AS index_value
      FROM p WHERE index_value >= 50000)"""


@registered("snapshot_changes", f"""{SNAPSHOT_SQL}
SELECT coalesce(a.date, b.date) AS date, coalesce(a.index_name, b.index_name) AS index_name,
  round(coalesce(a.index_value, b.index_value), 6) AS index_value,
  CASE WHEN b.date IS NULL THEN 'insert' WHEN a.date IS NULL THEN 'delete' ELSE 'update' END AS op
FROM b FULL OUTER JOIN a ON a.date = b.date AND a.index_name = b.index_name
WHERE a.index_value IS DISTINCT FROM b.index_value""")
def snapshot_changes_query(spark, sf_dir):
    before, after = _snapshots(spark, sf_dir)
    return snapshot_changes(before, after, ["date", "index_name"]).withColumn(
        "index_value", r6("index_value"))


@registered("snapshot_row_changes", f"""{SNAPSHOT_SQL}
SELECT date, index_name, round(index_value, 6) AS index_value, op FROM (
  (SELECT *, 'insert' AS op FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b))
  UNION ALL (SELECT *, 'delete' AS op FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)))""")
def snapshot_row_changes(spark, sf_dir):
    return row_changes(*_snapshots(spark, sf_dir)).withColumn("index_value", r6("index_value"))


@registered("primary_key_violations", """
SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS index_name, count(*) AS count
FROM orders GROUP BY ALL HAVING count(*) > 1""")
def primary_key_violations(spark, sf_dir):
    return duplicate_keys(order_ticks(spark, sf_dir), ["date", "index_name"])


@registered("row_count", f"""WITH {P}
SELECT index_name, count(*) AS rows FROM p GROUP BY ALL""")
def row_count(spark, sf_dir):
    return daily_series(spark, sf_dir).groupBy("index_name").agg(F.count(F.lit(1)).alias("rows"))


@registered("date_text", f"""WITH {P}
SELECT index_name, strftime(date, '%Y-%m-%d') AS day, strftime(date, '%Y%m%d') AS stamp FROM p""")
def date_text_query(spark, sf_dir):
    return daily_series(spark, sf_dir).select(
        "index_name", date_text("date").alias("day"), date_text("date", "yyyyMMdd").alias("stamp"))


# --- dashboard -----------------------------------------------------------------------------------

@registered("preview", f"""WITH {P}
SELECT date, index_name, index_value FROM p ORDER BY date, index_name LIMIT 1000""")
def preview(spark, sf_dir):
    return views.preview(daily_series(spark, sf_dir).drop("seq"), ["date", "index_name"])


@registered("chart_daily_value", f"WITH {P} SELECT date, index_name, index_value FROM p")
def chart_daily_value(spark, sf_dir):
    return views.chart_daily_value(daily_series(spark, sf_dir))


@registered("chart_daily_return", f"""WITH {P}
SELECT date, index_name, round(daily_return, 6) AS daily_return FROM pr""")
def chart_daily_return(spark, sf_dir):
    return views.chart_daily_return(daily_index_metrics(spark, sf_dir))


@registered("chart_weekly_value", f"""WITH {P}
SELECT date_trunc('week', date)::DATE AS week, index_name,
  round(avg(index_value), 6) AS avg_index_value FROM p GROUP BY ALL""")
def chart_weekly_value(spark, sf_dir):
    return views.chart_weekly_value(weekly_index_metrics(spark, sf_dir))


@registered("chart_weekly_return", f"""WITH {P}
SELECT date_trunc('week', date)::DATE AS week, index_name,
  round(avg(daily_return), 6) AS avg_daily_return FROM pr GROUP BY ALL""")
def chart_weekly_return(spark, sf_dir):
    return views.chart_weekly_return(weekly_index_metrics(spark, sf_dir))


@registered("chart_monthly_value", f"""WITH {P}
SELECT date_trunc('month', date)::DATE AS month, index_name,
  round(avg(index_value), 6) AS avg_index_value FROM p GROUP BY ALL""")
def chart_monthly_value(spark, sf_dir):
    return views.chart_monthly_value(daily_series(spark, sf_dir)).withColumn(
        "avg_index_value", r6("avg_index_value"))


@registered("chart_monthly_return", f"""WITH {P}
SELECT date_trunc('month', date)::DATE AS month, index_name,
  round(max(monthly_return), 6) AS monthly_return FROM pr GROUP BY ALL""")
def chart_monthly_return(spark, sf_dir):
    return views.chart_monthly_return(monthly_index_metrics(spark, sf_dir))


# --- SQL callers ---------------------------------------------------------------------------------

@registered("udf_sql_volatility", f"""WITH {P}, {weekly_performance_sql()}
SELECT week_start, index_name, volatility FROM wp""")
def udf_sql_volatility(spark, sf_dir):
    register_functions(spark)
    return spark.sql("SELECT week_start, index_name, calculate_volatility(prices) AS volatility "
                     "FROM {weekly}", weekly=rollups.weekly_price_arrays(priced(spark, sf_dir)))


@registered("udf_sql_normalize", f"""WITH {P}
SELECT date, index_name, coalesce(sign(index_value), 0)::DOUBLE AS rate,
  coalesce(sign(index_value - 250000), 0)::DOUBLE AS distance FROM p0""")
def udf_sql_normalize(spark, sf_dir):
    register_functions(spark)
    return spark.sql("SELECT date, index_name, normalize_exchange_rate(index_value) AS rate, "
                     "normalize_index_value(index_value - 250000) AS distance FROM {series}",
                     series=daily_series_with_gaps(spark, sf_dir))


@registered("sql_text_weekly", f"""WITH {P}
SELECT date_trunc('week', date)::DATE AS week, index_name,
  round(avg(index_value), 6) AS avg_index_value, round(avg(daily_return), 6) AS avg_daily_return
FROM pr GROUP BY 1, 2""")
def sql_text_weekly(spark, sf_dir):
    return spark.sql("""
        SELECT trunc(date, 'week') AS week, index_name, round(avg(index_value), 6) AS avg_index_value,
               round(avg(daily_return), 6) AS avg_daily_return
        FROM {raw} GROUP BY week, index_name""", raw=raw_series(spark, sf_dir))


# --- comparison ----------------------------------------------------------------------------------

@registered("return_correlation", f"""WITH {P}
SELECT a.index_name AS index_a, b.index_name AS index_b,
  round(corr(a.daily_return, b.daily_return), 6) AS correlation
FROM pr a JOIN pr b ON a.date = b.date AND a.index_name < b.index_name GROUP BY ALL""")
def return_correlation(spark, sf_dir):
    return comparison.return_correlation(raw_series(spark, sf_dir)).withColumn(
        "correlation", r6("correlation"))


@registered("rebased_comparison", f"""WITH {P}
SELECT date, index_name, round(100 * index_value / first_value(index_value) OVER (
  PARTITION BY index_name ORDER BY date), 6) AS rebased FROM p""")
def rebased_comparison(spark, sf_dir):
    return comparison.rebased(daily_series(spark, sf_dir), "index_value").select(
        "date", "index_name", r6("rebased"))


@registered("moving_average", f"""WITH {P}
SELECT date, index_name, round(avg(index_value) OVER (PARTITION BY index_name ORDER BY date
  ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS moving_average FROM p""")
def moving_average(spark, sf_dir):
    return comparison.moving_average(daily_series(spark, sf_dir), "index_value").select(
        "date", "index_name", r6("moving_average"))
