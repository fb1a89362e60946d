"""Weekly averages that late rows correct: any order of arrival gives the averages of all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pricebeam.streaming import weekly_corrected
from pricebeam.streaming.weekly import weekly_average_stream
from pricebeam.streaming.weekly_corrected import CorrectedWeeks

SCHEMA = "ts timestamp, index_name string, index_value double, event_id long, note string"
START = dt.datetime(2024, 1, 1)            # a Monday
DAY = dt.timedelta(days=1)


def tick(day, name, value, number, note=None):
    return START + day * DAY, name, value, number, note


class Feed:
    """Lands batches of ticks and drains them."""

    def __init__(self, spark, scratch, **options):
        self.spark, self.landing, self.checkpoint, self.count = spark, scratch("landing"), scratch("checkpoint"), 0
        self.weeks = CorrectedWeeks(spark, scratch("weeks"), **options)

    def land(self, ticks):
        self.spark.createDataFrame(ticks, SCHEMA).coalesce(1).write.parquet(f"{self.landing}/{self.count}")
        self.count += 1

    def drain(self):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.landing}/*")
        return self.weeks.drain(stream, self.checkpoint)

    def late(self):
        columns = self.spark.createDataFrame([], SCHEMA).schema
        return sorted((x.event_id, x.batch) for x in self.weeks.late(columns).collect())


def rows(df):
    return {(x.week, x.index_name): x.avg_index_value and round(x.avg_index_value, 9) for x in df.collect()}


def test_a_late_tick_corrects_its_week(spark, scratch):
    feed = Feed(spark, scratch)
    assert feed.weeks.closed().collect() == [] and feed.late() == []
    feed.land([tick(0, "a", 1., 1), tick(3, "a", 3., 2), tick(6.9, "b", 5., 3)])
    assert feed.drain() == {"batches": 1, "ticks": 3, "late": 0}
    assert feed.weeks.closed().collect() == []
    feed.land([tick(7.9, "a", 9., 4)])                          # not yet a day after the week's end
    feed.drain()
    assert feed.weeks.closed().collect() == []
    feed.land([tick(8, "a", 11., 5), tick(5, "a", 5., 6)])      # closes the week; with it a tick in time
    assert feed.drain()["late"] == 0
    monday, week = START.date(), dt.date(2024, 1, 8)
    assert rows(feed.weeks.closed()) == {(monday, "a"): 3., (monday, "b"): 5.}
    feed.land([tick(1, "a", 7., 7), tick(1, "a", 7., 7), tick(3, "a", 3., 2), tick(8, "a", 0., 8)])
    assert feed.drain() == {"batches": 1, "ticks": 2, "late": 1}
    assert rows(feed.weeks.closed()) == {(monday, "a"): 4., (monday, "b"): 5.}
    assert {(x.index_name, x.late_rows) for x in feed.weeks.closed().collect()} == {("a", 1), ("b", 0)}
    assert feed.late() == [(7, 3)]
    assert feed.drain() == {"batches": 0, "ticks": 0, "late": 0}
    feed.land([tick(15, "b", 1., 9)])
    feed.drain()
    assert rows(feed.weeks.closed())[week, "a"] == pytest.approx(20 / 3)


def test_nulls_and_ticks_without_a_time(spark, scratch):
    feed = Feed(spark, scratch)
    feed.land([tick(0, None, 1., 1), tick(0, None, 1., 1), tick(0, "a", None, None), (None, "a", 5., 2, None)])
    feed.land([tick(0, None, 1., 1), tick(0, "a", None, None), tick(9, "a", 1., 3)])
    feed.land([])
    done = feed.drain()
    assert done["ticks"] == 3 and done["late"] == 0
    assert rows(feed.weeks.closed()) == {(START.date(), None): 1., (START.date(), "a"): None}


@pytest.mark.parametrize("seed", [1, 2])
def test_shuffled_arrival_equals_the_batch_result(spark, scratch, seed):
    rng = random.Random(seed)
    ticks = [tick(rng.uniform(0, 30), rng.choice("abc"), float(rng.randrange(100)), n) for n in range(200)]
    arrived = ticks + rng.sample(ticks, 60)
    rng.shuffle(arrived)
    feed, met, newest, late = Feed(spark, scratch), set(), None, 0
    for at in range(0, 260, 65):
        batch = arrived[at:at + 65]
        feed.land(batch)
        fresh = [t for t in dict.fromkeys(batch) if t not in met]
        ends = [START + 7 * DAY * ((t[0] - START) // (7 * DAY) + 1) for t in fresh]
        late += sum(newest is not None and end <= newest - DAY for end in ends)
        met |= set(batch)
        newest = max(t[0] for t in met)
    done = feed.drain()
    assert done == {"batches": 4, "ticks": 200, "late": late} and late
    whole = rows(weekly_average_stream(spark.createDataFrame(ticks, SCHEMA)))
    assert rows(feed.weeks.closed()) == {k: v for k, v in whole.items()
                                         if dt.datetime.combine(k[0], dt.time()) + 8 * DAY <= newest}
    assert sum(x.late_rows for x in feed.weeks.closed().collect()) == late == len(feed.late())


@pytest.mark.parametrize("dies_after", ["ticks", "new-ticks", "marks"])
def test_a_batch_that_dies_counts_once(spark, scratch, monkeypatch, dies_after):
    feed = Feed(spark, scratch)
    feed.land([tick(0, "a", 1., 1), tick(9, "a", 2., 2)])
    feed.drain()
    feed.land([tick(1, "a", 4., 3), tick(1, "a", 4., 3), tick(0, "a", 1., 1), tick(17, "a", 6., 4)])
    write, remove = weekly_corrected.written, weekly_corrected.discard

    def lost(df, label):
        done = write(df, label)
        if label == dies_after:
            raise RuntimeError("lost")
        return done

    def lost_at_end(spark, path):
        raise RuntimeError("lost")

    monkeypatch.setattr(weekly_corrected, "written", lost)
    if dies_after == "marks":
        monkeypatch.setattr(weekly_corrected, "discard", lost_at_end)
    with pytest.raises(Exception, match="lost"):
        feed.drain()
    monkeypatch.setattr(weekly_corrected, "written", write)
    monkeypatch.setattr(weekly_corrected, "discard", remove)
    assert feed.drain() == {"batches": 1, "ticks": 2, "late": 1}
    assert rows(feed.weeks.closed()) == {(START.date(), "a"): 2.5, (dt.date(2024, 1, 8), "a"): 2.}
    assert feed.late() == [(3, 1)]


def test_averages_leave_out_missing_values_only(spark, scratch):
    feed = Feed(spark, scratch, lateness=dt.timedelta(hours=1), keys=("ts", "index_name"))
    feed.land([tick(0, "a", None, 1), tick(0, "a", 2., 2), tick(1, "a", 4., 3), tick(8, "a", 1., 4)])
    feed.drain()
    # Of the two ticks with one key that with the smallest values counts, and a missing one is smallest.
    assert rows(feed.weeks.closed()) == {(START.date(), "a"): 4.}
