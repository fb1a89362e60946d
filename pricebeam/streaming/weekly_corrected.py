"""Weekly averages on a stream in which no row is lost, however late: a row of a closed week corrects it.

Three folders hold the state, each with a part per batch, so a batch writes only its own and a repeated batch
replaces it: the keys of the ticks met so far, by week; sums per week and index; the late rows. An average is the
sum of a week's parts, so a correction rewrites nothing that a reader may be reading.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pricebeam.operators.changes import same_key
from pricebeam.session import child_folders, discard, path_exists, remove_folder, written
from pricebeam.streaming.refresh import drain
from pricebeam.streaming.weekly import MONDAY_OFFSET, monday

SUMS = "week date, index_name string, week_end timestamp, total double, n long, rows long, late long, batch long"
MARK = "seen timestamp"


class CorrectedWeeks:
    """`place` is a folder of its own for each stream of ticks (ts, index_name, index_value and further columns).

    A tick with keys that were met before counts for nothing, be it in the same batch or years later; of ticks
    with the same keys in one batch the one with the smallest values counts. A week is closed once a tick
    `lateness` after its end has come. Ticks without a time belong to no week and go.
    """

    def __init__(self, spark: SparkSession, place: str, lateness: dt.timedelta = dt.timedelta(days=1),
                 keys: tuple[str, ...] = ("ts", "index_name", "event_id")):
        self.spark, self.place, self.lateness, self.keys = spark, place, lateness, keys

    def drain(self, ticks: DataFrame, checkpoint: str) -> dict[str, int]:
        """Take in all that is new; the numbers of batches, of new ticks, and of those that came late."""
        counts = {"batches": 0, "ticks": 0, "late": 0}

        def process(batch: DataFrame, batch_id: int) -> None:
            new, late = self._take(batch, batch_id)
            for name, number in zip(counts, (1, new, late)):
                counts[name] += number

        drain(ticks, checkpoint, process)
        return counts

    def closed(self) -> DataFrame:
        """Closed weeks as of now: week, index_name, avg_index_value, and how many of its ticks came late."""
        seen = self._seen()
        sums = self._read("sums", T.StructType.fromDDL(SUMS))
        done = F.col("week_end") <= F.lit(seen - self.lateness) if seen else F.lit(False)
        return sums.filter(done).groupBy("week", "index_name").agg(
            F.try_divide(F.sum("total"), F.sum("n")).alias("avg_index_value"), F.sum("late").alias("late_rows"))

    def late(self, columns: T.StructType) -> DataFrame:
        """The ticks that came after their week was closed, with their `batch`; `columns` are those of the ticks."""
        return self._read("late", T.StructType([*columns, T.StructField("batch", T.LongType())]))

    def _take(self, batch: DataFrame, batch_id: int) -> tuple[int, int]:
        values = [c for c in batch.columns if c not in self.keys]
        unique = batch.groupBy(*self.keys).agg(F.min(F.struct(*values)).alias("_values")).select(
            *self.keys, *[F.col("_values")[c].alias(c) for c in values])
        arrived, path = written(unique.select(*batch.columns, F.window("ts", "1 week", startTime=MONDAY_OFFSET).alias("_w"))
                                .select(*batch.columns, monday(F.col("_w.start")).alias("_week"),
                                        F.col("_w.end").alias("_end")), "ticks")
        seen = self._seen(batch_id)
        late = F.col("_end") <= F.lit(seen - self.lateness) if seen else F.lit(False)
        # A calendar list: a batch touches few weeks, however many ticks it has.
        weeks = [x[0] for x in arrived.select("_week").distinct().collect()]
        new, new_path = written(self._unmet(arrived, weeks, batch_id).withColumn("_late", late), "new-ticks")
        (new.select(*self.keys, F.col("_week").alias("week"), F.lit(batch_id).alias("batch")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("week", "batch").parquet(f"{self.place}/keys"))
        sums = new.groupBy(F.col("_week").alias("week"), "index_name", F.col("_end").alias("week_end")).agg(
            F.sum("index_value").alias("total"), F.count("index_value").alias("n"), F.count(F.lit(1)).alias("rows"),
            F.count_if("_late").alias("late"))
        sums.write.mode("overwrite").parquet(f"{self.place}/sums/batch={batch_id}")
        new.filter("_late").select(*batch.columns).write.mode("overwrite").parquet(f"{self.place}/late/batch={batch_id}")
        newest = arrived.agg(F.greatest(F.max("ts"), F.lit(seen).cast("timestamp")).alias("seen"))
        newest.write.mode("overwrite").parquet(f"{self.place}/marks/{batch_id:012d}")
        for old in child_folders(self.spark, f"{self.place}/marks"):
            # The mark before this batch stays: the batch may be repeated.
            if int(old.rsplit("/", 1)[-1]) < batch_id - 1:
                remove_folder(self.spark, old)
        counted = self.spark.read.schema(T.StructType.fromDDL(SUMS)).parquet(f"{self.place}/sums/batch={batch_id}").agg(
            F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("late"), F.lit(0))).first()
        discard(self.spark, path)
        discard(self.spark, new_path)
        return counted[0], counted[1]

    def _unmet(self, arrived: DataFrame, weeks: list[dt.date], batch_id: int) -> DataFrame:
        """Ticks whose keys no earlier batch had. Only the touched weeks of earlier batches are read."""
        folders = [f for f in (f"{self.place}/keys/week={week}" for week in weeks) if path_exists(self.spark, f)]
        if not folders:
            return arrived
        stored = T.StructType([arrived.schema[k] for k in self.keys]).add("batch", T.LongType())
        met = (self.spark.read.schema(stored).option("basePath", f"{self.place}/keys").parquet(*folders)
               .filter(F.col("batch") < batch_id).select(*[F.col(k).alias(f"_met_{k}") for k in self.keys]))
        return arrived.join(met, same_key(self.keys, "_met_"), "left_anti")

    def _seen(self, before: int | None = None) -> dt.datetime | None:
        """The newest time of all batches, or of those before one."""
        marks = [m for m in child_folders(self.spark, f"{self.place}/marks") if path_exists(self.spark, f"{m}/_SUCCESS")
                 and (before is None or int(m.rsplit("/", 1)[-1]) < before)]
        return self.spark.read.schema(MARK).parquet(marks[-1]).first()["seen"] if marks else None

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        if not child_folders(self.spark, f"{self.place}/{part}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.place}/{part}")
