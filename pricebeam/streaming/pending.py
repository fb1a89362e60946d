"""What has arrived but is not derived yet.

Every batch notes the keys of its rows as one part of a log beside the harmonized table. A refresh derives
the noted keys that its `as_of` has reached, whichever batch or series they came with, and notes the others
again. So what waits is known from the log alone: not from the newest derived day, which one series may
have reached long before another, and not from whether a new file came.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricebeam.session import child_folders, path_exists, remove_folder
from pricebeam.sources.tables import Layers

KEYS = "date date, index_name string"
FROZEN = f"{KEYS}, token string, as_of date"

#: Derives the keys (date, index_name) up to a day; the token names the change.
Derive = Callable[[DataFrame, dt.date, str], None]


class PendingKeys:
    def __init__(self, spark: SparkSession, layers: Layers):
        self.spark = spark
        self.place = f"{spark.catalog.getDatabase(layers.database('harmonized')).locationUri}/pending_keys"
        self.frozen = f"{self.place}/deriving"

    def note(self, keys: DataFrame, token: str) -> None:
        """Add the keys of one batch. Repeating a batch replaces its part."""
        keys.select("date", "index_name").distinct().write.mode("overwrite").parquet(f"{self.place}/parts/{token}")

    def _parts(self) -> list[str]:
        return [p for p in child_folders(self.spark, f"{self.place}/parts") if path_exists(self.spark, f"{p}/_SUCCESS")]

    def waiting(self) -> DataFrame:
        """All keys noted and not derived."""
        parts = self._parts()
        if not parts:
            return self.spark.createDataFrame([], KEYS)
        return self.spark.read.schema(KEYS).parquet(*parts).distinct()

    def derive(self, as_of: dt.date, work: Derive) -> int:
        """Derive all keys noted up to `as_of`; the number of keys.

        The keys are frozen under a token first. If a run dies half way, the next one finishes that change
        under its own token, which repairs months that were being replaced, and then starts over with all
        that is noted: rows that came in between are not taken for derived. Keys leave the log last.
        """
        if path_exists(self.spark, f"{self.frozen}/_SUCCESS"):
            keys = self._read_frozen()
            first = keys.first()
            if first is not None:
                work(keys.select("date", "index_name"), first["as_of"], first["token"])
            remove_folder(self.spark, self.frozen)
        parts = self._parts()
        if not parts:
            return 0
        token, noted = uuid.uuid4().hex, self.spark.read.schema(KEYS).parquet(*parts).distinct()
        (noted.filter(F.col("date") <= as_of).withColumns({"token": F.lit(token), "as_of": F.lit(as_of)})
         .write.mode("overwrite").parquet(self.frozen))
        keys = self._read_frozen()
        count = keys.count()
        if count:
            work(keys.select("date", "index_name"), as_of, token)
            rest = noted.filter(F.col("date") > as_of)
            if not rest.isEmpty():
                self.note(rest, f"rest-{token}")
            for part in parts:
                remove_folder(self.spark, part)
        remove_folder(self.spark, self.frozen)
        return count

    def _read_frozen(self) -> DataFrame:
        return self.spark.read.schema(FROZEN).parquet(self.frozen)
