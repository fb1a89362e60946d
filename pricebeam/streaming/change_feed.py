"""The changes of a logged table as a stream that each checkpoint consumes once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricebeam.schemas import TableSpec
from pricebeam.sources.files import FILE_AGE
from pricebeam.sources.tables import Layers, change_log
from pricebeam.streaming.refresh import batch_token, drain


def drain_changes(spark: SparkSession, layers: Layers, spec: TableSpec, checkpoint: str,
                  process: Callable[[DataFrame, str], None], versions_per_batch: int = 100) -> int:
    """Hand every change since the checkpoint to `process`, inserts, updates and deletes alike, as rows of
    (version, op, before, after) with a token that names the batch; how many versions there were.

    A batch that dies comes again with the same rows and the same token. Only the names of the versions, one
    line each, pass through the driver; `versions_per_batch` bounds them.
    """
    log, seen = change_log(spark, layers, spec), 0

    def hand_over(batch: DataFrame, batch_id: int) -> None:
        nonlocal seen
        names = [x.value.split("-", 1) for x in batch.collect()]
        if names:
            process(log.read({token: int(number) for number, token in names}), batch_token(spark, checkpoint, batch_id))
            seen += len(names)

    markers = (spark.readStream.option("maxFileAge", FILE_AGE).option("maxFilesPerTrigger", versions_per_batch)
               .text(log.markers))
    drain(markers, checkpoint, hand_over)
    return seen
