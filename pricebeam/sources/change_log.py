"""A log of what changed in one table: a version per change, its rows in the columns version, op, before, after.

Each change writes its rows to a folder of its own and is published by one small marker file once the table has
it. Readers and streams go by the markers, so they meet every change once and whole. Writers of a table run one
after the other, as everywhere.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pricebeam.session import child_folders, on_filesystem, path_exists, remove_folder

#: Begins the tokens of whole replacements; the rest is the name of the version that they made.
REBUILD = "rebuild-"
_MARKER = re.compile(r"(\d{12})-(.+)")


class ChangeLog:
    def __init__(self, spark: SparkSession, place: str, row: T.StructType):
        self.spark, self.place = spark, place
        self.rows = T.StructType([T.StructField("op", T.StringType()), T.StructField("before", row),
                                  T.StructField("after", row)])

    @property
    def markers(self) -> str:
        """The folder that a stream follows; it exists after this."""
        path = f"{self.place}/published"
        files, folder = on_filesystem(self.spark, path)
        files.mkdirs(folder)
        return path

    def published(self) -> dict[str, int]:
        """Version by token, in the order of the versions."""
        files, folder = on_filesystem(self.spark, self.markers)
        found = [_MARKER.fullmatch(x.getPath().getName()) for x in files.listStatus(folder)]
        return {m[2]: int(m[1]) for m in sorted((m for m in found if m), key=lambda m: m[1])}

    def record(self, changes: DataFrame, token: str) -> None:
        """Write the rows of a change that is about to be made. A change that was published stays as it is:
        its table has it, and a repetition finds nothing to change."""
        if token not in self.published():
            changes.select("op", "before", "after").write.mode("overwrite").parquet(self._folder(token))

    def publish(self, token: str) -> None:
        """The table has the change now. A change without rows, or one published before, adds no version."""
        known = self.published()
        if token in known or not path_exists(self.spark, f"{self._folder(token)}/_SUCCESS"):
            return
        if self.spark.read.schema(self.rows).parquet(self._folder(token)).isEmpty():
            remove_folder(self.spark, self._folder(token))
            return
        name = f"{max(known.values(), default=0) + 1:012d}-{token}"
        files, draft = on_filesystem(self.spark, f"{self.markers}/.{name}")
        out = files.create(draft, True)
        out.write(bytearray(name.encode()))
        out.close()
        # A marker appears whole: streams pass over names that begin with a dot.
        if not files.rename(draft, on_filesystem(self.spark, f"{self.markers}/{name}")[1]):
            raise OSError(f"{name} could not be published")

    def settle(self, current: str) -> None:
        """Finish what a replacement that died left: publish it if its version is current, else forget it."""
        known = self.published()
        for folder in child_folders(self.spark, f"{self.place}/changes"):
            token = folder.rsplit("/", 1)[-1]
            if not token.startswith(REBUILD) or token in known:
                continue
            if token == REBUILD + current:
                self.publish(token)
            else:
                remove_folder(self.spark, folder)

    def read(self, versions: dict[str, int] | None = None) -> DataFrame:
        """The rows of these versions, or of all."""
        versions = self.published() if versions is None else versions
        if not versions:
            return self.spark.createDataFrame([], T.StructType([T.StructField("version", T.LongType()), *self.rows]))
        rows = self.spark.read.schema(self.rows).parquet(*map(self._folder, versions)).withColumn(
            "_token", F.element_at(F.split("_metadata.file_path", "/"), -2))
        numbers = self.spark.createDataFrame([*versions.items()], "_token string, version long")
        return rows.join(numbers, "_token").select("version", "op", "before", "after")

    def trim(self, before: int) -> int:
        """Forget the versions below `before`, once all readers have them; how many went. The newest version
        stays, since the next one is counted from it."""
        known = self.published()
        old = {t: n for t, n in known.items() if n < min(before, max(known.values(), default=0))}
        for token, number in old.items():
            files, marker = on_filesystem(self.spark, f"{self.markers}/{number:012d}-{token}")
            files.delete(marker, False)
            remove_folder(self.spark, self._folder(token))
        return len(old)

    def _folder(self, token: str) -> str:
        return f"{self.place}/changes/{token}"
