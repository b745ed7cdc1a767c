"""Which batches of a stream have been begun and which are done."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from arborload.sources.scratch import exists


class Ledger:
    """Notes of one state folder; each note is a small file that is written once.

    A stream repeats a batch with the same number if it failed, or if the program died
    after the batch was done but before the stream noted it.  The ledger tells the two
    apart, and keeps the tag with which a broken batch has marked its rows.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def is_done(self, number: int) -> bool:
        return exists(self.spark, f"{self._path('done', number)}/_SUCCESS")

    def begun(self, number: int) -> str | None:
        """Tag of the rows that an earlier attempt at this batch may have written."""
        path = self._path("begun", number)
        if not exists(self.spark, f"{path}/_SUCCESS"):
            return None
        return self.spark.read.schema("tag string").parquet(path).first()[0]

    def begin(self, number: int, tag: str) -> None:
        self._note("begun", number, tag)

    def done(self, number: int, tag: str) -> None:
        self._note("done", number, tag)

    def _note(self, kind: str, number: int, tag: str) -> None:
        note = self.spark.range(1).select(F.lit(tag).alias("tag"))
        note.write.mode("overwrite").parquet(self._path(kind, number))

    def _path(self, kind: str, number: int) -> str:
        return f"{self.folder}/{kind}/{number:09d}"
