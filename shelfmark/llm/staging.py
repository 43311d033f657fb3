"""Tables written between steps, so that a lost executor costs a re-read and not a recomputation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfmark.session import file_system, shared_folder


class Scratch:
    """The staged tables of one run of an operator, removed together when its result is written."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written as Parquet in the shared folder and read back with its schema."""
        path = f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, keep: int = 0) -> None:
        """Delete the staged tables but the last ``keep`` ones; none of those deleted may be read any more."""
        gone = self.paths[: len(self.paths) - keep]
        for path in gone:
            system, place = file_system(self.spark, path)
            system.delete(place, True)
        del self.paths[: len(gone)]


def staged(df: DataFrame, name: str) -> DataFrame:
    """A staged table that stays, as lazy results are read from it."""
    return Scratch(df.sparkSession).staged(df, name)
