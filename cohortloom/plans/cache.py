"""Results kept by the fingerprint of what they were computed from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortloom.sources.writers import fingerprint


class ResultCache:
    """A folder of Parquet results; a result is taken from there only if stage, parameters and inputs are the same."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.hits = self.misses = 0

    def path(self, stage: str, parameters: dict, inputs: dict[str, str]) -> str:
        return f"{self.folder}/{stage}/{fingerprint(stage, parameters, inputs)}"

    def _complete(self, path: str) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)

    def get(self, stage: str, parameters: dict, inputs: dict[str, str], make: Callable[[], DataFrame]) -> DataFrame:
        """The kept result, or that of ``make``, written first; a write that was cut short counts as none."""
        path = self.path(stage, parameters, inputs)
        if self._complete(path):
            self.hits += 1
        else:
            self.misses += 1
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)
