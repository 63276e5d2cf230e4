"""Tables written between the jobs of an operator.

They lie below the folder that the cluster names in ``spark.checkpoint.dir``, so a job
that loses executors reads them again instead of computing them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.settings import fresh_folder


class Scratch:
    """A folder of intermediate tables. ``drop`` those that no later frame reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = fresh_folder(spark, name)
        self._count = 0

    def store(self, frame: DataFrame, name: str) -> DataFrame:
        self._count += 1
        path = f"{self.root}/{self._count}-{name}"
        frame.write.parquet(path)
        stored = self.spark.read.schema(frame.schema).parquet(path)
        stored.scratch_path = path
        return stored

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark._jvm
        for frame in frames:
            path = jvm.org.apache.hadoop.fs.Path(frame.scratch_path)
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def most_frequent(counts: DataFrame, count: str, limit: int) -> DataFrame:
    """Rows whose count reaches the lowest power of two that at most ``limit`` rows reach.

    One small aggregate finds the threshold, so no row is sorted, and the result has at
    most ``limit`` rows whatever the size of the input.
    """
    power = F.floor(F.log2(count)).cast("int")
    found = counts.groupBy(power.alias("p")).count().collect()
    total, least = 0, 64
    for p, rows in sorted(((r["p"], r["count"]) for r in found), reverse=True):
        total += rows
        if total > limit:
            break
        least = p
    return counts.where(F.col(count) >= F.lit(2**least if least < 63 else 2**63 - 1))
