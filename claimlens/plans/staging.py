"""Tables written to the cluster's shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where it is unset and Spark runs in one process (tests), one of our own.

    On a cluster executors do not see folders of the driver's machine, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="claimlens-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


class Staging:
    """A folder of intermediate tables; each is written once and read back by plans that follow."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_at = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table that no later plan reads."""
        path = getattr(df, "_staged_at", None)
        if path:
            jvm = self.spark._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
