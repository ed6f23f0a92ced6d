"""Session factory and the settings every plan in this library relies on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Semantics, not tuning: clocks are compared in UTC and overflow is an error.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}


def session(master: str | None = None, partitions: int | None = None, **extra: str) -> SparkSession:
    """Return the active session or build one; `partitions` is the shuffle width for small runs."""
    builder = SparkSession.builder.appName("claimlens")
    if master:
        builder = builder.master(master)
    conf = {
        **REQUIRED,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    for key, value in (conf | extra).items():
        builder = builder.config(key, value)
    return ensure(builder.getOrCreate())


def ensure(spark: SparkSession) -> SparkSession:
    """Set what results depend on; leave every tuning knob to the cluster."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def small_batches(spark: SparkSession, rows: int = 256, size: int = 8 << 20) -> SparkSession:
    """Bound what a task holds outside the JVM's heap, for plans that hand texts to Python: rows and bytes of a batch, and
    the direct buffers that vectored Parquet reads cache for each of their threads.

    The bounds hold for the session from then on, as plans are lazy and read settings when they run. A bound that is
    already narrower stays.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(key, None)
        if now is None or not now.lstrip("-").isdecimal() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
    spark.conf.set("parquet.hadoop.vectored.io.enabled", "false")
    return spark


def spread(table: DataFrame, *key: str) -> DataFrame:
    """The table by its key over all shuffle partitions, for joins of two tables that grow together.

    Ids in order compress to a few bytes, and adaptive execution gathers partitions by compressed bytes: left to it, one
    task sorts millions of rows of each side. A number given by us is kept.
    """
    return table.repartition(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)
