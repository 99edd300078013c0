"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Set the two runtime options the results and the layout depend on.

    Day and week boundaries are UTC boundaries, and timestamps are written in a form that
    carries min/max statistics, so that filters on them can skip row groups.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster or the caller names it.

    ``spark.checkpoint.dir`` is read from the session; where it is unset, the checkpoint folder
    given to the context counts.  Without either the job is refused: a folder of the driver's own
    machine is not visible to the executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")
