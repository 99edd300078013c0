"""Table layouts on Parquet: one partition per day, clustered rows inside.

Writes go through one ``REBALANCE`` shuffle.  Adaptive execution then splits a hot day into
several files and merges thin ones, so no day is bound to one task and no pass over the data
is spent on sampling.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inboxlens.functions.clock import from_micros, instant
from inboxlens.schemas import APPLICATIONS, EMAIL_MART, LEDGER, MESSAGES, META, QUARANTINE
from inboxlens.sources import layout

_SETTLED = T.StructType([T.StructField("batch", T.LongType())])
_START = T.StructType([T.StructField("sync_start", T.TimestampType())])


def read_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The Parquet table at ``path``, or None where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_messages(spark: SparkSession, path: str) -> DataFrame | None:
    """Message table with its partition column ``received_date``; None before the first append."""
    found = layout.folders(spark, path)
    return messages_in(spark, path, found) if found else None


def messages_in(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """The rows of some folders of the message table."""
    schema = _with_day(MESSAGES, "received_date")
    versioned = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    return spark.read.schema(versioned).option("basePath", path).parquet(*folders).drop("version")


def read_messages_or_empty(spark: SparkSession, path: str) -> DataFrame:
    found = read_messages(spark, path)
    return spark.createDataFrame([], _with_day(MESSAGES, "received_date")) if found is None else found


def append_messages(messages: DataFrame, path: str) -> None:
    """Append staged rows to the message table: day of receipt, then sender and thread.

    Staging has already dealt the rows out by day, so bodies are not shuffled again.
    """
    known = [c for c in messages.columns if c in MESSAGES.fieldNames()]
    dated = messages.select(*known, _day(F.col("received_at")).alias("received_date"))
    dated.sortWithinPartitions("received_date", "sender", "thread_id").write.mode(
        "append"
    ).partitionBy("received_date").parquet(layout.open_folder(messages.sparkSession, path))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """Run ledger with its partition column ``started_date``."""
    return read_or_none(spark, path, _with_day(LEDGER, "started_date"))


def append_ledger(rows: DataFrame, path: str) -> None:
    """Append ledger rows, one per window outcome; never updated afterwards."""
    shaped = rows.select(*(F.col(f.name).cast(f.dataType) for f in LEDGER.fields))
    dated = shaped.withColumn("started_date", F.to_date("started_at"))
    ordered = dated.coalesce(1).sortWithinPartitions("started_date", "status", "run_id")
    ordered.write.mode("append").partitionBy("started_date").parquet(path)


def read_start(spark: SparkSession, ledger_path: str) -> dt.datetime | None:
    """Where the first sync into this ledger began, if it was noted."""
    note = read_or_none(spark, f"{ledger_path}_start", _START)
    row = None if note is None else note.agg(F.min(F.unix_micros("sync_start"))).first()
    return None if row is None or row[0] is None else from_micros(row[0])


def write_start(spark: SparkSession, ledger_path: str, start: dt.datetime) -> None:
    """Note where the first sync into this ledger begins; the earliest note counts."""
    note = spark.range(1).select(instant(start).alias("sync_start"))
    note.write.mode("append").parquet(f"{ledger_path}_start")


def read_settled(spark: SparkSession, ledger_path: str) -> int:
    """The newest batch of staged rows that a finished run has dealt with; -1 before the first."""
    note = read_or_none(spark, f"{ledger_path}_landing/settled", _SETTLED)
    newest = None if note is None else note.agg(F.max("batch")).first()[0]
    return -1 if newest is None else newest


def write_settled(spark: SparkSession, ledger_path: str, batch: int) -> None:
    note = spark.range(1).select(F.lit(batch).cast("bigint").alias("batch"))
    note.write.mode("append").parquet(f"{ledger_path}_landing/settled")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame | None:
    return read_or_none(spark, path, QUARANTINE)


def append_quarantine(rows: DataFrame, path: str) -> None:
    rows.select(*QUARANTINE.fieldNames()).write.mode("append").parquet(path)


def read_email_mart(spark: SparkSession, path: str) -> DataFrame:
    """Email mart with its declared schema, which an empty mart has too."""
    return spark.read.schema(_with_day(EMAIL_MART, "received_date")).parquet(path)


def read_applications(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_with_day(APPLICATIONS, "latest_status_date")).parquet(path)


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(META).parquet(path)


def write_email_mart(mart: DataFrame, path: str) -> None:
    """Replace the email mart: day of receipt, then category and sender."""
    _day_layout(
        mart,
        "received_at",
        "received_date",
        ["job_pipeline_category", "sender"],
        spread=["job_pipeline_category"],
    ).write.mode("overwrite").partitionBy("received_date").parquet(path)


def write_applications(apps: DataFrame, path: str) -> None:
    """Replace the application mart: day of latest status, then outcome and company."""
    _day_layout(
        apps,
        "latest_status_at",
        "latest_status_date",
        ["outcome", "company"],
        spread=["outcome"],
    ).write.mode("overwrite").partitionBy("latest_status_date").parquet(path)


def write_meta(meta: DataFrame, path: str) -> None:
    """Replace the one-row meta table."""
    meta.coalesce(1).write.mode("overwrite").parquet(path)


def _with_day(schema: T.StructType, day: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(day, T.DateType())])


def _day_layout(
    df: DataFrame, at: str, day: str, cluster: list[str], spread: list[str] | None = None
) -> DataFrame:
    dated = df.withColumn(day, _day(F.col(at)))
    return dated.hint("rebalance", day, *(spread or [])).sortWithinPartitions(day, *cluster)


def _day(at: Column) -> Column:
    return F.to_date(at)
