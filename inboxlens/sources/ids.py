"""Index of the ids in a message table, bucketed by the hash of the id.

The buckets are those of Spark's own shuffle hash, so a join on the id reads the index where it lies:
only the batch is shuffled, to the index's buckets, whatever the index has grown to.

The index follows the message table.  A note written before messages are appended, and removed after
their ids are, names the days in question; a later run that finds one brings the index up to date
from those days' partitions.  A missing index is built from the whole table.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inboxlens.sources import files, tables

#: Buckets of a new index; one join task each, so about one for every ten million ids.
BUCKETS = 32
_EVERY_DAY = "every day"


def _folder(messages_path: str, buckets: int) -> str:
    return f"{messages_path.rstrip('/')}_ids/{buckets}"


def _note(messages_path: str, buckets: int) -> str:
    return f"{_folder(messages_path, buckets)}_open"


def _table(spark: SparkSession, messages_path: str, buckets: int) -> str:
    """The name under which the session's catalog knows the index."""
    folder = _folder(messages_path, buckets)
    name = f"landed_ids_{hashlib.sha256(folder.encode()).hexdigest()[:20]}"
    quoted = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (message_id STRING) USING parquet "
        f"CLUSTERED BY (message_id) SORTED BY (message_id) INTO {buckets} BUCKETS LOCATION '{quoted}'"
    )
    spark.catalog.refreshTable(name)
    return name


def read(spark: SparkSession, messages_path: str, buckets: int = BUCKETS) -> DataFrame:
    """The landed ids, as :func:`repair` and :func:`append` left them."""
    return spark.table(_table(spark, messages_path, buckets))


def _add(ids: DataFrame, messages_path: str, buckets: int) -> None:
    name = _table(ids.sparkSession, messages_path, buckets)
    # one task and one file a bucket, because the shuffle's hash is the bucket's
    dealt = ids.select("message_id").repartition(buckets, "message_id")
    dealt.write.mode("append").insertInto(name)


def repair(spark: SparkSession, messages_path: str, buckets: int = BUCKETS) -> None:
    """Bring the index up to date after a run that ended between messages and ids."""
    note = _note(messages_path, buckets)
    said = files.read(spark, note)
    if said is None:
        if files.exists(spark, _folder(messages_path, buckets)):
            return
        said = _EVERY_DAY
        files.create(spark, note, said)
    messages = tables.read_messages(spark, messages_path)
    if messages is not None:
        if said != _EVERY_DAY:
            first, last = (dt.date.fromisoformat(d) for d in json.loads(said))
            messages = messages.filter(F.col("received_date").between(F.lit(first), F.lit(last)))
        missing = (
            messages.select("message_id")
            .distinct()
            .join(read(spark, messages_path, buckets), "message_id", "left_anti")
        )
        _add(missing, messages_path, buckets)
    files.drop(spark, note)


def opened(
    spark: SparkSession, messages_path: str, first: dt.date, last: dt.date, buckets: int = BUCKETS
) -> None:
    """Note that messages of these days are about to be appended."""
    note = _note(messages_path, buckets)
    files.drop(spark, note)  # repaired before, so it says nothing any more
    files.create(spark, note, json.dumps([first.isoformat(), last.isoformat()]))


def append(ids: DataFrame, messages_path: str, buckets: int = BUCKETS) -> None:
    """Add the ids of the messages just appended and close the note."""
    _add(ids, messages_path, buckets)
    files.drop(ids.sparkSession, _note(messages_path, buckets))
