"""Sync as a stream: new landing files in, message rows and ledger rows out.

The checkpoint remembers which files were read, which replaces the watermark, so mail that
lands late is picked up too.  De-duplication stays an anti-join against the message table:
no state grows with the mailbox, and a replayed micro-batch inserts nothing.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inboxlens.functions.clock import from_micros
from inboxlens.operators import ingest
from inboxlens.plans import sync
from inboxlens.session import prepare, shared_folder
from inboxlens.sources import files, ids, landing, lease, tables

_SECOND = dt.timedelta(seconds=1)


def start(
    spark: SparkSession,
    landing_path: str,
    targets: sync.Targets,
    checkpoint: str,
    *,
    days: int = 1,
    predicate: Callable[[Column], Column] | None = landing.in_inbox,
    max_files_per_trigger: int | None = None,
    max_body_chars: int = landing.MAX_BODY_CHARS,
    depth: int = landing.FIRST_DEPTH,
) -> StreamingQuery:
    """Process all files that are there and stop (``availableNow``).

    Ledger rows are written per micro-batch and window that holds mail.  Keep this ledger
    apart from that of :func:`inboxlens.plans.sync.run`: late files reach behind a watermark.
    """
    prepare(spark)
    run_id = uuid.uuid4().hex
    scratch = f"{shared_folder(spark)}/stream-{run_id}"
    options = {} if max_files_per_trigger is None else {"maxFilesPerTrigger": max_files_per_trigger}

    def write(batch: DataFrame, batch_id: int) -> None:
        started_at = dt.datetime.now(dt.timezone.utc)
        folder = f"{scratch}/{batch_id}"
        try:
            batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
            staged = landing.stage(
                landing.lines_of(batch),
                f"{folder}/rows",
                ingested_at=started_at,
                max_body_chars=max_body_chars,
                depth=depth,
                predicate=predicate,
                dated_only=True,
            )
            batch_key = f"{checkpoint.rstrip('/').rsplit('/', 1)[-1]}-{batch_id}"
            with lease.held(batch.sparkSession, targets.messages, batch_key):
                _commit(staged, targets, folder, batch_key, started_at, days)
        finally:
            files.drop(batch.sparkSession, folder)

    return (
        landing.arriving(spark, landing_path, **options)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _commit(
    staged: DataFrame,
    targets: sync.Targets,
    folder: str,
    batch_key: str,
    started_at: dt.datetime,
    days: int,
) -> None:
    """Commit one micro-batch; its ledger rows carry the batch's key as run id.

    A batch replayed after its ledger rows were written finds them and adds none.
    """
    spark = staged.sparkSession
    sync.append_quarantine(staged, targets)
    ids.repair(spark, targets.messages)
    ledger = tables.read_ledger(spark, targets.ledger)
    if ledger is not None and not ledger.filter(F.col("run_id") == batch_key).isEmpty():
        return
    at = F.unix_micros("received_at")
    oldest, newest = landing.messages_of(staged).agg(F.min(at), F.max(at)).first()
    if oldest is None:
        return  # no mail; the bad lines of the batch are kept
    lo = from_micros(oldest).replace(hour=0, minute=0, second=0, microsecond=0)
    hi = from_micros(newest).replace(microsecond=0) + _SECOND
    spans = (
        ingest.assign_window(landing.messages_of(staged).select("received_at"), lo, hi, days=days)
        .select("sync_start", "sync_end")
        .distinct()
    )
    waiting = staged.withColumn("batch", F.lit(0).cast("bigint"))
    decided = sync.decide(waiting, targets, lo, hi, f"{folder}/decided")
    sync.commit(
        waiting,
        decided,
        spans,
        lo,
        hi,
        targets,
        scratch=folder,
        run_id=batch_key,
        started_at=started_at,
        days=days,
    )
