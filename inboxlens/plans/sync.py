"""Incremental sync of landed messages into the message table.

Protocol:

1. a file stream over the landing area, run until it has caught up, hands over the files not read
   before; its own log is the record of files.  Every file is parsed once and its mail
   written, flattened and by day of receipt, to the rows that wait beside the ledger;
2. one decision on ids, against the index of landed ids, says which waiting rows are new;
3. per commit group of windows, oldest first: new rows are appended to the message table, their ids
   to the index, and one ``ok`` row per window to the ledger, which moves the watermark;
4. mail that landed late, received before the watermark, goes first, with a ledger row for each
   day that has any;
5. days that are committed are removed from the waiting rows; mail at or beyond the end of the run goes
   on waiting, and its file is not read again.

A crash leaves the rows waiting and the watermark at the last finished group.  The retry finds the rows
and drops what already landed, so nothing is lost or doubled.  (This is why the append must never become a
partition overwrite.)  One run at a time may write to a message table, which a lease sees to.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inboxlens.functions import search
from inboxlens.functions.clock import from_micros, instant
from inboxlens.operators import ingest
from inboxlens.session import prepare, shared_folder
from inboxlens.sources import files, ids, landing, lease, tables

LOG = logging.getLogger(__name__)


_KEY = ("batch", "row_id")
_DECIDED = (
    "batch bigint, row_id bigint, message_id string, received_at timestamp, is_new boolean"
)
_WAITING = T.StructType([T.StructField("batch", T.LongType()), *landing.STAGED.fields])


@dataclass(frozen=True)
class Targets:
    """Where a sync writes."""

    messages: str
    ledger: str
    quarantine: str


@dataclass(frozen=True)
class Outcome:
    """Totals of one commit group; ``stopped_at`` is set where a window hit its cap."""

    fetched: int
    inserted: int
    windows: int
    stopped_at: dt.datetime | None = None


def run(
    spark: SparkSession,
    landing_path: str,
    targets: Targets,
    *,
    floor: dt.date,
    ceiling: dt.datetime | None = None,
    days: int = 1,
    predicate: Callable[[Column], Column] | str | None = landing.in_inbox,
    cap: int = 0,
    full_backfill: bool = False,
    windows_per_commit: int | None = None,
    max_body_chars: int = landing.MAX_BODY_CHARS,
    depth: int = landing.FIRST_DEPTH,
    id_buckets: int = ids.BUCKETS,
    lease_minutes: int = lease.MINUTES,
) -> dict:
    """Bring the message table up to ``ceiling`` (default: now) and return a summary.

    ``windows_per_commit`` sets how much a crash can undo: None commits all windows in one
    group; files are parsed and ids looked up once either way.  ``cap`` bounds the new messages of
    a window; a window that has more is filled up to the cap, is not recorded as done, and ends the
    run.  ``predicate`` is a column over the parsed message or a search string such as
    ``in:inbox -from:me``.  A full backfill reads the whole landing area again.  Mail received before ``floor`` is
    not taken up.  A second run on the same message table is refused while one holds the lease.
    """
    prepare(spark)
    now = dt.datetime.now(dt.timezone.utc).replace(microsecond=0)
    hi = (ceiling or now).replace(microsecond=0)
    run_id = uuid.uuid4().hex
    with lease.held(spark, targets.messages, run_id, minutes=lease_minutes) as renew:
        ids.repair(spark, targets.messages, id_buckets)
        lo = _start(spark, targets, floor, full_backfill)
        scratch = f"{shared_folder(spark)}/sync-{run_id}"
        fetched = inserted = completed = 0
        status = "ok"
        start, end, started_at = lo, hi, dt.datetime.now(dt.timezone.utc)
        options = {
            "ingested_at": started_at, "max_body_chars": max_body_chars, "depth": depth,
            "predicate": search.predicate(predicate) if isinstance(predicate, str) else predicate,
            "dated_only": True,
            "keep": F.col("received_at") >= instant(ingest.start_of(floor)),
        }
        try:
            if full_backfill:
                waiting = landing.stage(landing.read(spark, landing_path), f"{scratch}/rows", **options)
                append_quarantine(waiting, targets)
                waiting = waiting.withColumn("batch", F.lit(0).cast("bigint"))
            else:
                waiting = _caught_up(spark, landing_path, targets, lo, options)
            renew()
            decided = decide(waiting, targets, ingest.start_of(floor), hi, f"{scratch}/decided", id_buckets)
            for number, (start, end, spans) in enumerate(
                _groups(spark, decided, lo, hi, days, windows_per_commit)
            ):
                renew()
                started_at = dt.datetime.now(dt.timezone.utc)
                done = commit(
                    waiting,
                    decided,
                    spans,
                    start,
                    end,
                    targets,
                    scratch=f"{scratch}/{number}",
                    run_id=run_id,
                    started_at=started_at,
                    days=days,
                    cap=cap,
                    id_buckets=id_buckets,
                )
                fetched += done.fetched
                inserted += done.inserted
                completed += done.windows
                if done.stopped_at is not None:
                    status = "capped"
                    break
            if status == "ok" and not full_backfill:
                _settle(spark, targets, hi)
        except Exception as failure:
            _record_failure(spark, targets, run_id, started_at, start, end, failure)
            raise
        finally:
            files.drop(spark, scratch)
    return {
        "status": status,
        "run_id": run_id,
        "fetched": fetched,
        "inserted": inserted,
        "windows_completed": completed,
        "sync_start": lo.isoformat(),
        "sync_end": hi.isoformat(),
    }


def _area(targets: Targets) -> str:
    """Where the stream's log and the waiting rows lie."""
    return f"{targets.ledger.rstrip('/')}_landing"


def _caught_up(
    spark: SparkSession, landing_path: str, targets: Targets, lo: dt.datetime, options: dict
) -> DataFrame:
    """Stage what landed since the last run and return the rows that wait for a commit.

    Those are the rows of files that no finished run has seen, and older ones that were not due yet.
    A batch that failed is planned again by the stream with the same files, and starts from an
    empty folder.
    """
    area = _area(targets)

    def write(batch: DataFrame, number: int) -> None:
        # streams plan without adaptive execution, which deals the rows out by day
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        folder = f"{area}/rows/batch={number}"
        files.drop(batch.sparkSession, folder)
        append_quarantine(landing.stage(landing.lines_of(batch), folder, **options), targets)

    (
        # files count as new whatever their time is
        landing.arriving(
            spark, landing_path, maxFileAge="36500d", maxFilesPerTrigger=landing.FILES_A_BATCH
        )
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{area}/log")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    if not files.exists(spark, f"{area}/rows"):
        return spark.createDataFrame([], _WAITING)
    rows = landing.staged_rows(spark, f"{area}/rows", _WAITING)
    settled = tables.read_settled(spark, targets.ledger)
    return rows.filter((F.col("batch") > settled) | (F.col("received_at") >= instant(lo)))


def _settle(spark: SparkSession, targets: Targets, hi: dt.datetime) -> None:
    """Note that all rows staged so far and received before ``hi`` are committed, and drop whole days of them."""
    staged = [int(p.rsplit("=", 1)[1]) for p in files.matching(spark, f"{_area(targets)}/rows/batch=*")]
    if not staged:
        return
    tables.write_settled(spark, targets.ledger, max(staged))
    for day in files.matching(spark, f"{_area(targets)}/rows/batch=*/round=*/received_date=*"):
        name = day.rsplit("=", 1)[1]
        if name == "__HIVE_DEFAULT_PARTITION__" or dt.date.fromisoformat(name) < hi.date():
            files.drop(spark, day)


def _groups(
    spark: SparkSession,
    decided: DataFrame,
    lo: dt.datetime,
    hi: dt.datetime,
    days: int,
    per_commit: int | None,
) -> list[tuple[dt.datetime, dt.datetime, DataFrame]]:
    """Commit groups with their windows: days with late mail first, then the new ones in order."""
    groups = []
    late = decided.filter(F.col("is_new") & (F.col("received_at") < instant(lo)))
    oldest = late.agg(F.min(F.unix_micros("received_at"))).first()[0]
    if oldest is not None:
        first = from_micros(oldest).replace(hour=0, minute=0, second=0, microsecond=0)
        spans = (
            ingest.assign_window(late.select("received_at"), first, lo, days=days)
            .select("sync_start", "sync_end")
            .distinct()
        )
        groups.append((first, lo, spans))
    new = ingest.windows(ingest.bounds(spark, lo, hi), days=days)
    for start, end in ingest.window_edges(new, per_commit):
        groups.append((start, end, ingest.windows(ingest.bounds(spark, start, end), days=days)))
    return groups


def decide(
    waiting: DataFrame,
    targets: Targets,
    lo: dt.datetime,
    hi: dt.datetime,
    folder: str,
    id_buckets: int = ids.BUCKETS,
) -> DataFrame:
    """Which of the waiting rows in ``[lo, hi)`` are new, written to ``folder``.

    The index of landed ids is read once a run, where it lies; only the ids of the waiting rows are
    shuffled.
    """
    spark = waiting.sparkSession
    due = waiting.filter(
        ingest.in_range(F.col("received_at"), lo, hi) & F.col("reason").isNull()
    ).select(*_KEY, "message_id", "received_at", "digest")
    landed = ids.read(spark, targets.messages, id_buckets)
    ingest.decide(due, landed, row=_KEY).write.mode("overwrite").parquet(folder)
    return spark.read.schema(_DECIDED).parquet(folder)


def commit(
    waiting: DataFrame,
    decided: DataFrame,
    spans: DataFrame,
    lo: dt.datetime,
    hi: dt.datetime,
    targets: Targets,
    *,
    scratch: str,
    run_id: str,
    started_at: dt.datetime,
    days: int = 1,
    cap: int = 0,
    id_buckets: int = ids.BUCKETS,
) -> Outcome:
    """Append the new rows of the waiting days in ``[lo, hi)``, then their ids and their ledger rows.

    The decision on ids serves the counts and the append; bodies only meet the keys of the rows
    that are turned away, or of those taken where they are fewer.
    """
    spark = waiting.sparkSession
    of_group = waiting.filter(
        F.col("received_date").between(F.lit(lo.date()), F.lit(hi.date()))
        & ingest.in_range(F.col("received_at"), lo, hi)
        & F.col("reason").isNull()
    )
    decided = ingest.assign_window(decided, lo, hi, days=days)
    counts = ingest.window_counts(spans, decided, decided.filter("is_new"))
    counts.write.mode("overwrite").parquet(f"{scratch}/counts")
    counts = spark.read.schema(
        "sync_start timestamp, sync_end timestamp, fetched bigint, inserted bigint"
    ).parquet(f"{scratch}/counts")

    refused, taken = decided.filter("NOT is_new").select(*_KEY), decided.filter("is_new")
    stop = _first_over_cap(counts, cap)
    done, extra = counts, (0, 0)
    if stop is not None:
        done = counts.filter(F.col("sync_start") < instant(stop))
        taken = ingest.capped(taken, cap).filter(F.col("sync_start") <= instant(stop))
        taken.write.mode("overwrite").parquet(f"{scratch}/taken")
        taken = spark.read.schema(taken.schema).parquet(f"{scratch}/taken")
        refused = decided.join(taken.select(*_KEY), [*_KEY], "left_anti").select(*_KEY)
        full = counts.filter(F.col("sync_start") == instant(stop)).first()
        extra = (full["fetched"], cap)
    total = done.agg(
        F.coalesce(F.sum("fetched"), F.lit(0)),
        F.coalesce(F.sum("inserted"), F.lit(0)),
        F.count(F.lit(1)),
    ).first()
    # bodies meet the shorter list of keys: every row in range is on one of the two
    in_range = counts.agg(F.coalesce(F.sum("fetched"), F.lit(0))).first()[0]
    mostly_new = 2 * (total[1] + extra[1]) > in_range
    keys, how = (refused, "left_anti") if mostly_new else (taken.select(*_KEY), "left_semi")
    ids.opened(spark, targets.messages, lo.date(), hi.date(), id_buckets)
    # mail may have waited since it was staged: it is ingested now, later than all mail before it
    arriving = of_group.join(keys, [*_KEY], how)
    tables.append_messages(arriving.withColumn("ingested_at", instant(started_at)), targets.messages)
    ids.append(taken, targets.messages, id_buckets)

    tables.append_ledger(_ok_rows(done, run_id, started_at), targets.ledger)
    return Outcome(total[0] + extra[0], total[1] + extra[1], total[2], stop)


def _start(
    spark: SparkSession, targets: Targets, floor: dt.date, full_backfill: bool
) -> dt.datetime:
    """Where this run begins.

    Until a first window is done, the newest message is no safe mark: a crashed run may have
    appended late mail and not yet early mail.  So the first run notes where it began, and
    runs begin there again until the ledger has a good window.
    """
    ledger = tables.read_ledger(spark, targets.ledger)
    done = ingest.last_good(ledger)
    if done is not None:
        return ingest.start_of(floor) if full_backfill else done
    noted = tables.read_start(spark, targets.ledger)
    if full_backfill:
        begin = ingest.start_of(floor)
    elif noted is not None:
        begin = noted
    else:
        begin = ingest.watermark(
            None, tables.read_messages(spark, targets.messages), floor=floor
        )
    if noted is None or begin < noted:
        tables.write_start(spark, targets.ledger, begin)
    return begin


def _first_over_cap(counts: DataFrame, cap: int) -> dt.datetime | None:
    if cap <= 0:
        return None
    over = counts.filter(F.col("inserted") > cap).agg(F.min(F.unix_micros("sync_start")))
    first = over.first()[0]
    return None if first is None else from_micros(first)


def append_quarantine(staged: DataFrame, targets: Targets) -> None:
    """Keep each bad line once, however often its file is read."""
    bad = landing.quarantine_of(staged)
    if bad.isEmpty():
        return
    known = tables.read_quarantine(staged.sparkSession, targets.quarantine)
    if known is None:
        fresh = ingest.first_copies(bad, key="payload_sha")
    else:
        fresh = ingest.new_rows(bad, known, key="payload_sha")
    tables.append_quarantine(fresh, targets.quarantine)


def _ok_rows(counts: DataFrame, run_id: str, started_at: dt.datetime) -> DataFrame:
    return counts.select(
        F.lit(run_id).alias("run_id"),
        instant(started_at).alias("started_at"),
        instant(dt.datetime.now(dt.timezone.utc)).alias("finished_at"),
        F.lit("ok").alias("status"),
        "sync_start",
        "sync_end",
        "fetched",
        "inserted",
        F.lit(None).cast("string").alias("error"),
    )


def _record_failure(
    spark: SparkSession,
    targets: Targets,
    run_id: str,
    started_at: dt.datetime,
    start: dt.datetime,
    end: dt.datetime,
    failure: Exception,
) -> None:
    """Append one ``error`` row; if that fails too, the first failure is the one to raise."""
    row = ingest.bounds(spark, start, end).select(
        F.lit(run_id).alias("run_id"),
        instant(started_at).alias("started_at"),
        instant(dt.datetime.now(dt.timezone.utc)).alias("finished_at"),
        F.lit("error").alias("status"),
        F.col("lo").alias("sync_start"),
        F.col("hi").alias("sync_end"),
        F.lit(0).alias("fetched"),
        F.lit(0).alias("inserted"),
        F.lit(f"{type(failure).__name__}: {failure}").alias("error"),
    )
    try:
        tables.append_ledger(row, targets.ledger)
    except Exception:
        LOG.exception("could not record the failed window")
