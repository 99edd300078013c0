"""Incremental ingestion: windows, watermark, de-duplication, counts and summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inboxlens.functions.clock import floor_second, from_micros, instant

_DAY_MICROS = 86_400_000_000
_WINDOW = ("sync_start", "sync_end")


def bounds(spark: SparkSession, lo: dt.datetime, hi: dt.datetime) -> DataFrame:
    """A one-row relation ``(lo, hi)``."""
    return spark.range(1).select(instant(lo).alias("lo"), instant(hi).alias("hi"))


def windows(limits: DataFrame, *, days: int = 1) -> DataFrame:
    """Half-open windows ``[sync_start, sync_end)`` that cover ``[lo, hi)``.

    Cuts fall on the UTC day of ``lo`` plus whole steps; the first and last windows are
    clipped, and there are none where ``lo >= hi``.
    """
    step = F.make_dt_interval(F.lit(max(1, days)))
    day = F.date_trunc("day", "lo")
    last = F.greatest(day, "hi")  # a sequence may not run backwards, not even unused
    cuts = limits.filter(F.col("lo") < F.col("hi")).select(
        "lo", "hi", F.explode(F.sequence(day, last, step)).alias("cut")
    )
    return cuts.select(
        F.greatest("cut", "lo").alias("sync_start"),
        F.least(F.col("cut") + step, F.col("hi")).alias("sync_end"),
    ).filter(F.col("sync_start") < F.col("sync_end"))


def in_range(at: Column, lo: dt.datetime | Column, hi: dt.datetime | Column) -> Column:
    """``[lo, hi)`` with both bounds floored to whole seconds."""
    return (at >= floor_second(instant(lo))) & (at < floor_second(instant(hi)))


def before(at: Column, end: dt.datetime | Column) -> Column:
    """Earlier than ``end`` floored to the second; true where there is no date."""
    return F.coalesce(at < floor_second(instant(end)), F.lit(True))


def assign_window(
    messages: DataFrame, lo: dt.datetime | Column, hi: dt.datetime | Column, *, days: int = 1
) -> DataFrame:
    """Messages received in ``[lo, hi)`` with the window each belongs to.

    The window follows from arithmetic on the timestamp, so nothing is joined.
    """
    first, last = floor_second(instant(lo)), floor_second(instant(hi))
    step = F.lit(max(1, days) * _DAY_MICROS)
    day = F.unix_micros(F.date_trunc("day", first))
    offset = F.unix_micros("received_at") - day
    start = day + offset - offset % step
    return messages.filter(in_range(F.col("received_at"), lo, hi)).withColumns(
        {
            "sync_start": F.greatest(first, F.timestamp_micros(start)),
            "sync_end": F.least(last, F.timestamp_micros(start + step)),
        }
    )


def first_copies(
    batch: DataFrame, *, key: str = "message_id", count: str | None = None
) -> DataFrame:
    """One row per key, the smallest by receipt and then by every other column.

    ``count`` names a column for the number of copies.

    The minimum combines map-side, so a key that fills a third of the batch reaches its
    reducer as one row per map task.  Rows without a key are not messages and are left out.
    """
    rest = [c for c in batch.columns if c != key]
    rest.sort(key=lambda c: c != "received_at")
    kept = (
        batch.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_copies"))
    )
    return kept.select(
        *(F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in batch.columns),
        *([F.col("_copies").alias(count)] if count else []),
    )


def new_rows(batch: DataFrame, landed: DataFrame, *, key: str = "message_id") -> DataFrame:
    """First copies of the batch whose key is not among the landed ones.

    De-duplication has already partitioned the batch by key, so only the landed keys are
    shuffled for the anti-join, each once.
    """
    return first_copies(batch, key=key).join(landed.select(key).distinct(), key, "left_anti")


def decide(narrow: DataFrame, landed: DataFrame, *, row: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Which staged rows are new: the columns ``row``, ``message_id``, ``received_at``, ``is_new``.

    ``narrow(*row, message_id, received_at, digest)`` stands for the rows, so that no body is
    sorted or sent.  Of the copies of a message the first by receipt stays (then by digest, then
    by row), if its id is not among the landed ones.  ``landed`` may hold an id twice.
    """
    # the id met by the join is a field, so that Spark deals the first copies to the landed ids' buckets;
    # by the grouping key it would deal the landed ids to the shuffle's parts where those are more
    first = (
        narrow.groupBy("message_id")
        .agg(F.min(F.struct("received_at", "digest", *row, "message_id")).alias("first"))
        .select("first")
        .join(landed.select("message_id"), F.col("first.message_id") == F.col("message_id"), "left_anti")
        .select(*(F.col(f"first.{c}").alias(c) for c in row), F.lit(True).alias("is_new"))
    )
    return narrow.join(first, [*row], "left").select(
        *row, "message_id", "received_at", F.coalesce("is_new", F.lit(False)).alias("is_new")
    )


def window_counts(spans: DataFrame, fetched: DataFrame, fresh: DataFrame) -> DataFrame:
    """``fetched`` and ``inserted`` per window, zero for windows without mail.

    ``fetched`` and ``fresh`` are messages with their windows; both are reduced to one row
    per window before they meet the window list.
    """
    tallies = (
        fetched.select(*_WINDOW, F.lit(0).alias("is_new"))
        .unionByName(fresh.select(*_WINDOW, F.lit(1).alias("is_new")))
        .groupBy(*_WINDOW)
        .agg(
            F.count_if(F.col("is_new") == 0).alias("fetched"),
            F.count_if(F.col("is_new") == 1).alias("inserted"),
        )
    )
    return spans.join(tallies, list(_WINDOW), "left").fillna(0, ["fetched", "inserted"])


def capped(assigned: DataFrame, cap: int) -> DataFrame:
    """The first ``cap`` messages of each window by receipt and id; 0 keeps all.

    Mail is counted by hour, the hour in which a window reaches its cap by second, and only
    mail of the second found there is ranked, so a full window is never sorted in one task.
    Every step keeps one row a window of what the step before has found.
    """
    if cap <= 0:
        return assigned
    timed = assigned.withColumns(
        {
            "_hour": F.date_trunc("hour", "received_at"),
            "_second": floor_second(F.col("received_at")),
        }
    )
    hours = _cut(timed.select(*_WINDOW, "_hour", F.lit(0).cast("bigint").alias("_base")), "_hour", cap)
    in_hour = timed.join(hours, list(_WINDOW))
    edge_hour = in_hour.filter(F.col("_hour") == F.col("_at"))
    seconds = _cut(
        edge_hour.select(*_WINDOW, "_second", F.col("_before").alias("_base")), "_second", cap
    )
    edge_second = (
        edge_hour.drop("_at", "_before")
        .join(seconds, list(_WINDOW))
        .filter(F.col("_second") <= F.col("_at"))
    )
    rank = F.row_number().over(
        Window.partitionBy(*_WINDOW).orderBy("received_at", "message_id")
    )
    sure = in_hour.filter(F.col("_hour") < F.col("_at"))
    sooner = edge_second.filter(F.col("_second") < F.col("_at"))
    ranked = (
        edge_second.filter(F.col("_second") == F.col("_at"))
        .withColumn("_rank", rank)
        .filter(F.col("_rank") + F.col("_before") <= cap)
    )
    columns = assigned.columns
    return (
        sure.select(columns).unionByName(sooner.select(columns)).unionByName(ranked.select(columns))
    )


def _cut(timed: DataFrame, unit: str, cap: int) -> DataFrame:
    """The unit of time in which each window reaches the cap, and the mail before it.

    ``_base`` is what a window holds before the units counted here.
    """
    so_far = F.sum("n").over(Window.partitionBy(*_WINDOW).orderBy(unit))
    return (
        timed.groupBy(*_WINDOW, unit)
        .agg(F.count(F.lit(1)).alias("n"), F.first("_base").alias("_base"))
        .withColumn("_before", F.col("_base") + so_far - F.col("n"))
        .filter(F.col("_before") < cap)
        .groupBy(*_WINDOW)
        .agg(F.max(F.struct(F.col(unit).alias("_at"), "_before")).alias("_cut"))
        .select(*_WINDOW, "_cut._at", "_cut._before")
    )


def watermark_frame(
    ledger: DataFrame | None, messages: DataFrame | None, *, floor: dt.date, spark: SparkSession
) -> DataFrame:
    """One row ``sync_start``: end of the last good window, else newest message, else floor.

    A missing table counts as empty, and the result is floored to the second.
    """
    candidates = []
    if ledger is not None:
        good = ledger.filter(F.col("status") == "ok")
        candidates.append(good.agg(F.max("sync_end")).scalar())
    if messages is not None:
        candidates.append(messages.agg(F.max("received_at")).scalar())
    candidates.append(instant(start_of(floor)))
    return spark.range(1).select(
        floor_second(F.coalesce(*candidates)).alias("sync_start")
    )


def last_good(ledger: DataFrame | None) -> dt.datetime | None:
    """End of the newest window recorded as ``ok``, floored to the second."""
    if ledger is None:
        return None
    return _newest(ledger.filter(F.col("status") == "ok"), "sync_end")


def watermark(
    ledger: DataFrame | None, messages: DataFrame | None, *, floor: dt.date
) -> dt.datetime:
    """The same as an aware datetime; messages are scanned only without a good window."""
    newest = last_good(ledger)
    if newest is None and messages is not None:
        newest = _newest(messages, "received_at")
    return newest or start_of(floor)


def _newest(df: DataFrame, column: str) -> dt.datetime | None:
    found = df.agg(F.max(F.unix_micros(floor_second(F.col(column))))).first()[0]
    return None if found is None else from_micros(found)


def start_of(day: dt.date) -> dt.datetime:
    return dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc)


def run_summary(ledger: DataFrame) -> DataFrame:
    """Totals per run over its completed windows."""
    return (
        ledger.filter(F.col("status") == "ok")
        .groupBy("run_id")
        .agg(
            F.sum("fetched").alias("fetched"),
            F.sum("inserted").alias("inserted"),
            F.count(F.lit(1)).alias("windows_completed"),
            F.min("sync_start").alias("sync_start"),
            F.max("sync_end").alias("sync_end"),
        )
    )


def window_edges(spans: DataFrame, per_commit: int | None) -> list[tuple[dt.datetime, dt.datetime]]:
    """Commit groups, oldest first, as ``(start, end)`` of neighbouring windows.

    The list is bounded by the number of days covered, not by the volume of mail.
    """
    spans = spans.select(F.unix_micros("sync_start"), F.unix_micros("sync_end"))
    ordered = sorted((s, e) for s, e in spans.collect())
    size = per_commit or max(1, len(ordered))
    groups = [ordered[i : i + size] for i in range(0, len(ordered), size)]
    return [(from_micros(g[0][0]), from_micros(g[-1][1])) for g in groups]

