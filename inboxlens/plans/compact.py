"""Compaction of the message table: days of many small files become few, clustered ones."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inboxlens.session import prepare
from inboxlens.sources import files, layout, lease, tables

#: Size of the files aimed at, and the number of files from which a day is worth a rewrite.
TARGET_BYTES = 128 * 1024 * 1024
LEAST_FILES = 8
#: Columns the rows of a day are clustered by, together.
CLUSTER = ("sender", "thread_id")
#: Values drawn to place the cuts of a column, and bits of a column's place among them.
SAMPLE, BITS = 20_000, 8


def compact(
    spark: SparkSession,
    messages_path: str,
    *,
    target_bytes: int = TARGET_BYTES,
    least_files: int = LEAST_FILES,
    cluster: tuple[str, ...] = CLUSTER,
) -> dict:
    """Rewrite the days that lie in at least ``least_files`` files smaller than half the target.

    The rows of such a day are dealt out over as many files as its bytes need, in Z-order of the
    cluster columns, so that a filter on any one of them skips most files.  Readers see the table
    as it was until one rename publishes the new files; what they replace is deleted by the
    next compaction, so a reader that began before goes on undisturbed.  Returns the number of days
    rewritten and their files before and after.
    """
    prepare(spark)
    token = uuid.uuid4().hex
    with lease.held(spark, messages_path, f"compaction-{token}") as renew:
        now = layout.read(spark, messages_path)
        for path in now.left:
            files.drop(spark, path)
        parts: dict[str, list[tuple[str, int, int]]] = {}
        for version in now.live:
            for day in layout.days(spark, messages_path, version):
                if day not in now.gone.get(version, ()):
                    size, number = files.usage(spark, layout.day_folder(messages_path, version, day))
                    parts.setdefault(day, []).append((version, size, number))
        due = {}
        for day, held in parts.items():
            size, number = (sum(h[k] for h in held) for k in (1, 2))
            if number >= least_files and size < number * target_bytes / 2:
                due[day] = (size, number)
        if not due:
            return {"days": 0, "files_before": 0, "files_after": 0}
        old = [layout.day_folder(messages_path, v, day) for day in due for v, _, _ in parts[day]]
        rows = tables.messages_in(spark, messages_path, old)
        wanted = sum(-(-size // target_bytes) for size, _ in due.values())
        made = layout.folder(messages_path, token)
        _clustered(rows, cluster, wanted).write.partitionBy("received_date").parquet(made)
        renew()
        written = tables.messages_in(spark, messages_path, [made])
        if written.count() != rows.count():
            files.drop(spark, made)
            raise RuntimeError(f"compaction of {messages_path} would change its rows")
        gone = {
            v: sorted({*now.gone.get(v, ()), *(day for day in due if v in (p[0] for p in parts[day]))})
            for v in now.live
        }
        kept = [v for v in now.live if set(layout.days(spark, messages_path, v)) - set(gone[v])]
        opened = f"open-{int(now.open.removeprefix('open-')) + 1}"
        after = layout.Layout(
            live=[*kept, token, opened], gone={v: gone[v] for v in kept if gone[v]}, left=old
        )
        layout.write(spark, messages_path, after, token)
        files_after = sum(
            files.usage(spark, layout.day_folder(messages_path, token, d))[1]
            for d in layout.days(spark, messages_path, token)
        )
    return {
        "days": len(due), "files_before": sum(n for _, n in due.values()), "files_after": files_after,
    }


def _clustered(rows: DataFrame, cluster: tuple[str, ...], number: int) -> DataFrame:
    """Rows in so many ranges of day and place on the Z-curve; a day's ranges don't overlap."""
    placed = rows.withColumn("_z", interleaved([_place(rows, c) for c in cluster]))
    dealt = placed.repartitionByRange(max(1, number), "received_date", "_z")
    return dealt.sortWithinPartitions("received_date", "_z", *cluster).drop("_z")


def _place(rows: DataFrame, column: str) -> Column:
    """Place of a value among the column's quantiles, 0 to ``2**BITS - 1``; NULL comes first.

    The cuts come from a bounded sample, so they only decide how well files are told apart, never
    which rows they hold.
    """
    known = rows.select(column).filter(F.col(column).isNotNull())
    total = known.count()
    share = min(1.0, 1.2 * SAMPLE / total) if total else 1.0
    drawn = sorted(r[0] for r in known.sample(share, seed=1).limit(SAMPLE).collect())
    steps = 2**BITS
    cuts = sorted({drawn[k * len(drawn) // steps] for k in range(1, steps)}) if drawn else []
    if not cuts:
        return F.lit(0)
    lower = F.filter(F.lit(cuts), lambda cut: cut <= F.col(column))
    return F.coalesce(F.size(lower), F.lit(0))


def interleaved(places: list[Column]) -> Column:
    """A place on the Z-curve: the bits of the columns' places in turn, the highest ones first."""
    n = len(places)
    return sum(
        (
            F.shiftleft(F.shiftright(p, bit).bitwiseAND(1).cast("bigint"), bit * n + n - 1 - k)
            for k, p in enumerate(places)
            for bit in range(BITS)
        ),
        F.lit(0).cast("bigint"),
    )
