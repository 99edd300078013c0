"""Declared data checks, reported as ``(check, failures, status)`` and enforced by a gate.

All checks that look at single rows or at a newest timestamp share one aggregate over the
table.  Uniqueness and references need a grouping each; both count per key before anything
else, so a hot key is one row per map task.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from inboxlens.functions import rules
from inboxlens.functions.clock import instant

PASS, WARN, ERROR = "pass", "warn", "error"


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Accepted:
    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Fresh:
    """Age of the newest value: warn and error beyond the given hours, error if empty."""

    column: str
    warn_hours: int = 24
    error_hours: int = 72


@dataclass(frozen=True)
class Recent:
    """The newest value must lie within the given hours; an empty table passes."""

    column: str
    hours: int = 72


@dataclass(frozen=True)
class Unique:
    """No value may occur twice; NULLs are ignored."""

    column: str


@dataclass(frozen=True)
class References:
    """Every non-NULL value must occur in the parent column."""

    column: str
    parent: DataFrame
    parent_column: str


Rule = NotNull | Accepted | Fresh | Recent | Unique | References

# --- fixed values: the declared checks ---------------------------------------

RAW_MESSAGES: tuple[Rule, ...] = (
    Unique("message_id"),
    NotNull("message_id"),
    NotNull("received_at"),
    Fresh("ingested_at"),
)
RUN_LEDGER: tuple[Rule, ...] = (
    NotNull("run_id"),
    NotNull("status"),
    NotNull("sync_start"),
    NotNull("sync_end"),
    Accepted("status", ("ok", "error")),
    Fresh("finished_at"),
)
STAGING: tuple[Rule, ...] = (
    Unique("message_id"),
    NotNull("message_id"),
    NotNull("received_at"),
    NotNull("ingested_at"),
    Recent("received_at"),
)
EMAIL_MART: tuple[Rule, ...] = (
    Unique("message_id"),
    NotNull("message_id"),
    NotNull("received_at"),
    NotNull("job_pipeline_category"),
    Accepted("job_pipeline_category", rules.CATEGORIES),
)
APPLICATIONS: tuple[Rule, ...] = (
    Unique("application_id"),
    NotNull("application_id"),
    NotNull("first_email_at"),
    NotNull("last_email_at"),
    NotNull("email_count"),
    NotNull("latest_status_at"),
    NotNull("has_interview"),
    NotNull("has_offer"),
    NotNull("has_rejection"),
    NotNull("has_recruiter_outreach"),
    NotNull("is_no_response"),
    NotNull("outcome"),
    Accepted("outcome", rules.OUTCOMES),
)
META: tuple[Rule, ...] = (
    NotNull("mart_built_at"),
    NotNull("data_through"),
    NotNull("application_count"),
)


def check(
    df: DataFrame, checks: Sequence[Rule], *, as_of: dt.datetime | Column, table: str = ""
) -> DataFrame:
    """One row per check; ``failures`` counts rows, or values for uniqueness."""
    simple = [c for c in checks if not _grouped(c)]
    reports = []
    if simple:
        reports.append(_reported(df.agg(*_measures(simple)), simple, instant(as_of), _prefix(table)))
    return _with_grouped(reports, df, checks, table)


def observed(
    df: DataFrame, checks: Sequence[Rule], *, as_of: dt.datetime | Column, table: str = ""
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The frame, watched, and a function that gives the report once a write of it has run.

    Checks of single rows and newest timestamps are counted while the watched frame passes by, so they
    cost no pass of their own.  The function takes the frame to group for the other checks, best
    the written table, and gives what :func:`check` gives.  If a lost executor makes Spark repeat
    a stage, failures may be counted twice; none stays none.
    """
    simple = [c for c in checks if not _grouped(c)]
    watch = Observation(f"checks-{uuid.uuid4().hex}")

    def report(written: DataFrame) -> DataFrame:
        reports = []
        if simple:
            found = _seen(watch)
            if found is None:
                row = written.agg(*_measures(simple))
            else:
                kinds = ", ".join(f"{name} bigint" for name in found)
                row = df.sparkSession.createDataFrame([list(found.values())], kinds)
            reports.append(_reported(row, simple, instant(as_of), _prefix(table)))
        return _with_grouped(reports, written, checks, table)

    return (df.observe(watch, *_measures(simple)) if simple else df), report


def _seen(watch: Observation) -> dict | None:
    """What was observed; None where the optimizer saw that there is no row and looked at none."""
    try:
        return watch.get or None
    except Py4JJavaError as failure:
        if "AssertionError" not in str(failure.java_exception):
            raise
        return None


def _grouped(rule: Rule) -> bool:
    return isinstance(rule, (Unique, References))


def _prefix(table: str) -> str:
    return f"{table}." if table else ""


def _with_grouped(
    reports: list[DataFrame], df: DataFrame, checks: Sequence[Rule], table: str
) -> DataFrame:
    prefix = _prefix(table)
    for c in checks:
        if isinstance(c, Unique):
            reports.append(_counted(_duplicates(df, c.column), f"{prefix}unique:{c.column}"))
        elif isinstance(c, References):
            reports.append(_counted(_orphans(df, c), f"{prefix}references:{c.column}"))
    return reduce(DataFrame.unionByName, reports)


def gate(report: DataFrame) -> None:
    """Raise if any check of the report failed; warnings pass."""
    failed = report.filter(F.col("status") == ERROR).orderBy("check").collect()
    if failed:
        lines = ", ".join(f"{r['check']} ({r['failures']})" for r in failed)
        raise ValueError(f"data checks failed: {lines}")


def _measures(checks: Sequence[Rule]) -> list[Column]:
    """One aggregate a check, ``m0`` and so on: failing rows, or the newest value in microseconds."""
    made = []
    for i, c in enumerate(checks):
        match c:
            case NotNull(column):
                value = F.count_if(F.col(column).isNull())
            case Accepted(column, values):
                value = F.count_if(~F.col(column).isin(*values))
            case Recent(column) | Fresh(column):
                value = F.unix_micros(F.max(column))
        made.append(value.alias(f"m{i}"))
    return made


def _reported(measured: DataFrame, checks: Sequence[Rule], as_of: Column, prefix: str) -> DataFrame:
    rows = []
    for i, c in enumerate(checks):
        value = F.col(f"m{i}")
        newest = F.timestamp_micros(value)
        match c:
            case NotNull(column):
                rows.append(_row(f"{prefix}not_null:{column}", value))
            case Accepted(column):
                rows.append(_row(f"{prefix}accepted_values:{column}", value))
            case Recent(column, hours):
                stale = F.coalesce(newest < as_of - _hours(hours), F.lit(False))
                rows.append(_row(f"{prefix}recency:{column}", stale.cast("bigint")))
            case Fresh(column, warn_hours, error_hours):
                late = value.isNull() | (newest < as_of - _hours(warn_hours))
                dead = value.isNull() | (newest < as_of - _hours(error_hours))
                status = F.when(dead, ERROR).when(late, WARN).otherwise(PASS)
                rows.append(
                    _row(f"{prefix}freshness:{column}", late.cast("bigint"), status)
                )
    return measured.select(F.inline(F.array(*rows)))


def _hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def _row(name: str, failures: Column, status: Column | None = None) -> Column:
    if status is None:
        status = F.when(failures > 0, ERROR).otherwise(PASS)
    return F.struct(
        F.lit(name).alias("check"), failures.alias("failures"), status.alias("status")
    )


def _counted(failing: DataFrame, name: str) -> DataFrame:
    total = failing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return total.select(_row(name, F.col("n")).alias("r")).select("r.*")


def _duplicates(df: DataFrame, column: str) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("c"))
    return counts.filter(F.col("c") > 1).select(F.lit(1).alias("n"))


def _orphans(df: DataFrame, rule: References) -> DataFrame:
    children = (
        df.filter(F.col(rule.column).isNotNull())
        .groupBy(F.col(rule.column).alias("_key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parents = rule.parent.select(F.col(rule.parent_column).alias("_key")).distinct()
    return children.join(parents, "_key", "left_anti")
