"""One writer per message table: a lease beside it, taken by creating a file exclusively.

The lease names its owner and when it runs out.  A writer renews it while it works; a lease that
has run out, because its writer is gone, is taken over.  Taking over goes by a second exclusive file, so that
of two writers who see the same dead lease one gets it.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession

from inboxlens.sources import files

#: How long a lease lasts after it was taken or renewed.
MINUTES = 60


class Taken(RuntimeError):
    """Another writer holds the lease."""


def _path(table: str) -> str:
    return f"{table.rstrip('/')}_lease"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _text(owner: str, minutes: int) -> str:
    until = _now() + dt.timedelta(minutes=minutes)
    return json.dumps({"owner": owner, "until": until.isoformat()})


def take(spark: SparkSession, table: str, owner: str, *, minutes: int = MINUTES) -> None:
    """Take the lease of a table, or raise :class:`Taken` with the owner's name."""
    path = _path(table)
    if files.create(spark, path, _text(owner, minutes)):
        return
    said = files.read(spark, path)
    holder = json.loads(said) if said else {"owner": "unknown", "until": None}
    if not said or dt.datetime.fromisoformat(holder["until"]) > _now():
        raise Taken(f"{table} is written by {holder['owner']} until {holder['until']}")
    # the heir's file is named after the dead lease, so only one of its heirs creates it
    heir = f"{path}.after-{holder['owner']}"
    if not files.create(spark, heir, owner):
        raise Taken(f"{table} is being taken over by {files.read(spark, heir)}")
    try:
        files.replace(spark, path, _text(owner, minutes), owner)
    finally:
        files.drop(spark, heir)


def renew(spark: SparkSession, table: str, owner: str, *, minutes: int = MINUTES) -> None:
    """Put off the end of a lease; raises :class:`Taken` if it went to another writer meanwhile."""
    said = files.read(spark, _path(table))
    if not said or json.loads(said)["owner"] != owner:
        raise Taken(f"{table} is no longer held by {owner}")
    files.replace(spark, _path(table), _text(owner, minutes), owner)


def release(spark: SparkSession, table: str, owner: str) -> None:
    """Give the lease back, if it is still the owner's."""
    said = files.read(spark, _path(table))
    if said and json.loads(said)["owner"] == owner:
        files.drop(spark, _path(table))


@contextlib.contextmanager
def held(
    spark: SparkSession, table: str, owner: str, *, minutes: int = MINUTES
) -> Iterator[Callable[[], None]]:
    """Hold the lease of a table for a block; yields a function that renews it."""
    take(spark, table, owner, minutes=minutes)
    try:
        yield lambda: renew(spark, table, owner, minutes=minutes)
    finally:
        release(spark, table, owner)
