"""Where the rows of the message table lie.

The table is a set of version folders with one partition a day in each.  Appends go to the open
version; compaction writes days with many small files anew, into a version of their own, and opens
another one for the appends to come.  One small file beside the table says which versions count and
which of their days have been rewritten; it is replaced by one rename, so a reader sees the table
before a compaction or after it.  Without the file the table is its first open version.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from inboxlens.sources import files

_DAY = "received_date="


@dataclass
class Layout:
    """``live`` versions in order, the last of them open; ``gone`` days of a version don't count.

    ``left`` are the folders that the last compaction replaced; readers may still be at them.
    """

    live: list[str] = field(default_factory=lambda: ["open-0"])
    gone: dict[str, list[str]] = field(default_factory=dict)
    left: list[str] = field(default_factory=list)

    @property
    def open(self) -> str:
        return self.live[-1]


def _file(table: str) -> str:
    return f"{table.rstrip('/')}_layout"


def read(spark: SparkSession, table: str) -> Layout:
    said = files.read(spark, _file(table))
    return Layout(**json.loads(said)) if said else Layout()


def write(spark: SparkSession, table: str, layout: Layout, token: str) -> None:
    files.replace(spark, _file(table), json.dumps(vars(layout)), token)


def folder(table: str, version: str) -> str:
    return f"{table.rstrip('/')}/version={version}"


def open_folder(spark: SparkSession, table: str) -> str:
    """Where appends go."""
    return folder(table, read(spark, table).open)


def days(spark: SparkSession, table: str, version: str) -> list[str]:
    """Names of the day folders of a version; their number is that of the days covered."""
    found = files.matching(spark, f"{folder(table, version)}/{_DAY}*")
    return sorted(p.rstrip("/").rsplit("/", 1)[1].removeprefix(_DAY) for p in found)


def day_folder(table: str, version: str, day: str) -> str:
    return f"{folder(table, version)}/{_DAY}{day}"


def folders(spark: SparkSession, table: str) -> list[str]:
    """The folders whose rows are the table's: whole versions, or the days of one that count."""
    now = read(spark, table)
    found = []
    for version in now.live:
        gone = set(now.gone.get(version, ()))
        if gone:
            found += [day_folder(table, version, d) for d in days(spark, table, version) if d not in gone]
        elif files.exists(spark, folder(table, version)):
            found.append(folder(table, version))
    return found
