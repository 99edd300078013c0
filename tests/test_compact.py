"""Compaction of the message table: rows, files, readers, crashes."""

import datetime as dt
import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from inboxlens.plans import compact
from inboxlens.sources import layout, tables

COLUMNS = "message_id string, sender string, thread_id string, received_at timestamp, plain_body string"


def mails(spark, ids, day=1, senders=40):
    rng = random.Random(day)
    rows = [
        (str(i), f"user{rng.randrange(senders):03}@x.com", f"t{rng.randrange(senders):03}",
         dt.datetime(2026, 3, day, 1, tzinfo=dt.timezone.utc), f"body {i} " * 20)
        for i in ids
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "messages")
    for k in range(8):
        tables.append_messages(mails(spark, range(k * 50, k * 50 + 50)).coalesce(1), path)
    tables.append_messages(mails(spark, [9001, 9002], day=2).coalesce(1), path)
    return path


def ids(spark, path):
    return sorted(int(r[0]) for r in tables.read_messages(spark, path).select("message_id").collect())


ALL = [*range(400), 9001, 9002]


def test_same_rows_in_fewer_files(spark, table):
    before = tables.read_messages(spark, table)
    done = compact.compact(spark, table)
    # the second day has one file and stays where it is
    assert done == {"days": 1, "files_before": 8, "files_after": 1}
    assert ids(spark, table) == ALL
    assert before.count() == len(ALL)  # a reader that began before goes on
    assert compact.compact(spark, table)["days"] == 0
    # late mail of a rewritten day, then another compaction of it
    tables.append_messages(mails(spark, [7777]), table)
    assert ids(spark, table) == sorted([*ALL, 7777])
    again = compact.compact(spark, table, least_files=2)
    assert again["days"] == 1 and again["files_after"] == 1
    assert ids(spark, table) == sorted([*ALL, 7777])
    assert len(layout.read(spark, table).live) == 3  # the second day's, the rewritten one, the open one


def test_a_crash_leaves_the_table_as_it_was(spark, table, monkeypatch):
    monkeypatch.setattr(layout, "write", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError, match="gone"):
        compact.compact(spark, table)
    monkeypatch.undo()
    assert ids(spark, table) == ALL
    assert compact.compact(spark, table)["days"] == 1 and ids(spark, table) == ALL


def test_replaced_files_go_with_the_next_compaction(spark, table):
    compact.compact(spark, table)
    left = layout.read(spark, table).left
    assert left and all(Path(p).exists() for p in left)
    compact.compact(spark, table)
    assert not any(Path(p).exists() for p in left)


def test_filters_on_either_column_read_few_files(spark, tmp_path):
    path = str(tmp_path / "messages")
    for k in range(8):
        tables.append_messages(mails(spark, range(k * 500, k * 500 + 500)).repartition(8), path)
    size = sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))
    assert compact.compact(spark, path, target_bytes=size // 16)["files_after"] >= 12
    made = [f for v in layout.read(spark, path).live for f in Path(layout.folder(path, v)).rglob("*.parquet")]

    def read_for(column, value):
        hit = 0
        for f in made:
            meta = pq.ParquetFile(f).metadata
            at = [meta.schema.column(c).name for c in range(meta.num_columns)].index(column)
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            hit += any(s.min <= value <= s.max for s in stats)
        return hit

    for column, value in (("sender", "user013@x.com"), ("thread_id", "t029")):
        assert read_for(column, value) <= len(made) // 2
    assert ids(spark, path) == list(range(4000))


def test_interleaving_keeps_both_orders(spark):
    grid = spark.range(256).select((F.col("id") % 16).cast("int").alias("a"), (F.col("id") / 16).cast("int").alias("b"))
    rows = grid.withColumn("z", compact.interleaved([F.col("a"), F.col("b")])).collect()
    assert len({r.z for r in rows}) == 256
    by_place = {(r.a, r.b): r.z for r in rows}
    assert by_place[0, 0] < by_place[0, 1] < by_place[1, 0] < by_place[1, 1] < by_place[2, 0]
    assert all(by_place[a, 3] < by_place[a + 1, 3] for a in range(15))
