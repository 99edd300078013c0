"""Windows, watermark, de-duplication, counts and caps (FIXTURES.md, section 5)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from inboxlens.operators import ingest
from inboxlens.sources import files, ids, lease, tables

UTC = dt.timezone.utc
LO = dt.datetime(2026, 3, 1, 7, 30, tzinfo=UTC)
HI = dt.datetime(2026, 3, 4, 5, 0, tzinfo=UTC)
FLOOR = dt.date(2026, 3, 1)


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def spans(spark, lo, hi, days):
    rows = ingest.windows(ingest.bounds(spark, lo, hi), days=days).select(
        F.col("sync_start").cast("string"), F.col("sync_end").cast("string")
    )
    return sorted(map(tuple, rows.collect()))


@pytest.mark.parametrize("days", [0, 1])
def test_daily_windows(spark, days):
    assert spans(spark, LO, HI, days) == [
        ("2026-03-01 07:30:00", "2026-03-02 00:00:00"),
        ("2026-03-02 00:00:00", "2026-03-03 00:00:00"),
        ("2026-03-03 00:00:00", "2026-03-04 00:00:00"),
        ("2026-03-04 00:00:00", "2026-03-04 05:00:00"),
    ]


def test_two_day_windows_are_anchored_at_the_first_day(spark):
    assert spans(spark, LO, HI, 2) == [
        ("2026-03-01 07:30:00", "2026-03-03 00:00:00"),
        ("2026-03-03 00:00:00", "2026-03-04 05:00:00"),
    ]


def test_no_windows_without_a_range(spark):
    assert spans(spark, LO, LO, 1) == []
    assert spans(spark, HI, LO, 1) == []
    midnight = at("2026-03-02")
    assert len(spans(spark, at("2026-03-01"), midnight, 1)) == 1


def test_assignment_agrees_with_the_windows(spark):
    rng = random.Random(7)
    moments = [LO + dt.timedelta(seconds=rng.uniform(-9e4, 4e5)) for _ in range(300)]
    moments += [LO, HI, HI - dt.timedelta(microseconds=1), at("2026-03-02"), at("2026-03-03")]
    mails = spark.createDataFrame([(str(i), m) for i, m in enumerate(moments)], "message_id string, received_at timestamp")
    for days in (1, 2, 5):
        windows = ingest.windows(ingest.bounds(spark, LO, HI), days=days)
        expected = mails.join(
            windows, (F.col("received_at") >= F.col("sync_start")) & (F.col("received_at") < F.col("sync_end"))
        )
        got = ingest.assign_window(mails, LO, HI, days=days)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def ledger(spark, *rows):
    return spark.createDataFrame(list(rows), "status string, sync_end timestamp")


def received(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "received_at timestamp")


def test_watermark_order(spark):
    good = ledger(spark, ("ok", at("2026-03-02T00:00:00.5")), ("error", at("2026-03-09")))
    newest = received(spark, at("2026-03-05T10:00:00.7"), None)
    none = ledger(spark)
    cases = [
        (good, newest, at("2026-03-02")),
        (none, newest, at("2026-03-05T10:00:00")),
        (none, received(spark), at("2026-03-01")),
        (None, None, at("2026-03-01")),
        (ledger(spark, ("error", at("2026-03-09"))), None, at("2026-03-01")),
    ]
    for runs, mails, expected in cases:
        assert ingest.watermark(runs, mails, floor=FLOOR) == expected
        frame = ingest.watermark_frame(runs, mails, floor=FLOOR, spark=spark)
        assert frame.select(F.unix_seconds("sync_start")).first()[0] == expected.timestamp()


def test_new_rows_against_brute_force(spark):
    """One id fills a third of the batch, and half of the ids have landed."""
    rng = random.Random(3)
    rows = [("hot", LO + dt.timedelta(seconds=rng.randrange(50)), rng.choice("abc")) for _ in range(500)]
    rows += [(str(rng.randrange(400)), LO + dt.timedelta(seconds=rng.randrange(50)), rng.choice("abc")) for _ in range(1000)]
    rows += [(None, LO, "x"), ("undated", None, "b"), ("undated", LO, "a")]
    rng.shuffle(rows)
    landed = [str(i) for i in range(200)] * 3
    batch = spark.createDataFrame(rows, "message_id string, received_at timestamp, note string").repartition(8)
    got = ingest.new_rows(batch, spark.createDataFrame([(i,) for i in landed], "message_id string"))
    best = {}
    for key, when, note in rows:
        if key is None or key in landed:
            continue
        rank = (when is not None, when or LO, note)
        best[key] = min(best.get(key, rank), rank)
    expected = {k: (r[1].replace(tzinfo=None) if r[0] else None, r[2]) for k, r in best.items()}
    assert {r.message_id: (r.received_at, r.note) for r in got.collect()} == expected
    assert got.columns == batch.columns


def test_counts_include_empty_windows(spark):
    windows = ingest.windows(ingest.bounds(spark, LO, HI))
    mails = spark.createDataFrame(
        [("1", at("2026-03-02T01:00")), ("1", at("2026-03-02T01:00")), ("2", at("2026-03-03T01:00"))],
        "message_id string, received_at timestamp",
    )
    placed = ingest.assign_window(mails, LO, HI)
    fresh = ingest.new_rows(placed, spark.createDataFrame([("2",)], "message_id string"))
    rows = ingest.window_counts(windows, placed, fresh).orderBy("sync_start").collect()
    assert [(r.fetched, r.inserted) for r in rows] == [(0, 0), (2, 1), (1, 0), (0, 0)]


@pytest.mark.parametrize("cap", [0, 1, 7, 40, 5000])
def test_cap_against_brute_force(spark, cap):
    """A third of a window's mail arrives in the same second."""
    rng = random.Random(cap)
    rows = [(f"{i:04}", at("2026-03-02T03:00:00") + dt.timedelta(microseconds=rng.choice([0, 5]))) for i in range(60)]
    rows += [(f"n{i}", LO + dt.timedelta(seconds=rng.randrange(200_000))) for i in range(120)]
    rng.shuffle(rows)
    mails = spark.createDataFrame(rows, "message_id string, received_at timestamp").repartition(8)
    placed = ingest.assign_window(mails, LO, HI)
    got = {r.message_id for r in ingest.capped(placed, cap).collect()}
    groups = {}
    for key, when in rows:
        if LO <= when < HI:
            groups.setdefault(when.date(), []).append((when, key))
    expected = {k for g in groups.values() for _, k in sorted(g)[: cap or None]}
    assert got == expected


def test_edges_group_windows_oldest_first(spark):
    windows = ingest.windows(ingest.bounds(spark, LO, HI))
    assert ingest.window_edges(windows, None) == [(LO, HI)]
    assert ingest.window_edges(windows, 3) == [(LO, at("2026-03-04")), (at("2026-03-04"), HI)]
    assert len(ingest.window_edges(windows, 1)) == 4


def test_run_summary(spark):
    rows = [
        ("a", "ok", LO, HI, 3, 2),
        ("a", "ok", HI, HI, 1, 1),
        ("a", "error", HI, HI, 0, 0),
    ]
    df = spark.createDataFrame(
        rows,
        "run_id string, status string, sync_start timestamp, sync_end timestamp, fetched long, inserted long",
    )
    row = ingest.run_summary(df).first()
    assert (row.fetched, row.inserted, row.windows_completed) == (4, 3, 2)


@pytest.fixture
def landed(spark, tmp_path):
    path = str(tmp_path / "messages")

    def land(first, last, *, index=True):
        mails = spark.range(first, last).select(
            F.concat(F.lit("m"), "id").alias("message_id"),
            *(F.lit("x").alias(c) for c in ("thread_id", "sender")),
            F.timestamp_seconds(F.col("id") * 86_400).alias("received_at"),
        )
        days = (dt.date(1970, 1, 1) + dt.timedelta(days=n) for n in (first, last))
        ids.opened(spark, path, *days)
        tables.append_messages(mails, path)
        if index:
            ids.append(mails, path)

    return path, land


def indexed(spark, path):
    return sorted(r[0] for r in ids.read(spark, path).collect())


def test_only_the_batch_is_shuffled_against_the_landed_ids(spark, landed, plan_of):
    path, land = landed
    ids.repair(spark, path)
    land(0, 40)
    land(40, 60)
    batch = spark.range(30, 70).selectExpr(
        "id AS row_id", "concat('m', id) AS message_id", "timestamp_seconds(id * 86400) AS received_at", "0L AS digest"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        decided = ingest.decide(batch, ids.read(spark, path))
        plan = plan_of(decided)
        assert decided.filter("is_new").count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert "Bucketed: true" in plan and "hashpartitioning(message_id" in plan
    # the index is sorted and joined as it lies: between its scan and the join there is no exchange
    lines = plan.splitlines()
    at = next(i for i, text in enumerate(lines) if "Bucketed: true" in text)
    above, depth = [], indent(lines[at])
    for text in reversed(lines[:at]):
        if indent(text) < depth:
            above.append(text)
            depth = indent(text)
    join = next(i for i, text in enumerate(above) if "LeftAnti" in text)
    assert not any("Exchange" in text for text in above[:join])


def indent(text):
    return len(text) - len(text.lstrip(" :|+-"))


def test_index_catches_up_after_a_crash(spark, landed):
    path, land = landed
    land(0, 5)
    land(5, 9, index=False)  # the run ended between messages and ids
    assert len(indexed(spark, path)) == 5
    ids.repair(spark, path)
    assert indexed(spark, path) == sorted(f"m{n}" for n in range(9))
    ids.repair(spark, path)
    assert len(indexed(spark, path)) == 9


def test_missing_index_is_built_and_a_half_built_one_completed(spark, landed, monkeypatch):
    path, land = landed
    land(0, 5, index=False)
    files.drop(spark, f"{path}_ids")
    real = ids._add
    monkeypatch.setattr(ids, "_add", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError, match="gone"):
        ids.repair(spark, path)
    monkeypatch.setattr(ids, "_add", real)
    ids.repair(spark, path)
    assert len(indexed(spark, path)) == 5


def test_lease_admits_one_writer(spark, tmp_path):
    table = str(tmp_path / "messages")
    with lease.held(spark, table, "one") as renew:
        renew()
        with pytest.raises(lease.Taken, match="one"):
            lease.take(spark, table, "two")
    with lease.held(spark, table, "two"):
        pass
    assert not files.exists(spark, f"{table}_lease")


def test_dead_lease_is_taken_over_once(spark, tmp_path):
    table = str(tmp_path / "messages")
    lease.take(spark, table, "dead", minutes=-1)
    # another heir got there first
    files.create(spark, f"{table}_lease.after-dead", "heir")
    with pytest.raises(lease.Taken, match="heir"):
        lease.take(spark, table, "late")
    files.drop(spark, f"{table}_lease.after-dead")
    lease.take(spark, table, "new")
    with pytest.raises(lease.Taken):
        lease.renew(spark, table, "dead")
    lease.release(spark, table, "dead")
    assert files.exists(spark, f"{table}_lease")
    lease.release(spark, table, "new")


def test_files_are_replaced_in_one_step(spark, tmp_path):
    path = str(tmp_path / "pointer")
    assert files.read(spark, path) is None
    for text in ("one", "two ünï"):
        files.replace(spark, path, text, "t")
        assert files.read(spark, path) == text
    assert not files.create(spark, path, "three") and files.read(spark, path) == "two ünï"
