"""The sync job and its stream: commit protocol, retries, failures, caps."""

import base64
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from inboxlens.plans import build, sync
from inboxlens.sources import landing, tables
from inboxlens.streaming import mailstream

UTC = dt.timezone.utc
FLOOR = dt.date(2026, 3, 1)


def line(message_id, day, hour=1, body="x", labels=("INBOX",), **more):
    moment = dt.datetime(2026, 3, day, hour, tzinfo=UTC)
    data = base64.urlsafe_b64encode(body.encode()).decode()
    return json.dumps(
        {
            "id": message_id,
            "threadId": f"t{message_id}",
            "internalDate": str(int(moment.timestamp() * 1000)),
            "labelIds": list(labels),
            "snippet": "",
            "payload": {
                "mimeType": "text/plain",
                "headers": [{"name": "Subject", "value": "your application"}],
                "body": {"data": data},
            },
            **more,
        }
    )


@pytest.fixture
def box(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    targets = sync.Targets(*(str(tmp_path / n) for n in ("messages", "ledger", "bad")))

    class Box:
        def land(self, name, *lines):
            (folder / f"{name}.json").write_text("\n".join(lines) + "\n")

        def sync(self, until, **options):
            ceiling = dt.datetime(2026, 3, until, tzinfo=UTC)
            options.setdefault("id_buckets", 4)
            return sync.run(spark, str(folder), targets, floor=FLOOR, ceiling=ceiling, **options)

        def stream(self, **options):
            mailstream.start(
                spark, str(folder), targets, str(tmp_path / "checkpoint"), **options
            ).awaitTermination()

        def ids(self):
            found = tables.read_messages(spark, targets.messages)
            return sorted(r.message_id for r in found.collect()) if found else []

        def ledger(self):
            rows = tables.read_ledger(spark, targets.ledger).orderBy("started_at", "sync_start")
            return [
                (r.status, r.sync_start.day, r.sync_end.day, r.fetched, r.inserted)
                for r in rows.collect()
            ]

        def bad(self):
            found = tables.read_quarantine(spark, targets.quarantine)
            return sorted(r.reason for r in found.collect()) if found else []

    box = Box()
    box.targets = targets
    return box


def test_incremental_backfill_and_rerun(box):
    box.land("a", line("1", 1), line("2", 2), line("2", 2), line("other", 2, labels=["SPAM"]))
    first = box.sync(3)
    assert (first["fetched"], first["inserted"], first["windows_completed"]) == (3, 2, 2)
    assert box.ledger() == [("ok", 1, 2, 1, 1), ("ok", 2, 3, 2, 1)]
    box.land("b", line("3", 4), line("late", 1))
    second = box.sync(6)
    assert second["sync_start"] == "2026-03-03T00:00:00+00:00"
    # late mail is committed too, with a ledger row for its day
    assert (second["fetched"], second["inserted"], second["windows_completed"]) == (2, 2, 4)
    assert box.ledger()[2] == ("ok", 1, 2, 1, 1)
    assert box.sync(6)["windows_completed"] == 0
    backfill = box.sync(6, full_backfill=True)
    assert (backfill["fetched"], backfill["inserted"]) == (5, 0)
    assert box.ids() == ["1", "2", "3", "late"]


def test_files_with_old_times_and_copies_with_new_dates(box, tmp_path):
    import os

    box.land("a", line("1", 1))
    box.sync(2)
    box.land("old", line("2", 2), line("1", 3))
    os.utime(tmp_path / "landing" / "old.json", (10**9, 10**9))
    run = box.sync(4)
    assert (run["fetched"], run["inserted"]) == (2, 1)
    assert box.ids() == ["1", "2"]


def test_mail_beyond_the_ceiling_waits(box):
    box.land("a", line("1", 1), line("3", 3))
    assert box.sync(2)["inserted"] == 1
    assert box.sync(4)["inserted"] == 1
    assert box.ids() == ["1", "3"]


def test_groups_parse_the_landing_area_once(box, monkeypatch):
    calls = []
    real = landing.parse
    monkeypatch.setattr(landing, "parse", lambda *a, **k: calls.append(1) or real(*a, **k))
    box.land("a", *(line(str(d), d) for d in range(1, 5)))
    assert box.sync(5, windows_per_commit=1)["windows_completed"] == 4
    assert len(calls) == 1 and box.ids() == ["1", "2", "3", "4"]


def test_several_objects_on_a_line(box):
    box.land(
        "a", line("1", 1) + "," + line("2", 1), f"[{line('3', 1)}, {line('4', 1)}]",
        line("5", 1) + " " + line("6", 1), line("7", 1) + " trailing", "[]", f"[{line('8', 1)}]",
    )
    box.sync(2)
    assert box.ids() == ["1", "2", "3", "4", "8"]
    assert box.bad() == ["malformed json"] * 3


@pytest.mark.parametrize("levels", [5, 40])
def test_deep_messages_are_not_left_behind(box, spark, levels):
    def text(body):
        return {"mimeType": "text/plain", "body": {"data": base64.urlsafe_b64encode(body.encode()).decode().rstrip("=")}}

    hidden = {"mimeType": "text/plain", "filename": "a.txt", "parts": [text("hidden")]}
    part = {"mimeType": "multipart/mixed", "parts": [text("deep"), hidden, {"mimeType": "text/html", "body": {"data": "PGI-"}}]}
    for n in range(levels):
        part = {"mimeType": "multipart/mixed", "parts": [text(f"before {n}"), part, text(f"after {n}")]}
    part["headers"] = [{"name": "Subject", "value": "deep down"}]
    broken = {"mimeType": "x", "parts": [{"parts": [{"parts": [{"parts": [{"parts": [{"parts": [{"mimeType": "text/plain", "body": {"data": "Y"}}]}]}]}]}]}]}
    box.land("a", line("1", 1), line("2", 1, payload=part), line("3", 1, payload=broken))
    box.sync(2)
    assert box.ids() == ["1", "2"] and box.bad() == ["bad base64"]
    deep = tables.read_messages(spark, box.targets.messages).filter("message_id = '2'").first()
    order = [f"before {n}" for n in reversed(range(levels))] + ["deep"] + [f"after {n}" for n in range(levels)]
    assert (deep.plain_body, deep.html_body, deep.subject) == ("\n".join(order), "<b>", "deep down")


def test_files_of_any_name_are_read_once(box, tmp_path, monkeypatch):
    names = ["a b", "c[1]", "50%", "d%20e", "f+g", "{h,i}", "j?k", "l*m", "ünï", "n#o", "p=q", "r&s;t", "u'v"]
    for n, name in enumerate(names):
        box.land(name, line(str(n), 1))
    assert box.sync(2)["inserted"] == len(names)
    box.land("w x[2]", line("new", 2))
    read = []
    real = landing.parse
    monkeypatch.setattr(landing, "parse", lambda raw, **k: read.append(raw.count()) or real(raw, **k))
    assert box.sync(3)["inserted"] == 1
    assert read == [1]
    assert box.sync(3, full_backfill=True)["inserted"] == 0
    assert len(box.ids()) == len(names) + 1


@pytest.mark.parametrize("streamed", [False, True])
def test_patterns_in_names_read_no_file_twice(box, monkeypatch, streamed):
    for n, name in enumerate(["plain", "c[1]", "{h,i}", "j?k", "l*m", "c1", "back\\slash", "50%20"]):
        box.land(name, line(str(n), 1))
    read = []
    real = landing.parse
    monkeypatch.setattr(landing, "parse", lambda raw, **k: read.append(raw.count()) or real(raw, **k))
    box.stream() if streamed else box.sync(2)
    assert read == [8] and len(box.ids()) == 8
    assert sum(r[3] for r in box.ledger()) == 8


def test_bodies_meet_the_shorter_list_of_keys(box, plan_of, monkeypatch):
    box.land("a", *(line(str(k), 1) for k in range(9)))
    plans = []
    real = tables.append_messages
    monkeypatch.setattr(tables, "append_messages", lambda m, path: plans.append(plan_of(m)) or real(m, path))
    box.sync(2)
    box.sync(2, full_backfill=True)
    assert "LeftAnti" in plans[0] and "LeftSemi" in plans[1]
    assert len(box.ids()) == 9


def test_waiting_mail_is_kept_decoded_and_dropped_when_committed(box, spark):
    box.land("a", line("1", 1), line("2", 2), line("9", 9))
    area = f"{box.targets.ledger}_landing/rows"

    def waiting():
        return sorted(r.message_id for r in spark.read.schema(landing.STAGED).parquet(area).collect())

    box.sync(2)
    assert waiting() == ["2", "9"]
    box.sync(3)
    assert waiting() == ["9"]
    assert box.sync(10)["inserted"] == 1 and box.ids() == ["1", "2", "9"]


def test_rows_staged_by_a_crashed_run_are_committed_by_the_next(box, monkeypatch):
    box.land("a", line("1", 1), line("5", 5))
    box.sync(6)
    box.land("b", line("late", 2), line("7", 7))
    real = sync.decide
    monkeypatch.setattr(sync, "decide", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError, match="gone"):
        box.sync(8)
    monkeypatch.setattr(sync, "decide", real)
    again = box.sync(8)
    assert (again["fetched"], again["inserted"]) == (2, 2)
    assert box.ids() == ["1", "5", "7", "late"]


def test_crash_between_messages_and_their_ids(box, monkeypatch):
    box.land("a", line("1", 1), line("2", 2))
    monkeypatch.setattr(sync.ids, "append", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError, match="gone"):
        box.sync(3)
    monkeypatch.undo()
    assert box.ids() == ["1", "2"]
    assert box.sync(3)["inserted"] == 0
    box.land("b", line("1", 1), line("3", 3))
    assert box.sync(4)["inserted"] == 1 and box.ids() == ["1", "2", "3"]


def test_second_writer_is_refused(box, spark):
    from inboxlens.sources import lease

    box.land("a", line("1", 1))
    with lease.held(spark, box.targets.messages, "other"):
        with pytest.raises(lease.Taken, match="other"):
            box.sync(2)
    lease.take(spark, box.targets.messages, "dead", minutes=-1)
    assert box.sync(2)["inserted"] == 1


def test_search_string_as_predicate(box):
    box.land("a", line("1", 1), line("2", 1, labels=["SENT"]), line("3", 2, labels=["INBOX", "SPAM"]))
    box.sync(3, predicate="in:inbox -in:spam before:2026/03/02")
    assert box.ids() == ["1"]


def test_daily_commits_read_the_index_once(box, monkeypatch):
    calls = []
    real = sync.ids.read
    monkeypatch.setattr(sync.ids, "read", lambda *a: calls.append(1) or real(*a))
    box.land("a", *(line(str(d), d) for d in range(1, 6)))
    box.sync(6, windows_per_commit=1)
    assert len(calls) == 1 and len(box.ledger()) == 5


def test_bodies_cross_one_exchange(box, spark, plan_of, tmp_path):
    from inboxlens.operators import ingest
    from inboxlens.sources import ids

    box.land("a", line("1", 1))
    raw = landing.read(spark, str(tmp_path / "landing"))
    staged = landing.stage(raw, str(tmp_path / "rows"), ingested_at=dt.datetime(2026, 3, 2, tzinfo=UTC))
    narrow = ingest.decide(
        staged.select("row_id", "message_id", "received_at", "digest"), ids.read(spark, box.targets.messages)
    )
    assert "plain_body" not in plan_of(narrow)


def test_failed_window_blocks_the_watermark(box):
    def fails_on_2(m):
        return F.when(m["id"] == "2", F.raise_error(F.lit("boom")).cast("boolean")).otherwise(True)

    box.land("a", line("1", 1))
    box.sync(2, windows_per_commit=1)
    box.land("b", line("2", 2), line("3", 3))
    with pytest.raises(Exception, match="boom"):
        box.sync(4, windows_per_commit=1, predicate=fails_on_2)
    assert [r[:3] for r in box.ledger()] == [("ok", 1, 2), ("error", 2, 4)]
    assert box.ledger()[1][3:] == (0, 0)
    assert box.ids() == ["1"]
    done = box.sync(4)
    assert done["sync_start"].startswith("2026-03-02")
    assert box.ids() == ["1", "2", "3"]


def test_crash_between_data_and_ledger_loses_and_doubles_nothing(box, monkeypatch):
    box.land("a", line("1", 1), line("2", 2))
    real = tables.append_ledger
    monkeypatch.setattr(tables, "append_ledger", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError, match="gone"):
        box.sync(3)
    monkeypatch.setattr(tables, "append_ledger", real)
    assert box.ids() == ["1", "2"]
    again = box.sync(3)
    assert (again["fetched"], again["inserted"]) == (2, 0)
    assert box.ids() == ["1", "2"]


def test_cap_stops_at_the_full_window(box):
    box.land("a", line("1", 1), *(line(f"2{c}", 2, hour=h) for h, c in enumerate("dcba")), line("3", 3))
    run = box.sync(4, cap=2)
    assert (run["status"], run["inserted"], run["windows_completed"]) == ("capped", 3, 1)
    assert box.ids() == ["1", "2c", "2d"]
    assert box.ledger() == [("ok", 1, 2, 1, 1)]
    assert box.sync(4, cap=2)["status"] == "ok"
    assert box.ids() == ["1", "2a", "2b", "2c", "2d", "3"]


def test_bad_lines_are_kept_once(box):
    box.land("a", line("1", 1), "{broken", line(None, 1), json.dumps({"id": "x", "labelIds": ["INBOX"]}))
    box.sync(2)
    box.sync(3)
    assert box.ids() == ["1"]
    assert box.bad() == ["malformed json", "no internal date", "no message id"]


def test_empty_landing_area_is_ledgered(box):
    box.land("a", "")
    assert box.sync(3)["windows_completed"] == 2
    assert box.ledger() == [("ok", 1, 2, 0, 0), ("ok", 2, 3, 0, 0)]


def test_nothing_is_left_in_the_shared_folder(box, spark, tmp_path):
    from pathlib import Path

    box.land("a", line("1", 1))
    box.sync(2)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    assert not list(shared.glob("sync-*"))


def test_stream_picks_up_late_files_and_replays_nothing(box):
    box.land("a", line("1", 1), line("1", 1), "{broken")
    box.stream()
    box.land("b", line("2", 3), line("3", 5), line("1", 1))
    box.stream()
    box.land("c", line("late", 1))
    box.stream()
    assert box.ids() == ["1", "2", "3", "late"]
    assert [(r[1], r[3], r[4]) for r in box.ledger()] == [
        (1, 2, 1), (1, 1, 0), (3, 1, 1), (5, 1, 1), (1, 1, 1),
    ]
    assert box.bad() == ["malformed json"]
    box.stream()
    assert len(box.ids()) == 4


def test_build_writes_the_marts_and_passes_its_checks(box, spark, tmp_path):
    box.land("a", line("1", 1, body="Unfortunately"), line("2", 2))
    box.sync(3)
    marts = build.Marts(*(str(tmp_path / n) for n in ("emails", "apps", "meta")))
    as_of = dt.datetime(2026, 3, 4, tzinfo=UTC)
    report = build.build(spark, box.targets.messages, marts, as_of=as_of)
    assert {r.status for r in report.collect()} == {"pass"}
    assert report.count() == 27
    emails, apps, meta = build.read_marts(spark, marts)
    assert (emails.count(), apps.count(), meta.first().application_count) == (2, 2, 2)
    assert "received_date" in emails.columns and "latest_status_date" in apps.columns
    build.build(spark, box.targets.messages, marts, as_of=as_of)
    assert build.read_marts(spark, marts)[1].count() == 2
    source = build.audit_sources(spark, box.targets.messages, box.targets.ledger, as_of=as_of)
    assert source.filter("status = 'error'").count() == 0


def test_build_without_mail_and_without_job_mail(box, spark, tmp_path):
    marts = build.Marts(*(str(tmp_path / n) for n in ("emails", "apps", "meta")))
    as_of = dt.datetime(2026, 3, 4, tzinfo=UTC)
    # without any mail the declared check on the newest mail fails, and nothing is published
    with pytest.raises(ValueError, match="meta.not_null:data_through"):
        build.build(spark, box.targets.messages, marts, as_of=as_of)
    assert build.build(spark, box.targets.messages, marts, as_of=as_of, check=False).count() == 27
    assert [t.count() for t in build.read_marts(spark, marts)] == [0, 0, 1]
    box.land("a", line("1", 1, payload={"headers": [{"name": "Subject", "value": "dinner"}]}))
    box.sync(2)
    build.build(spark, box.targets.messages, marts, as_of=as_of)
    assert [t.count() for t in build.read_marts(spark, marts)] == [0, 0, 1]


def test_stale_mail_fails_the_build(box, spark, tmp_path):
    box.land("a", line("1", 1))
    box.sync(2)
    marts = build.Marts(*(str(tmp_path / n) for n in ("emails", "apps", "meta")))
    build.build(spark, box.targets.messages, marts, as_of=dt.datetime(2026, 3, 2, tzinfo=UTC))
    late = dt.datetime(2026, 3, 9, tzinfo=UTC)
    with pytest.raises(ValueError, match=r"staging.recency:received_at \(1\)"):
        build.build(spark, box.targets.messages, marts, as_of=late)
    # what was published stays
    assert build.read_marts(spark, marts)[2].first().mart_built_at.day == 2


def test_predicate_is_a_parameter(box):
    box.land("a", line("1", 1), line("2", 1, labels=["SENT"]))
    box.sync(2, predicate=None)
    assert box.ids() == ["1", "2"]
    assert landing.INBOX == "INBOX"


def test_marts_are_published_together(box, spark, tmp_path, monkeypatch):
    """A crash after any step leaves readers with the three marts of one build."""
    marts = build.Marts(*(str(tmp_path / n) for n in ("emails", "apps", "meta")))

    def made():
        emails, apps, meta = build.read_marts(spark, marts)
        row = meta.first()
        return emails.count(), apps.count(), row.application_count, row.mart_built_at.day

    box.land("a", line("1", 1))
    box.sync(2)
    build.build(spark, box.targets.messages, marts, as_of=dt.datetime(2026, 3, 2, tzinfo=UTC))
    before = build.read_marts(spark, marts)
    box.land("b", line("2", 2), line("3", 2))
    box.sync(3)
    later = dt.datetime(2026, 3, 4, tzinfo=UTC)
    steps = [(build.tables, n) for n in ("write_email_mart", "write_applications", "write_meta")]
    for owner, name in [*steps, (build.quality, "gate"), (build, "_publish")]:
        real = getattr(owner, name)

        def fails(*args, real=real, name=name):
            if name != "_publish":
                real(*args)
            raise OSError(f"after {name}")

        monkeypatch.setattr(owner, name, fails)
        with pytest.raises(OSError, match=name):
            build.build(spark, box.targets.messages, marts, as_of=later)
        monkeypatch.setattr(owner, name, real)
        assert made() == (1, 1, 1, 2)
    # a crash behind the rename: the new version is whole
    monkeypatch.setattr(build.files, "matching", lambda *_: (_ for _ in ()).throw(OSError("sweep")))
    with pytest.raises(OSError, match="sweep"):
        build.build(spark, box.targets.messages, marts, as_of=later)
    monkeypatch.undo()
    assert made() == (3, 3, 3, 4)
    # a reader that began before goes on with what it has
    assert [t.count() for t in before] == [1, 1, 1]
    for _ in range(2):
        build.build(spark, box.targets.messages, marts, as_of=later)
    assert len(list((tmp_path / "emails").iterdir())) == 2
    with pytest.raises(FileNotFoundError):
        build.read_marts(spark, build.Marts(*(str(tmp_path / f"no{n}") for n in range(3))))


def test_row_checks_cost_no_scan_of_their_own(box, spark, tmp_path, monkeypatch):
    from inboxlens.operators import quality

    box.land("a", line("1", 1), line("2", 2))
    box.sync(3)
    marts = build.Marts(*(str(tmp_path / n) for n in ("emails", "apps", "meta")))
    measured = []
    real = quality._measures
    monkeypatch.setattr(quality, "_measures", lambda checks: measured.append(len(checks)) or real(checks))
    checked = []
    whole = quality.check
    monkeypatch.setattr(quality, "check", lambda df, rules, **k: checked.append(k["table"]) or whole(df, rules, **k))
    as_of = dt.datetime(2026, 3, 4, tzinfo=UTC)
    report = build.build(spark, box.targets.messages, marts, as_of=as_of)
    assert checked == ["emails", "meta"]  # references, and the one row of meta
    assert report.count() == 27 and {r.status for r in report.collect()} == {"pass"}


def test_refresh_reads_new_mail_only(box, spark, tmp_path, monkeypatch):
    from inboxlens.operators import models
    from inboxlens.plans import refresh

    state = str(tmp_path / "threads")
    read = []
    real = models.staging
    monkeypatch.setattr(models, "staging", lambda df: read.append(sorted(r[0] for r in df.select("message_id").collect())) or real(df))

    def threads():
        done = refresh.refresh(spark, box.targets.messages, state)
        return sorted((r.thread_id, r.email_count) for r in done.collect())

    assert threads() == []
    box.land("a", line("1", 1), line("2", 2, threadId="t1"), line("5", 5, threadId="t1"))
    box.sync(3)
    assert threads() == [("t1", 2)]
    # mail that waited since the first sync is new when it is committed, and so is late mail
    box.land("b", line("3", 3), line("late", 1, threadId="t3"))
    box.sync(6)
    monkeypatch.setattr(refresh.files, "replace", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError, match="gone"):
        threads()
    monkeypatch.setattr(refresh.files, "replace", sync.files.replace)
    monkeypatch.undo()
    monkeypatch.setattr(models, "staging", lambda df: read.append(sorted(r[0] for r in df.select("message_id").collect())) or real(df))
    assert threads() == [("t1", 3), ("t3", 2)]
    assert threads() == [("t1", 3), ("t3", 2)]
    assert read == [[], ["1", "2"], ["3", "5", "late"], ["3", "5", "late"]]
