"""Raw-message cases: headers, MIME walk, decoding, quarantine."""

import base64
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from inboxlens.sources import landing

NOW = dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc)


def b64(data, pad=False):
    raw = data if isinstance(data, bytes) else data.encode()
    text = base64.urlsafe_b64encode(raw).decode()
    return text if pad else text.rstrip("=")


def leaf(mime, text, **more):
    return {"mimeType": mime, "body": {"data": b64(text)}, **more}


def plain(text, **more):
    return leaf("text/plain", text, **more)


def message(payload=None, **more):
    return {"id": "m", "internalDate": "1772323200123", "payload": payload or {}, **more}


def nested(depth, inner):
    part = inner
    for _ in range(depth):
        part = {"mimeType": "multipart/mixed", "parts": [part]}
    return part


@pytest.fixture(scope="module")
def flat(spark):
    def run(*messages, **options):
        lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
        raw = spark.createDataFrame([(line,) for line in lines], "value string")
        good, bad = landing.flatten(raw, ingested_at=NOW, **options)
        return good.collect(), bad.collect()

    return run


def only(result):
    good, bad = result
    assert bad == []
    return good[0]


def test_headers_any_case_last_wins(flat):
    headers = [
        {"name": "Subject", "value": "first"},
        {"name": "FROM", "value": "a@b.c"},
        {"name": "sUBJECT", "value": "last"},
        {"name": "To", "value": "me"},
        {"name": "Date", "value": "Sun, 1 Mar 2026"},
    ]
    row = only(flat(message({"headers": headers}, threadId="t", historyId="7", snippet="s")))
    assert (row.subject, row.sender, row.recipient, row.date) == ("last", "a@b.c", "me", "Sun, 1 Mar 2026")
    assert (row.thread_id, row.history_id, row.snippet) == ("t", "7", "s")


def test_empty_payload(flat):
    row = only(flat({"id": "m"}))
    assert (row.subject, row.sender, row.plain_body, row.html_body, row.labels) == (None, None, "", "", "")
    assert row.received_at is None


def test_walk_is_pre_order_and_joins_by_newline(flat):
    payload = {
        "mimeType": "multipart/mixed",
        "parts": [
            {
                "mimeType": "multipart/alternative",
                "parts": [plain("one", parts=[plain("two")]), leaf("text/html", "<p>")],
            },
            plain("three"),
            leaf("TEXT/PLAIN", "wrong case"),
            leaf("text/calendar", "no"),
        ],
    }
    row = only(flat(message(payload)))
    assert (row.plain_body, row.html_body) == ("one\ntwo\nthree", "<p>")


def test_attachments_hide_their_subtree(flat):
    payload = {
        "mimeType": "multipart/mixed",
        "filename": "",
        "parts": [
            plain("hidden", filename="a.txt", parts=[plain("child")]),
            {
                "mimeType": "text/plain",
                "body": {"attachmentId": "x", "data": b64("hidden")},
                "parts": [plain("child")],
            },
            plain("seen"),
        ],
    }
    assert only(flat(message(payload))).plain_body == "seen"


def test_decoding(flat):
    odd = "ÿþ>>>???~~\U0001f600"
    assert set(b64(odd)) & set("-_")
    assert only(flat(message(plain(odd)))).plain_body == odd
    assert only(flat(message({"mimeType": "text/plain", "body": {"data": b64("ab", pad=True)}}))).plain_body == "ab"
    bad = b"a\xe2\x82z\xff"
    assert only(flat(message(plain(bad)))).plain_body == bad.decode(errors="replace")
    assert only(flat(message({"mimeType": "text/plain", "body": {"data": ""}}))).plain_body == ""


def test_body_cap_counts_characters(flat):
    row = only(flat(message(plain("\U0001f600" * 5)), max_body_chars=3))
    assert row.plain_body == "\U0001f600" * 3
    assert len(only(flat(message(plain("x" * 600_000)))).plain_body) == 600_000
    assert len(only(flat(message(plain("x" * 600_000)), max_body_chars=512_000)).plain_body) == 512_000


def test_dates_and_labels(flat, spark):
    row = only(flat(message(labelIds=["INBOX", "STARRED"])))
    assert row.labels == "INBOX,STARRED"
    good, _ = landing.flatten(
        spark.createDataFrame([(json.dumps(message()),)], "value string"), ingested_at=NOW
    )
    assert good.select(F.unix_millis("received_at")).first()[0] == 1772323200123
    assert only(flat(message(internalDate=""))).received_at is None
    assert only(flat(message(internalDate=1772323200123))).received_at is not None


def test_bad_lines_are_quarantined_whole(flat):
    short = {"mimeType": "text/plain", "body": {"data": "Y"}}
    lines = [
        "{not json",
        json.dumps({"id": None, "internalDate": "1"}),
        json.dumps(message(internalDate="soon")),
        json.dumps(message(short)),
        json.dumps(message(nested(5, plain("deep")))),
        json.dumps(message(plain("fine"))),
    ]
    good, bad = flat(*lines, depth=3)
    assert [g.plain_body for g in good] == ["fine"]
    assert {b.reason: b.value for b in bad} == dict(
        zip(
            ["malformed json", "no message id", "bad internal date", "bad base64", "mime too deep"],
            lines,
        )
    )


def test_deep_messages_flatten_with_more_depth(flat):
    deep = message(nested(20, plain("deep")))
    good, bad = flat(deep)
    assert good == [] and bad[0].reason == "mime too deep"
    assert only(flat(bad[0].value, depth=24)).plain_body == "deep"
    assert only(flat(message(nested(8, plain("just"))))).plain_body == "just"
    hidden = nested(8, plain("x", parts=[]))
    assert only(flat(message(hidden))).plain_body == "x"


def test_blank_lines_are_skipped(flat):
    good, bad = flat("", "   ", json.dumps(message()))
    assert (len(good), len(bad)) == (1, 0)


def test_a_deep_walk_writes_a_table_for_many_levels(spark, tmp_path, monkeypatch):
    lines = [(json.dumps(message({"mimeType": "x", "parts": [nested(40, plain("deep")), plain("last")]})),)]
    steps = []
    drop = landing.files.drop
    monkeypatch.setattr(
        landing.files, "drop", lambda s, path: steps.extend(landing.files.matching(s, f"{path}/*")) or drop(s, path)
    )
    staged = landing.stage(spark.createDataFrame(lines, "value string"), str(tmp_path / "rows"), ingested_at=NOW)
    assert [r.plain_body for r in landing.messages_of(staged).collect()] == ["deep\nlast"]
    assert 1 < len(steps) <= 6


def test_sound_lines_are_walked_once(flat, monkeypatch):
    failing = lambda c: F.raise_error(F.lit("walked twice")).cast("int")
    monkeypatch.setattr(landing.F, "json_array_length", failing)
    good, bad = flat(message(plain("a, {b} [c]")), json.dumps(message(plain("d"), id="n")) + " ")
    assert [r.message_id for r in good] == ["m", "n"] and bad == []


def test_lines_that_look_like_one_object(flat):
    whole = json.dumps(message(plain("x")))
    good, bad = flat('{"id": "a"}],"_landed":[{"id": "b"}', f"[{whole}]", f"{whole}, {whole}")
    assert [r.message_id for r in good] == ["a", "m", "m", "m"] and bad == []
    good, bad = flat('{"id": NaN}', '{"labelIds": 7, "id": "m"}', "null", f"{whole} {whole}", whole[:30])
    assert good == [] and len(bad) == 5
