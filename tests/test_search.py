"""Search strings against messages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from inboxlens.functions import search
from inboxlens.schemas import landed_message

MAIL = {
    "id": "1",
    "snippet": "Let's schedule a call",
    "internalDate": str(int(dt.datetime(2026, 3, 5, 12, tzinfo=dt.timezone.utc).timestamp() * 1000)),
    "labelIds": ["INBOX", "UNREAD", "CATEGORY_UPDATES", "Jobs"],
    "payload": {
        "headers": [
            {"name": "subject", "value": "old subject"},
            {"name": "Subject", "value": "Interview for the Data Engineer role"},
            {"name": "From", "value": "Jane Doe <jane@globex.com>"},
        ]
    },
}


@pytest.fixture(scope="module")
def mail(spark):
    return spark.createDataFrame([(MAIL,), ({"id": "2"},)], landed_message(0).simpleString().join(("m ", "")))


@pytest.mark.parametrize(
    "query,holds",
    [
        ("", True), ("in:inbox", True), ("in:spam", False), ("in:anywhere", True), ("is:unread", True),
        ("is:read", False), ("label:jobs", True), ("category:updates", True), ("category:promotions", False),
        ("from:jane", True), ("from:GLOBEX.com", True), ("to:jane", False), ("-to:jane", True),
        ('subject:"data engineer"', True), ("subject:(data role)", True), ("subject:(data sales)", False),
        ("subject:{sales role}", True), ("subject:old", False), ("globex call", True), ('"a call"', True),
        ("nothing", False), ("in:spam OR in:inbox", True), ("in:spam OR in:inbox from:bob", False),
        ("from:bob OR from:jane OR from:eve in:inbox", True), ("{in:spam from:bob}", False),
        ("-(in:inbox from:jane)", False), ("--in:inbox", True), ("after:2026/03/05", True), ("before:2026/03/05", False),
        ("after:1772668800 before:1772755200", True), ("newer:2026-03-06", False), ("older:2026-03-06", True),
        ("()", True), ("{}", True), ("snippet-free", False), ("let's", True),
    ],
)
def test_searches(mail, query, holds):
    found = [r[0] for r in mail.filter(search.predicate(query)(F.col("m"))).select("m.id").collect()]
    assert ("1" in found) == holds


def test_messages_without_values_are_no_error(mail):
    for query in ("from:x", "-from:x", "in:inbox", "-in:inbox", "word", "-word", "after:5", "-after:5"):
        got = "2" in [r[0] for r in mail.filter(search.predicate(query)(F.col("m"))).select("m.id").collect()]
        assert got == query.startswith("-")


@pytest.mark.parametrize(
    "query", ["size:5", "(in:inbox", "in:inbox)", "OR a", "a OR", "a OR OR b", "{a", "a}", "after:soon", 'a "open', "from:"]
)
def test_strings_that_cannot_be_read(query):
    with pytest.raises(ValueError, match="cannot be read"):
        search.predicate(query)
