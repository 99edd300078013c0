"""Mail search strings as predicates over a landed message.

The grammar is that of the mail service's search box, as far as landed messages carry what it asks
for: ``in:``, ``label:``, ``is:``, ``category:``, ``from:``, ``to:``, ``subject:``, ``after:``, ``before:`` (epoch
seconds or a date), bare words and ``"phrases"``.  Terms side by side must all hold; ``OR`` joins the
two terms next to it; ``{a b}`` holds where one of its terms does; ``( )`` groups; ``-`` negates.  Words and
phrases are looked for in subject, sender, recipient and snippet, whatever their case.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from inboxlens.functions.clock import instant

_TOKEN = re.compile(r'\s*(?:(-)(?=\S)|([(){}])|([A-Za-z]+):(?=\S)|"([^"]*)"|([^\s(){}"]+))')
_DATE = re.compile(r"(\d{4})[/-](\d{1,2})[/-](\d{1,2})$")
# --- fixed values: names of the search box and the labels they stand for ---
_PLACES = {"draft": "DRAFT", "drafts": "DRAFT", "inbox": "INBOX", "sent": "SENT", "spam": "SPAM",
           "starred": "STARRED", "trash": "TRASH", "important": "IMPORTANT", "unread": "UNREAD"}
_ANYWHERE = "anywhere"
_FIELDS = ("after", "before", "category", "from", "in", "is", "label", "newer", "older", "subject", "to")
# --- end of fixed values ---

Message = Column
Test = Callable[[Message], Column]


def predicate(query: str) -> Test:
    """The predicate that a search string stands for; an empty one holds for all mail.

    A string that cannot be read raises ``ValueError``.
    """
    return _Reader(query).read()


class _Reader:
    def __init__(self, query: str) -> None:
        self.query, self.tokens, at = query, [], 0
        text = query.rstrip()
        while at < len(text):
            found = _TOKEN.match(text, at)
            if not found:
                raise self.error(f"at {text[at:]!r}")
            kind = ("-", "bracket", "field", "phrase", "word")[found.lastindex - 1]
            if kind == "word" and found[5].removesuffix(":").lower() in _FIELDS and found[5][-1] == ":":
                raise self.error(f"at {found[5]!r}")
            self.tokens.append((kind, found[found.lastindex]))
            at = found.end()

    def error(self, what: str) -> ValueError:
        return ValueError(f"search {self.query!r} cannot be read {what}")

    def read(self) -> Test:
        test = self.terms(None, None, _all)
        if self.tokens:
            raise self.error(f"beyond {self.tokens[0][1]!r}")
        return test

    def terms(self, closing: str | None, field: str | None, joined) -> Test:
        """Terms up to a closing bracket; ``OR`` joins its two neighbours first."""
        tests: list[Test] = []
        either = False
        while self.tokens and self.tokens[0] != ("bracket", closing):
            if self.tokens[0] == ("word", "OR"):
                if either or not tests:
                    raise self.error("at OR")
                self.tokens.pop(0)
                either = True
                continue
            test = self.term(field)
            tests = [*tests[:-1], _any([tests[-1], test])] if either else [*tests, test]
            either = False
        if either or (closing and not self.tokens):
            raise self.error("at its end")
        if closing:
            self.tokens.pop(0)
        return joined(tests)

    def term(self, field: str | None) -> Test:
        if not self.tokens:
            raise self.error("at its end")
        kind, text = self.tokens.pop(0)
        if kind == "-":
            test = self.term(field)
            return lambda m: ~test(m)
        if kind == "bracket":
            if text in ")}":
                raise self.error(f"at {text}")
            return self.terms(")" if text == "(" else "}", field, _all if text == "(" else _any)
        if kind == "field":
            if text.lower() not in _FIELDS:
                raise self.error(f"at the unknown {text}:")
            return self.term(text.lower())
        return _leaf(self, field, text)


def _all(tests: list[Test]) -> Test:
    return lambda m: reduce(lambda a, b: a & b, (t(m) for t in tests), F.lit(True))


def _any(tests: list[Test]) -> Test:
    return lambda m: reduce(lambda a, b: a | b, (t(m) for t in tests), F.lit(not tests))


def _leaf(reader: _Reader, field: str | None, text: str) -> Test:
    """One word under a field, or anywhere; false where the message has no such value."""
    if field in ("after", "newer", "before", "older"):
        moment = _moment(reader, text)
        later = field in ("after", "newer")
        return lambda m: _told(_received(m) >= moment if later else _received(m) < moment)
    if field == "in" and text.lower() == _ANYWHERE:
        return lambda m: F.lit(True)
    if field == "is" and text.lower() == "read":
        return lambda m: ~_labelled(m, "UNREAD")
    if field in ("in", "is"):
        return lambda m: _labelled(m, _PLACES.get(text.lower(), text.upper()))
    if field == "label":
        return lambda m: _labelled(m, text.upper())
    if field == "category":
        return lambda m: _labelled(m, f"CATEGORY_{text.upper()}")
    if field:
        return lambda m: _holds(_header(m, field), text)
    places = lambda m: (*(_header(m, h) for h in ("subject", "from", "to")), m["snippet"])
    return lambda m: reduce(lambda a, b: a | b, (_holds(p, text) for p in places(m)))


def _moment(reader: _Reader, text: str) -> Column:
    if text.isdigit():
        return F.timestamp_seconds(F.lit(int(text)))
    found = _DATE.match(text)
    if not found:
        raise reader.error(f"at the date {text!r}")
    return instant(dt.datetime(*(int(g) for g in found.groups()), tzinfo=dt.timezone.utc))


def _told(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def _received(m: Message) -> Column:
    return F.timestamp_millis(m["internalDate"].try_cast("bigint"))


def _labelled(m: Message, label: str) -> Column:
    return _told(F.exists(m["labelIds"], lambda one: F.upper(one) == label))


def _header(m: Message, name: str) -> Column:
    named = F.filter(m["payload"]["headers"], lambda h: F.lower(h["name"]) == name)
    return F.try_element_at(named, F.lit(-1))["value"]


def _holds(value: Column, text: str) -> Column:
    return _told(F.contains(F.lower(value), F.lit(text.lower())))
