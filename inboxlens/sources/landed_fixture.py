"""Landed message JSON built from the test tables, for round trips and sync runs.

Each line is a multipart message: a nested alternative holds the text and an HTML copy, and
an attachment hides a text that must never be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ATTACHMENT = "scan.txt"


def landed_from_mail(mail: DataFrame, *keep: str) -> DataFrame:
    """One JSON line per mail of the mail relation, beside the columns to keep."""
    return mail.select(
        *keep,
        _line(
            message_id=F.col("message_id"),
            thread_id=F.col("thread_id"),
            snippet=F.col("snippet"),
            labels=F.split("labels", ","),
            received_at=F.col("received_at"),
            headers=[("Subject", F.col("subject")), ("From", F.col("sender"))],
            text=F.col("plain_body"),
        ).alias("value")
    )


def landed_from_documents(documents: DataFrame) -> DataFrame:
    """One JSON line per document, its whole text as the body; headers repeat a name."""
    return documents.select(
        _line(
            message_id=F.col("doc_id").cast("string"),
            thread_id=F.col("source"),
            snippet=F.col("lang"),
            labels=F.array(F.lit("INBOX"), F.col("lang")),
            received_at=F.lit(None).cast("timestamp"),
            headers=[("SUBJECT", F.col("source")), ("subject", F.col("lang"))],
            text=F.col("text"),
        ).alias("value")
    )


def landed_from_pages(pages: DataFrame) -> DataFrame:
    """One JSON line per page; the page source is the HTML body."""
    return pages.select(
        _message(
            message_id=F.col("page_id").cast("string"),
            thread_id=F.col("url"),
            snippet=F.lit(""),
            labels=F.array(F.lit("INBOX")),
            received_at=F.lit(None).cast("timestamp"),
            headers=[("Subject", F.col("url"))],
            parts=F.array(_leaf("text/html", base64url(F.col("html")))),
        ).alias("value")
    )


def damaged(documents: DataFrame) -> DataFrame:
    """Lines of documents, of which five in twelve are damaged, each kind in its own way."""
    whole = landed_from_documents(documents.select("*")).withColumn(
        "k", F.get_json_object("value", "$.id").cast("bigint") % 12
    )
    line, start = F.col("value"), F.lit('{"id":')
    dated = F.replace(line, start, F.lit('{"internalDate":"1704067200000","id":'))
    return whole.select(
        F.when(F.col("k") == 1, F.substring(line, 1, 20))
        .when(F.col("k") == 2, F.concat(line, F.lit(" "), line))
        .when(F.col("k") == 4, F.replace(line, start, F.lit('{"idx":')))
        .when(F.col("k") == 5, F.replace(line, start, F.lit('{"internalDate":"soon","id":')))
        .when(F.col("k") == 7, F.regexp_replace(dated, '"data":"[^"]*"', '"data":"Y"'))
        .when(F.col("k") == 8, F.concat(F.lit("["), line, F.lit("]")))
        .otherwise(line)
        .alias("value")
    )


def landed_from_turns(conversations: DataFrame, levels: int = 1) -> DataFrame:
    """One JSON line per turn; role and text are two plain parts, ``levels`` deep."""
    role = _leaf("text/plain", base64url(F.col("role")))
    text = _leaf("text/plain", base64url(F.col("text")))
    for _ in range(levels - 1):
        role, text = (_parent("multipart/related", F.array(part)) for part in (role, text))
    return conversations.select(
        _message(
            message_id=F.concat_ws("/", "conv_id", "turn"),
            thread_id=F.col("conv_id").cast("string"),
            snippet=F.col("role"),
            labels=F.array(F.lit("INBOX")),
            received_at=F.lit(None).cast("timestamp"),
            headers=[],
            parts=F.array(
                _parent("multipart/related", F.array(role)),
                _parent("multipart/related", F.array(text)),
            ),
        ).alias("value")
    )


def base64url(text: Column) -> Column:
    """Unpadded base64url of the UTF-8 bytes of a text, on one line."""
    encoded = F.base64(F.encode(text, "UTF-8"))
    for old, new in (("+", "-"), ("/", "_"), ("=", ""), ("\r\n", "")):
        encoded = F.replace(encoded, F.lit(old), F.lit(new))
    return encoded


def _line(
    *,
    message_id: Column,
    thread_id: Column,
    snippet: Column,
    labels: Column,
    received_at: Column,
    headers: list[tuple[str, Column]],
    text: Column,
) -> Column:
    body = _leaf("text/plain", base64url(text))
    page = _leaf("text/html", base64url(F.concat(F.lit("<p>"), text, F.lit("</p>"))))
    hidden = _leaf("text/plain", base64url(F.lit("never read")))
    parts = F.array(
        _parent("multipart/alternative", F.array(body, page)),
        _parent("message/rfc822", F.array(hidden), filename=ATTACHMENT),
    )
    return _message(
        message_id=message_id,
        thread_id=thread_id,
        snippet=snippet,
        labels=labels,
        received_at=received_at,
        headers=headers,
        parts=parts,
    )


def _message(
    *,
    message_id: Column,
    thread_id: Column,
    snippet: Column,
    labels: Column,
    received_at: Column,
    headers: list[tuple[str, Column]],
    parts: Column,
) -> Column:
    pairs = F.array(
        *(F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in headers)
    ).cast("array<struct<name:string,value:string>>")
    payload = F.struct(
        F.lit("multipart/mixed").alias("mimeType"),
        F.filter(pairs, lambda h: h["value"].isNotNull()).alias("headers"),
        parts.alias("parts"),
    )
    return F.to_json(
        F.struct(
            message_id.alias("id"),
            thread_id.alias("threadId"),
            F.concat(F.lit("h"), message_id).alias("historyId"),
            snippet.alias("snippet"),
            F.unix_millis(received_at).cast("string").alias("internalDate"),
            labels.alias("labelIds"),
            payload.alias("payload"),
        )
    )


def _leaf(mime: str, data: Column) -> Column:
    return F.struct(F.lit(mime).alias("mimeType"), F.struct(data.alias("data")).alias("body"))


def _parent(mime: str, parts: Column, filename: str = "") -> Column:
    return F.struct(
        F.lit(mime).alias("mimeType"),
        F.lit(filename).alias("filename"),
        parts.alias("parts"),
    )
