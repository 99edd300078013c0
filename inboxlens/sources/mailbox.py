"""A mail relation derived from the ``events`` test table.

The test tables hold no job-search mail, so every event becomes one mail: the event gives
identity, thread and time, and one of sixteen fixed templates gives the text.  The template
list has a fixed size, which is why it may be broadcast.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


class Template(NamedTuple):
    k: int
    sender: str
    subject: str | None
    snippet: str
    plain_body: str | None
    labels: str | None


TEMPLATES = (
    Template(0, '"Acme Careers" <jobs@acme.com>', "Your application to Acme",
             "application received, thanks", "hi", "INBOX"),
    Template(1, "no-reply@greenhouse.io", "Thank you for applying to Stripe",
             "We got it", "x", "INBOX"),
    Template(2, "Jane Doe <jane@globex.com>", "Interview for the Data Engineer role",
             "let's schedule a call", "x", "INBOX"),
    Template(3, "hr@initech.com", "Update on your candidacy position",
             "hello", "Unfortunately we will not continue", "INBOX"),
    Template(4, "lou@umbrella-corp.com", "Job offer", "Congratulations", "x", "INBOX"),
    Template(5, "r@hire.lever.co", "Open role at Hooli",
             "I came across your profile", "x", "INBOX"),
    Template(6, "deals@shop.com", "job sale", "offer", "x", "INBOX,CATEGORY_PROMOTIONS"),
    Template(7, "jobs@acme.com", "Your application", "hello", "x", None),
    Template(8, "x@indeed.com", None, "interview invitation", "x", "INBOX"),
    Template(9, "mom@gmail.com", "dinner", "see you", "x", "INBOX"),
    Template(10, "n@ashbyhq.com", "Applying for the Staff Engineer position at Foo",
             "hello", None, "INBOX"),
    Template(11, "q@q.com", "caféoffer position", "hello", "x", "INBOX"),
    Template(12, '"Ops" <ops@wonka.com>', "Job alert", "hello", "x", "INBOX"),
    Template(13, "x@clever.com", "Newsletter", "hello", "x", "INBOX"),
    Template(14, '"Talent Team" <t@wayne.com>', "Career chat", "hello", "x", "INBOX"),
    Template(15, '"No-Reply" <no-reply@hooli.com>', "Your application was submitted",
             "thanks", "Thank you for your interest in Hooli Labs.", "INBOX"),
)
UNTHREADED = 12


def mail_from_events(events: DataFrame) -> DataFrame:
    """Mail with message id, thread id, text, labels and UTC timestamps."""
    templates = events.sparkSession.createDataFrame(
        [t._asdict() for t in TEMPLATES],
        "k int, sender string, subject string, snippet string, plain_body string, labels string",
    )
    k = ((F.col("event_id") * 7 + F.col("user_id")) % len(TEMPLATES)).cast("int")
    thread = F.concat_ws("-", F.col("user_id"), F.col("event_id") % 25)
    received_at = F.col("ts").cast("timestamp")
    return (
        events.select(
            F.col("event_id").cast("string").alias("message_id"),
            F.when(k != UNTHREADED, thread).alias("thread_id"),
            received_at.alias("received_at"),
            (received_at + F.expr("INTERVAL 1 HOUR")).alias("ingested_at"),
            k.alias("k"),
        )
        .join(F.broadcast(templates), "k")
        .drop("k")
    )


#: Senders of mail made from documents: every source system, and names that try the rules.
SENDERS = (
    *(
        f'"{name} Hiring Team" <no-reply@mail.{domain}>'
        for name, domain in (
            ("Vandelay", "greenhouse.io"), ("Kramerica", "lever.co"), ("Pendant", "ashbyhq.com"),
            ("Monk", "myworkday.com"), ("Sacrimoni", "workday.com"),
            ("Tessmacher", "smartrecruiters.com"), ("Krusty Krab", "icims.com"),
            ("Bluth", "bamboohr.com"), ("Oceanic", "recruitee.com"), ("Dharma", "jobvite.com"),
            ("Massive Dynamic", "taleo.net"), ("Soylent", "workable.com"), ("Tyrell", "breezy.hr"),
            ("Cyberdyne", "linkedin.com"), ("Weyland", "indeed.com"), ("Nakatomi", "ziprecruiter.com"),
            ("Wernham", "wellfound.com"), ("Dunder", "hire.com"),
        )
    ),
    "jobs@north-star-labs.co.uk",
    '"Café Müller GmbH Recruiting" <jobs@cafe-mueller.de>',
    '"' + "A very long sender name " * 4 + '" <jobs@long-names.org>',
    "career\u017f <jobs@career\u017f-office.com>",
    '"\u212aelvin Talent Acqui\u017fition" <jobs@kelvin.io>',
    "x <jobs@x.io>",
    "talent@gmail.com",
)
SUBJECTS = (
    "Your application to Globex Corporation",
    "Applying for the Senior Data-Engineer po\u017fition",
    "Interview for the Site Reliability Engineer role",
    "Product Manager opportunity at Initech",
    "An update on your application",
    "Job offer",
    "Thank you for your application with \u212aelvin & Sons",
    "Open role: let's talk about a po\u017fition",
)
CLOSINGS = (
    "Thank you for applying to Initrode Systems.",
    "Unfortunately, we have decided to move forward with other candidates.",
    "You wrote that you are applying for the Head of \u212anitting role here.",
    "Thank you for your intere\u017ft in joining Hooli Labs",
    "We received your application for Massive Dynamic and look forward to an interview.",
    "",
    "application received at Umbrella-Works yesterday",
)


def mail_from_documents(documents: DataFrame) -> DataFrame:
    """One mail per document: its whole text, then a closing sentence, is the body."""
    ident = F.col("doc_id")
    received_at = F.timestamp_seconds(F.lit(1_704_067_200) + ident * 60)
    body = F.concat_ws("\n", "text", _pick(CLOSINGS, ident))
    return documents.select(
        ident.cast("string").alias("message_id"),
        F.concat_ws("-", "source", ident % 50).alias("thread_id"),
        _pick(SENDERS, ident).alias("sender"),
        _pick(SUBJECTS, ident).alias("subject"),
        F.col("lang").alias("snippet"),
        body.alias("plain_body"),
        F.lit("INBOX").alias("labels"),
        received_at.alias("received_at"),
        received_at.alias("ingested_at"),
    )


def mail_from_turns(conversations: DataFrame) -> DataFrame:
    """One mail per turn of a conversation, its text as the body."""
    received_at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("conv_id") * 60 + F.col("turn"))
    return conversations.select(
        F.concat_ws("/", "conv_id", "turn").alias("message_id"),
        F.col("conv_id").cast("string").alias("thread_id"),
        F.concat(F.lit("jobs@"), "role", F.lit(".com")).alias("sender"),
        F.concat(F.lit("Application of the "), "role").alias("subject"),
        F.substring("text", 1, 80).alias("snippet"),
        F.concat_ws("\n", "text", _pick(CLOSINGS, F.col("conv_id") + F.col("turn"))).alias("plain_body"),
        F.lit("INBOX").alias("labels"),
        received_at.alias("received_at"),
        received_at.alias("ingested_at"),
    )


def _pick(values: tuple[str, ...], number: Column) -> Column:
    listed = F.array(*(F.lit(v) for v in values))
    return F.element_at(listed, (number % len(values) + 1).cast("int"))


def mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mail_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def ledger_from_events(events: DataFrame) -> DataFrame:
    """A run ledger over the days of the events: three days in seven failed.

    Every weekday belongs to one run.  Failed days report no counts.
    """
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    daily = events.groupBy(day.alias("sync_start")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("ts").cast("timestamp")).alias("newest")
    )
    failed = F.dayofweek("sync_start") > 4
    return daily.select(
        F.concat(F.lit("run-"), F.dayofweek("sync_start")).alias("run_id"),
        F.col("newest").alias("started_at"),
        (F.col("newest") + F.expr("INTERVAL 5 MINUTES")).alias("finished_at"),
        F.when(failed, "error").otherwise("ok").alias("status"),
        "sync_start",
        (F.col("sync_start") + F.expr("INTERVAL 1 DAY")).alias("sync_end"),
        F.when(failed, F.lit(0)).otherwise(F.col("n")).cast("bigint").alias("fetched"),
        F.when(failed, F.lit(0)).otherwise(F.col("n")).cast("bigint").alias("inserted"),
        F.when(failed, "RuntimeError: quota").alias("error"),
    )
