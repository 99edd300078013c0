"""Declared schemas.  Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# --- tables ----------------------------------------------------------------

MESSAGES = T.StructType(
    [
        T.StructField("message_id", T.StringType(), False),
        T.StructField("thread_id", T.StringType()),
        T.StructField("history_id", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("sender", T.StringType()),
        T.StructField("recipient", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("snippet", T.StringType()),
        T.StructField("plain_body", T.StringType()),
        T.StructField("html_body", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("received_at", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType(), False),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("finished_at", T.TimestampType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("sync_start", T.TimestampType(), False),
        T.StructField("sync_end", T.TimestampType(), False),
        T.StructField("fetched", T.LongType()),
        T.StructField("inserted", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("payload_sha", T.StringType(), False),
        T.StructField("reason", T.StringType(), False),
        T.StructField("value", T.StringType()),
        T.StructField("quarantined_at", T.TimestampType(), False),
    ]
)

STAGING_COLUMNS = (
    "message_id",
    "thread_id",
    "sender",
    "subject",
    "snippet",
    "plain_body",
    "labels",
    "received_at",
    "ingested_at",
)

EMAIL_MART_COLUMNS = (
    "message_id",
    "thread_id",
    "sender",
    "subject",
    "snippet",
    "plain_body",
    "labels",
    "received_at",
    "job_pipeline_category",
)

APPLICATION_COLUMNS = (
    "application_id",
    "company",
    "role",
    "ats_source",
    "applied_at",
    "first_email_at",
    "last_email_at",
    "email_count",
    "latest_status_at",
    "has_interview",
    "has_offer",
    "has_rejection",
    "has_recruiter_outreach",
    "is_no_response",
    "outcome",
    "days_in_pipeline",
)

EMAIL_MART = T.StructType(
    [
        T.StructField(
            name, T.TimestampType() if name == "received_at" else T.StringType()
        )
        for name in EMAIL_MART_COLUMNS
    ]
)

_APPLICATION_TYPES = {
    "applied_at": T.TimestampType(),
    "first_email_at": T.TimestampType(),
    "last_email_at": T.TimestampType(),
    "email_count": T.LongType(),
    "latest_status_at": T.TimestampType(),
    "has_interview": T.BooleanType(),
    "has_offer": T.BooleanType(),
    "has_rejection": T.BooleanType(),
    "has_recruiter_outreach": T.BooleanType(),
    "is_no_response": T.BooleanType(),
    "days_in_pipeline": T.LongType(),
}
APPLICATIONS = T.StructType(
    [
        T.StructField(name, _APPLICATION_TYPES.get(name, T.StringType()))
        for name in APPLICATION_COLUMNS
    ]
)

META = T.StructType(
    [
        T.StructField("mart_built_at", T.TimestampType()),
        T.StructField("data_through", T.TimestampType()),
        T.StructField("application_count", T.LongType()),
    ]
)

# --- landed message JSON ---------------------------------------------------

MIME_DEPTH = 8


def mime_part(depth: int) -> T.StructType:
    """A MIME part with ``depth`` further levels of children.

    Spark has no recursive types.  The deepest level declares ``parts`` as a string, for
    which ``from_json`` hands back the raw text, so that deeper nesting is seen rather
    than lost.
    """
    children = T.ArrayType(mime_part(depth - 1)) if depth > 0 else T.StringType()
    return T.StructType(
        [
            T.StructField("mimeType", T.StringType()),
            T.StructField("filename", T.StringType()),
            T.StructField(
                "body",
                T.StructType(
                    [
                        T.StructField("data", T.StringType()),
                        T.StructField("attachmentId", T.StringType()),
                    ]
                ),
            ),
            T.StructField("parts", children),
        ]
    )


def landed_message(depth: int = MIME_DEPTH) -> T.StructType:
    """Schema of one landed message; ``_malformed`` receives text that does not fit."""
    header = T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]
    )
    payload = T.StructType(
        [T.StructField("headers", T.ArrayType(header)), *mime_part(depth).fields]
    )
    return T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("threadId", T.StringType()),
            T.StructField("historyId", T.StringType()),
            T.StructField("snippet", T.StringType()),
            T.StructField("internalDate", T.StringType()),
            T.StructField("labelIds", T.ArrayType(T.StringType())),
            T.StructField("payload", payload),
            T.StructField("_malformed", T.StringType()),
        ]
    )
