"""Refresh of the application mart from new mail only.

A state per thread is stored beside the mart.  A refresh reads the messages that were appended since the
last one, whose files alone pass the filter on the time of ingestion, detects and classifies
them, and merges their states with the stored ones; no older body is read again.  The new states
are written as a version of their own and published by one rename, with the time up to which they
know the mail, so a crash leaves the old states and the mail is read by the next refresh.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inboxlens.operators import models
from inboxlens.session import prepare
from inboxlens.sources import files, lease, tables


def _pointer(state_path: str) -> str:
    return f"{state_path.rstrip('/')}__current"


def states(spark: SparkSession, state_path: str) -> DataFrame | None:
    """The published thread states; None before the first refresh."""
    said = files.read(spark, _pointer(state_path))
    return spark.read.parquet(f"{state_path.rstrip('/')}/{json.loads(said)['version']}") if said else None


def refresh(spark: SparkSession, messages_path: str, state_path: str) -> DataFrame:
    """Bring the thread states up to the message table and return them.

    Messages carry the time of the commit that appended them, and a table has one writer, so mail
    newer than the newest one seen is the mail not seen.  The lease of the message table is held
    meanwhile, so that no commit is seen in part.  ``models.applications_of`` turns the states
    into the mart, as of any time.
    """
    prepare(spark)
    token = f"v{uuid.uuid4().hex}"
    said = files.read(spark, _pointer(state_path))
    now = json.loads(said) if said else {"version": None, "through": None}
    with lease.held(spark, messages_path, f"refresh-{token}"):
        messages = tables.read_messages_or_empty(spark, messages_path)
        if now["through"] is not None:
            messages = messages.filter(F.col("ingested_at") > F.timestamp_micros(F.lit(now["through"])))
        through = messages.agg(F.max(F.unix_micros("ingested_at"))).first()[0]
        if through is None and said:
            return states(spark, state_path)
        delta = models.thread_states(models.classify(models.find_job_mail(models.staging(messages))))
        known = states(spark, state_path)
        merged = delta if known is None else models.merge_states(known, delta)
        merged.write.parquet(f"{state_path.rstrip('/')}/{token}")
    after = {"version": token, "through": through, "before": now["version"]}
    files.replace(spark, _pointer(state_path), json.dumps(after), token)
    for folder in files.matching(spark, f"{state_path.rstrip('/')}/v*"):
        if folder.rsplit("/", 1)[1] not in (token, now["version"]):
            files.drop(spark, folder)
    return states(spark, state_path)
