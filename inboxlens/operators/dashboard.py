"""Dashboard tiles over the application mart; each is one pass over few columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inboxlens.functions import rules
from inboxlens.functions.clock import instant


def scorecards(apps: DataFrame) -> DataFrame:
    return apps.agg(
        F.count_if(F.col("applied_at").isNotNull()).alias("total_applied"),
        F.count_if("has_interview").alias("interviews"),
        F.count_if("has_offer").alias("offers"),
        F.count_if("is_no_response").alias("no_response"),
    )


def month_delta(apps: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Applications sent in the calendar month of ``as_of``."""
    this_month = F.date_trunc("month", instant(as_of))
    same = F.date_trunc("month", "applied_at") == this_month
    return apps.agg(F.count_if(same).alias("applied_this_month"))


def funnel(apps: DataFrame) -> DataFrame:
    """Stage and count, in funnel order."""
    counts = apps.agg(
        F.count_if(F.col("applied_at").isNotNull()).alias("applied"),
        F.count_if("has_recruiter_outreach").alias("recruiter"),
        F.count_if("has_interview").alias("interview"),
        F.count_if("has_offer").alias("offer"),
    )
    stages = [
        F.struct(F.lit(i).alias("position"), F.lit(s).alias("stage"), F.col(s).alias("applications"))
        for i, s in enumerate(("applied", "recruiter", "interview", "offer"), start=1)
    ]
    return counts.select(F.inline(F.array(*stages)))


def outcomes(apps: DataFrame) -> DataFrame:
    return apps.groupBy("outcome").agg(F.count(F.lit(1)).alias("applications"))


def weekly(apps: DataFrame) -> DataFrame:
    """Applications per ISO week of ``applied_at``; threads never applied to form a NULL week."""
    week = F.to_date(F.date_trunc("week", "applied_at")).alias("week")
    return apps.groupBy(week).agg(F.count(F.lit(1)).alias("applications"))


def listing(apps: DataFrame, outcomes: Sequence[str] | None = None) -> DataFrame:
    """Company and role table, optionally for some outcomes only."""
    chosen = apps if outcomes is None else apps.filter(F.col("outcome").isin(*outcomes))
    return chosen.select("company", "role", "ats_source", "applied_at", "outcome")


def pills(apps: DataFrame, outcomes: Sequence[str] = rules.PILL_OUTCOMES) -> DataFrame:
    """All columns of the applications in the chosen outcomes."""
    return apps.filter(F.col("outcome").isin(*outcomes))


def last_updated(meta: DataFrame) -> DataFrame:
    return meta.select("mart_built_at")
