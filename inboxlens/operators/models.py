"""Mail models: staging, detection, classification, extraction and the marts.

The chain is ``staging -> find_job_mail -> classify -> {email_mart, extract,
applications}`` and ``meta``.  Each function is lazy; nothing is cached, and the mart plan
holds exactly one shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inboxlens.functions import mail, rules
from inboxlens.functions.clock import instant, whole_days
from inboxlens.functions.regex import contains_any, first_group, fold_ascii_letters, re2
from inboxlens.schemas import APPLICATION_COLUMNS, EMAIL_MART_COLUMNS, STAGING_COLUMNS

_GENERIC_SUFFIX = re2(rules.GENERIC_SUFFIX)


def staging(messages: DataFrame) -> DataFrame:
    """Identified mail with lower-cased helper columns (11 columns)."""
    return messages.filter(F.col("message_id").isNotNull()).select(
        *STAGING_COLUMNS,
        F.lower("labels").alias("labels_lower"),
        F.lower(F.concat("subject", F.lit(" "), "snippet")).alias("subject_snippet_lower"),
    )


def find_job_mail(staged: DataFrame) -> DataFrame:
    """Job-related mail outside promotions, plus ``is_job_email``.

    The flag is true on every row that passes, so it is attached as a constant instead of
    being evaluated a second time.
    """
    return staged.filter(
        mail.not_promotion(F.col("labels_lower"))
        & mail.is_job_mail(F.col("sender"), F.col("subject"), F.col("snippet"))
    ).withColumn("is_job_email", F.lit(True))


def classify(found: DataFrame) -> DataFrame:
    """Add ``job_pipeline_category``, never NULL.

    The body is lower-cased and searched only where the headline decides nothing.
    """
    headline = found.withColumn(
        "_headline", mail.headline_category(F.col("subject_snippet_lower"))
    )
    undecided = F.when(F.col("_headline").isNull(), F.lower("plain_body"))
    return (
        headline.withColumn("_body", undecided)
        .withColumn(
            "job_pipeline_category",
            F.coalesce("_headline", mail.body_category(F.col("_body"))),
        )
        .drop("_headline", "_body")
    )


def email_mart(classified: DataFrame) -> DataFrame:
    """One row per job mail (9 columns)."""
    return classified.select(*EMAIL_MART_COLUMNS)


def with_guesses(classified: DataFrame, *, body_chars: int = 0) -> DataFrame:
    """Add ``company_guess``, ``role_guess`` and ``ats_source_guess`` to each mail.

    Bodies are read whole; ``body_chars`` limits the search to their beginning.

    Candidates run in order of precedence, each as a column of its own, so that a pattern
    runs at most once per mail and only where nothing was found before.  Inside the chain
    ``''`` stands for nothing found.
    """
    nothing = F.lit("")
    body = F.coalesce("plain_body", nothing)
    signals = classified.withColumns(
        {
            "_domain": first_group(F.col("sender"), rules.SENDER_DOMAIN),
            "_display": F.coalesce(
                first_group(F.col("sender"), rules.SENDER_DISPLAY), nothing
            ),
            "_subject": F.coalesce("subject", nothing),
            "_body": F.substring(body, 1, body_chars) if body_chars else body,
        }
    ).withColumns(
        {
            "_domain": mail.null_if_empty(fold_ascii_letters(F.col("_domain"))),
            "_display": mail.strip_white_space(
                F.regexp_replace("_display", _GENERIC_SUFFIX, nothing)
            ),
            "_label": first_group(F.col("_domain"), rules.DOMAIN_LABEL),
            "_subject_lower": fold_ascii_letters(F.col("_subject")),
            "_body_lower": fold_ascii_letters(F.col("_body")),
        }
    )
    low, high = rules.DISPLAY_LENGTH
    subject, body = ("_subject", "_subject_lower"), ("_body", "_body_lower")
    signals = signals.withColumns(
        {
            "ats_source_guess": mail.source_system("_domain"),
            "_is_employer": mail.is_employer_domain("_domain"),
            "_company": F.when(
                F.length("_display").between(low, high), F.col("_display")
            ).otherwise(nothing),
            "_role": nothing,
        }
    )
    signals = _fill(signals, "_company", subject, *rules.COMPANY_IN_SUBJECT)
    signals = _fill(signals, "_company", body, *rules.COMPANY_IN_BODY)
    signals = _fill(signals, "_role", subject, *rules.ROLE_APPLYING_SUBJECT)
    signals = _fill(signals, "_role", subject, *rules.ROLE_FOR_THE_SUBJECT)
    signals = _fill(signals, "_role", subject, *rules.ROLE_AT_SUBJECT)
    signals = _fill(signals, "_role", body, *rules.ROLE_APPLYING_BODY)
    employer = F.when(
        (F.col("_company") == "") & F.col("_is_employer"),
        mail.title_case(F.col("_label")),
    ).otherwise(F.col("_company"))
    return signals.withColumn("_company", employer).select(
        *classified.columns,
        mail.null_if_empty(F.col("_company")).alias("company_guess"),
        mail.null_if_empty(F.col("_role")).alias("role_guess"),
        "ats_source_guess",
    )


def _fill(
    df: DataFrame, name: str, text: tuple[str, str], pattern: str, words: tuple[str, ...]
) -> DataFrame:
    """Where ``name`` is empty, take the pattern's group from the text.

    A text without any of the words cannot match, so the pattern is spared there.
    """
    plain, lowered = text
    missing = (F.col(name) == "") & contains_any(F.col(lowered), words)
    found = F.when(missing, first_group(F.col(plain), pattern)).otherwise(F.col(name))
    return df.withColumn(name, found)


def extract(classified: DataFrame) -> DataFrame:
    """Company, role and source system guessed from each threaded mail (5 columns)."""
    threaded = classified.filter(F.col("thread_id").isNotNull())
    return with_guesses(threaded).select(
        "thread_id", "received_at", "company_guess", "role_guess", "ats_source_guess"
    )


def _rollup_columns() -> list[Column]:
    cat, at = F.col("job_pipeline_category"), F.col("received_at")
    return [
        F.min(F.when(cat == rules.APPLIED, at)).alias("applied_at"),
        F.min(at).alias("first_email_at"),
        F.max(at).alias("last_email_at"),
        F.count(F.lit(1)).alias("email_count"),
        F.bool_or(cat == rules.INTERVIEW).alias("has_interview"),
        F.bool_or(cat == rules.OFFER).alias("has_offer"),
        F.bool_or(cat == rules.REJECTION).alias("has_rejection"),
        F.bool_or(cat == rules.RECRUITER).alias("has_recruiter_outreach"),
    ]


def _latest_status() -> Column:
    """Date of the highest-ranked, then newest mail; only the date of the winner is read,
    so a maximum over (rank, date) replaces a sort of the thread."""
    rank = mail.status_rank(F.col("job_pipeline_category"))
    best = F.max(F.struct(rank.alias("rank"), F.col("received_at").alias("at")))
    return best.getField("at").alias("latest_status_at")


def _winner_columns() -> list[Column]:
    """Earliest non-NULL guesses, undated mail first, ties by message id."""
    first = "struct(received_at, message_id)"
    return [
        F.expr(f"min_by({guess}, {first}) FILTER (WHERE {guess} IS NOT NULL)").alias(name)
        for guess, name in (
            ("company_guess", "company"),
            ("role_guess", "role"),
            ("ats_source_guess", "ats_source"),
        )
    ]


def thread_rollup(classified: DataFrame) -> DataFrame:
    """Dates, mail count and category flags per thread."""
    threaded = classified.filter(F.col("thread_id").isNotNull())
    return threaded.groupBy("thread_id").agg(*_rollup_columns())


def latest_status(classified: DataFrame) -> DataFrame:
    """Date of the mail that decides each thread's status."""
    threaded = classified.filter(F.col("thread_id").isNotNull())
    return threaded.groupBy("thread_id").agg(_latest_status())


def extract_winners(classified: DataFrame) -> DataFrame:
    """One company, role and source system per thread."""
    threaded = classified.filter(F.col("thread_id").isNotNull())
    return with_guesses(threaded).groupBy("thread_id").agg(*_winner_columns())


def no_response(as_of: Column, days: int) -> Column:
    """Applied, nothing followed, and at least ``days`` whole days ago."""
    return (
        F.col("applied_at").isNotNull()
        & ~F.col("has_interview")
        & ~F.col("has_offer")
        & ~F.col("has_rejection")
        & (whole_days(F.col("applied_at"), as_of) >= days)
    )


def outcome() -> Column:
    """The single bucket of a thread, first match wins."""
    return mail.first_true(
        [
            (F.col("has_offer"), "offer"),
            (F.col("has_rejection"), "rejection"),
            (F.col("has_interview"), "interview"),
            (F.col("is_no_response"), "no_response"),
            (F.col("applied_at").isNotNull(), "application"),
            (F.col("has_recruiter_outreach"), "recruiter"),
        ],
        "other",
    )


def days_in_pipeline() -> Column:
    """Whole days from application (or first mail) to a final status, else NULL."""
    start = F.coalesce("applied_at", "first_email_at")
    return F.when(
        F.col("has_offer") | F.col("has_rejection"),
        whole_days(start, F.col("latest_status_at")),
    )


def applications(
    classified: DataFrame,
    *,
    as_of: dt.datetime | Column,
    no_response_days: int = rules.NO_RESPONSE_DAYS,
) -> DataFrame:
    """One row per thread (16 columns), in one shuffle.

    Guesses are computed before the shuffle, so bodies never travel, and every aggregate
    combines map-side, so a giant thread is as cheap as a small one.
    """
    threaded = classified.filter(F.col("thread_id").isNotNull())
    threads = (
        with_guesses(threaded)
        .groupBy(F.col("thread_id").alias("application_id"))
        .agg(*_rollup_columns(), _latest_status(), *_winner_columns())
    )
    return _judged(threads, as_of, no_response_days)


_GUESSES = {"company": "company_guess", "role": "role_guess", "ats_source": "ats_source_guess"}


def thread_states(classified: DataFrame) -> DataFrame:
    """What is kept of each thread so that mail can be added to it later.

    Minima, maxima, counts and flags, the best (rank, date), and the first (date, id, guess) of each
    kind: every column merges with that of another part of the thread's mail.
    """
    threaded = with_guesses(classified.filter(F.col("thread_id").isNotNull()))
    rank = mail.status_rank(F.col("job_pipeline_category"))
    firsts = [
        F.expr(f"min(struct(received_at, message_id, {guess} AS value)) FILTER (WHERE {guess} IS NOT NULL)").alias(name)
        for name, guess in _GUESSES.items()
    ]
    best = F.max(F.struct(rank.alias("rank"), F.col("received_at").alias("at"))).alias("best")
    return threaded.groupBy("thread_id").agg(*_rollup_columns(), best, *firsts)


def merge_states(one: DataFrame, other: DataFrame) -> DataFrame:
    """The states of both parts of the mail together; a message may be in one part only."""
    merged = {
        "applied_at": F.min, "first_email_at": F.min, "last_email_at": F.max, "email_count": F.sum,
        **{f"has_{k}": F.bool_or for k in ("interview", "offer", "rejection", "recruiter_outreach")},
        "best": F.max, **dict.fromkeys(_GUESSES, F.min),
    }
    return one.unionByName(other).groupBy("thread_id").agg(
        *(merge(name).alias(name) for name, merge in merged.items())
    )


def applications_of(
    states: DataFrame,
    *,
    as_of: dt.datetime | Column,
    no_response_days: int = rules.NO_RESPONSE_DAYS,
) -> DataFrame:
    """The application mart from thread states: the rows of :func:`applications` over all mail."""
    threads = states.withColumnRenamed("thread_id", "application_id").withColumns(
        {
            "latest_status_at": F.col("best.at"),
            **{name: F.col(f"{name}.value") for name in _GUESSES},
        }
    )
    return _judged(threads, as_of, no_response_days)


def _judged(threads: DataFrame, as_of: dt.datetime | Column, no_response_days: int) -> DataFrame:
    return (
        threads.withColumn("is_no_response", no_response(instant(as_of), no_response_days))
        .withColumns({"outcome": outcome(), "days_in_pipeline": days_in_pipeline()})
        .select(*APPLICATION_COLUMNS)
    )


def meta(
    staged: DataFrame, apps: DataFrame, *, as_of: dt.datetime | Column
) -> DataFrame:
    """One row: build time, newest staged mail, number of applications."""
    counted = apps.agg(F.count(F.lit(1)).alias("n"))
    return staged.agg(F.max("received_at").alias("data_through")).select(
        instant(as_of).alias("mart_built_at"),
        "data_through",
        counted.scalar().alias("application_count"),
    )
