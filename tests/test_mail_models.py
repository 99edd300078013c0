"""Golden mails and threads (FIXTURES.md, sections 3 and 4)."""

import datetime as dt

import pytest

from inboxlens.operators import models
from inboxlens.sources.mailbox import TEMPLATES

D0 = dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc)
MAIL = (
    "message_id string, thread_id string, sender string, subject string, snippet string, "
    "plain_body string, labels string, received_at timestamp, ingested_at timestamp"
)

# template index -> category, company, role, source system; None where the mail is dropped
GOLDEN = {
    0: ("applications submitted", "Acme", None, "Direct"),
    1: ("applications submitted", "Stripe", None, "Greenhouse"),
    2: ("interview scheduling", "Jane Doe", "Data Engineer", "Direct"),
    3: ("rejection", "Initech", None, "Direct"),
    4: ("offer", "Umbrella-Corp", None, "Direct"),
    5: ("recruiter outreach", "Hooli", "Open", "Lever"),
    6: None,
    7: None,
    8: ("other", None, None, "Indeed"),
    9: None,
    10: ("other", "Foo", "Staff Engineer", "Ashby"),
    11: ("offer", "Q", None, "Direct"),
    12: ("other", "Ops", None, "Direct"),
    13: ("other", None, None, "Lever"),
    14: ("other", "Talent", None, "Direct"),
    15: ("applications submitted", "Hooli Labs.", None, "Direct"),
}


@pytest.fixture(scope="module")
def mails(spark):
    def build(rows):
        return spark.createDataFrame(rows, MAIL)

    return build


def classified_of(df):
    return models.classify(models.find_job_mail(models.staging(df)))


def mail(message_id, *, sender="x@acme.com", subject="job", snippet="", body="", labels="INBOX",
         thread="t", at=D0):
    return (message_id, thread, sender, subject, snippet, body, labels, at, at)


def test_golden_mails(mails):
    df = mails(
        [
            (str(t.k), "t", t.sender, t.subject, t.snippet, t.plain_body, t.labels, D0, D0)
            for t in TEMPLATES
        ]
    )
    rows = models.with_guesses(classified_of(df)).collect()
    got = {
        int(r.message_id): (
            r.job_pipeline_category, r.company_guess, r.role_guess, r.ats_source_guess,
        )
        for r in rows
    }
    assert got == {k: v for k, v in GOLDEN.items() if v is not None}


def test_null_and_wildcard_quirks(mails):
    df = mails(
        [
            mail("kept"),
            mail("null labels", labels=None),
            mail("wildcard", labels="INBOX,CATEGORY-PROMOTIONS"),
            mail(None),
            mail("null headline", subject=None, snippet="interview"),
            mail("null body", subject="position", body=None),
            mail("no sender", sender=None, subject="job offer"),
        ]
    )
    rows = {r.message_id: r for r in models.with_guesses(classified_of(df)).collect()}
    assert set(rows) == {"kept", "null headline", "null body", "no sender"}
    assert rows["null headline"].job_pipeline_category == "other"
    assert rows["null body"].job_pipeline_category == "other"
    assert rows["no sender"].ats_source_guess is None
    assert rows["no sender"].company_guess is None


@pytest.mark.parametrize(
    ("sender", "company"),
    [
        ("Steam <a@jobs.steam-games.com>", "Jobs"),
        ("x@mail.acme.com", "Mail"),
        ("x@3m.com", "3m"),
        ("x@workday.com", "Workday"),
        ("x@myworkday.com", None),
        ('" Acme " <x@gmail.com>', "Acme"),
        ("A <x@gmail.com>", None),
        ("x@-odd--name.com", "-Odd--Name"),
    ],
)
def test_company_from_sender(mails, sender, company):
    row = models.with_guesses(classified_of(mails([mail("1", sender=sender)]))).first()
    assert row.company_guess == company


APPLIED = dict(subject="your application")
INTERVIEW = dict(subject="interview")
REJECTED = dict(subject="job: unfortunately")
OFFER = dict(subject="job offer")
RECRUITER = dict(subject="recruiter")
OTHER = dict(subject="job")


def days(n, hours=0):
    return D0 + dt.timedelta(days=n, hours=hours)


def thread(df, *, as_of=None, **options):
    as_of = as_of or days(1)
    return models.applications(classified_of(df), as_of=as_of, **options).first()


def test_status_dates_and_days(mails):
    row = thread(
        mails(
            [
                mail("1", **APPLIED, at=days(0)),
                mail("2", **INTERVIEW, at=days(3)),
                mail("3", **REJECTED, at=days(10)),
            ]
        )
    )
    assert (row.outcome, row.days_in_pipeline, row.email_count) == ("rejection", 10, 3)
    assert row.applied_at == row.first_email_at
    assert row.latest_status_at == row.last_email_at


@pytest.mark.parametrize(
    ("as_of", "outcome"),
    [(days(14) - dt.timedelta(seconds=1), "application"), (days(14), "no_response")],
)
def test_no_response_needs_whole_days(mails, as_of, outcome):
    row = thread(mails([mail("1", **APPLIED, at=days(0))]), as_of=as_of)
    assert row.outcome == outcome
    assert row.is_no_response == (outcome == "no_response")


def test_no_response_days_is_a_parameter(mails):
    df = mails([mail("1", **APPLIED, at=days(0))])
    assert thread(df, as_of=days(20), no_response_days=21).outcome == "application"
    assert thread(df, as_of=days(21), no_response_days=21).outcome == "no_response"


@pytest.mark.parametrize(
    ("content", "outcome"), [(RECRUITER, "recruiter"), (OTHER, "other"), (INTERVIEW, "interview")]
)
def test_never_applied(mails, content, outcome):
    row = thread(mails([mail("1", **content)]), as_of=days(90))
    assert (row.outcome, row.applied_at, row.days_in_pipeline) == (outcome, None, None)
    assert row.is_no_response is False


def test_rank_beats_recency(mails):
    df = mails([mail("1", **OFFER, at=days(5)), mail("2", **REJECTED, at=days(9))])
    row = thread(df)
    assert (row.outcome, row.days_in_pipeline) == ("offer", 0)
    assert row.latest_status_at == row.first_email_at


def test_days_can_be_negative_and_are_whole(mails):
    early = mails([mail("1", **OFFER, at=days(1)), mail("2", **APPLIED, at=days(3))])
    assert thread(early).days_in_pipeline == -2
    half = mails([mail("1", **APPLIED, at=days(0, 18)), mail("2", **OFFER, at=days(1, 6))])
    assert thread(half).days_in_pipeline == 0


def test_winner_is_earliest_non_null_then_smallest_id(mails):
    tie = mails(
        [
            mail("2", sender="Bee <x@gmail.com>", **APPLIED),
            mail("1", sender="Ace <x@gmail.com>", **APPLIED),
        ]
    )
    assert thread(tie).company == "Ace"
    later = mails(
        [
            mail("1", sender="x@gmail.com", **APPLIED, at=days(0)),
            mail("2", sender="Zed <x@gmail.com>", **APPLIED, at=days(1)),
        ]
    )
    assert thread(later).company == "Zed"
    undated = mails(
        [
            mail("1", sender="Dated <x@gmail.com>", **APPLIED, at=days(0)),
            mail("2", sender="Undated <x@gmail.com>", **APPLIED, at=None),
        ]
    )
    assert thread(undated).company == "Undated"


def test_interview_is_in_flight(mails):
    df = mails([mail("1", **APPLIED, at=days(0)), mail("2", **INTERVIEW, at=days(2))])
    row = thread(df, as_of=days(90))
    assert (row.outcome, row.days_in_pipeline, row.is_no_response) == ("interview", None, False)


def test_unthreaded_mail_is_in_the_email_mart_only(mails):
    classified = classified_of(mails([mail("1", thread=None), mail("2")]))
    assert models.email_mart(classified).count() == 2
    assert models.applications(classified, as_of=D0).count() == 1


def test_meta_counts_all_staged_mail(mails):
    staged = models.staging(mails([mail("1"), mail("2", subject="dinner", at=days(9))]))
    apps = models.applications(models.classify(models.find_job_mail(staged)), as_of=D0)
    row = models.meta(staged, apps, as_of=D0).first()
    assert row.application_count == 1
    assert row.data_through > row.mart_built_at


def test_meta_of_an_empty_mailbox(mails):
    staged = models.staging(mails([]))
    apps = models.applications(models.classify(models.find_job_mail(staged)), as_of=D0)
    row = models.meta(staged, apps, as_of=D0).first()
    assert (row.application_count, row.data_through) == (0, None)
