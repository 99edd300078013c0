"""Build of the marts from the message table.

A build writes a version of all three marts, each into a folder of its own, and publishes them together:
one small file names the current version, and one rename replaces it.  A reader resolves the
version once and sees three marts of one build, whatever happens meanwhile; the version before the
current one stays, so a reader that is still at it is not disturbed.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from inboxlens.functions import rules
from inboxlens.operators import models, quality
from inboxlens.session import prepare
from inboxlens.sources import files, lease, tables


@dataclass(frozen=True)
class Marts:
    """Where a build writes; every mart's folder holds its versions."""

    emails: str
    applications: str
    meta: str

    @property
    def pointer(self) -> str:
        """The file that names the current version of all three."""
        return f"{self.meta.rstrip('/')}__current"

    def version(self, name: str) -> "Marts":
        """The folders of one version."""
        return Marts(*(f"{p.rstrip('/')}/{name}" for p in (self.emails, self.applications, self.meta)))


def build(
    spark: SparkSession,
    messages_path: str,
    marts: Marts,
    *,
    as_of: dt.datetime | None = None,
    no_response_days: int = rules.NO_RESPONSE_DAYS,
    check: bool = True,
) -> DataFrame:
    """Publish a new version of the three marts and return the report of the declared checks.

    Mail is detected and classified once: the application mart starts from the written
    email mart, which is smaller than the message table and already carries the category.
    Checks of single rows are counted while the marts are written, so the message table is read
    once for them and the email mart together.  Nothing is published before all checks have passed:
    with ``check`` a failed one raises and the published version stays.  One build at a time may
    write to the same marts.
    """
    prepare(spark)
    as_of = as_of or dt.datetime.now(dt.timezone.utc)
    token = f"v{uuid.uuid4().hex}"
    made = marts.version(token)
    with lease.held(spark, marts.meta, token) as renew:
        try:
            report = _write(spark, messages_path, made, as_of, no_response_days, check)
            renew()
            _publish(spark, marts, token)
        except BaseException:
            if _named(spark, marts).get("version") != token:
                _drop_version(spark, made)
            raise
        return report


def _write(
    spark: SparkSession,
    messages_path: str,
    made: Marts,
    as_of: dt.datetime,
    no_response_days: int,
    check: bool,
) -> DataFrame:
    """Write one version and return the report; a failed check raises."""
    reports: list[DataFrame] = []

    def passed(report: DataFrame) -> None:
        reports.append(spark.createDataFrame(report.collect(), report.schema))
        if check:
            quality.gate(reports[-1])

    staged = models.staging(tables.read_messages_or_empty(spark, messages_path))
    watched, staging = quality.observed(staged, quality.STAGING, as_of=as_of, table="staging")
    classified = models.classify(models.find_job_mail(watched))
    mart, of_mart = quality.observed(
        models.email_mart(classified), quality.EMAIL_MART, as_of=as_of, table="emails"
    )
    tables.write_email_mart(mart, made.emails)
    passed(staging(staged))
    emails = tables.read_email_mart(spark, made.emails)
    apps, of_apps = quality.observed(
        models.applications(emails, as_of=as_of, no_response_days=no_response_days),
        quality.APPLICATIONS, as_of=as_of, table="applications",
    )
    tables.write_applications(apps, made.applications)
    written = tables.read_applications(spark, made.applications)
    links = quality.References("thread_id", written, "application_id")
    passed(of_mart(emails).unionByName(quality.check(emails, [links], as_of=as_of, table="emails")))
    passed(of_apps(written))
    tables.write_meta(models.meta(staged, written, as_of=as_of), made.meta)
    meta = tables.read_meta(spark, made.meta)
    passed(quality.check(meta, quality.META, as_of=as_of, table="meta"))
    return reduce(DataFrame.unionByName, reports)


def _named(spark: SparkSession, marts: Marts) -> dict:
    said = files.read(spark, marts.pointer)
    return json.loads(said) if said else {}


def _publish(spark: SparkSession, marts: Marts, token: str) -> None:
    """Name the new version as the current one, then drop all but it and the one before."""
    before = _named(spark, marts).get("version")
    files.replace(spark, marts.pointer, json.dumps({"version": token, "before": before}), token)
    for path in (marts.emails, marts.applications, marts.meta):
        for folder in files.matching(spark, f"{path.rstrip('/')}/v*"):
            if folder.rsplit("/", 1)[1] not in (token, before):
                files.drop(spark, folder)


def _drop_version(spark: SparkSession, made: Marts) -> None:
    for path in (made.emails, made.applications, made.meta):
        files.drop(spark, path)


def audit_sources(
    spark: SparkSession, messages_path: str, ledger_path: str, *, as_of: dt.datetime
) -> DataFrame:
    """Report of the checks declared on the message table and the run ledger."""
    messages = tables.read_messages_or_empty(spark, messages_path)
    ledger = tables.read_ledger(spark, ledger_path)
    return quality.check(
        messages, quality.RAW_MESSAGES, as_of=as_of, table="messages"
    ).unionByName(quality.check(ledger, quality.RUN_LEDGER, as_of=as_of, table="ledger"))


def current(spark: SparkSession, marts: Marts) -> Marts:
    """The folders of the published version."""
    name = _named(spark, marts).get("version")
    if name is None:
        raise FileNotFoundError(f"nothing is published at {marts.pointer}")
    return marts.version(name)


def read_marts(spark: SparkSession, marts: Marts) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Email mart, application mart and meta of one version, as temporary views too."""
    now = current(spark, marts)
    emails = tables.read_email_mart(spark, now.emails)
    apps = tables.read_applications(spark, now.applications)
    meta = tables.read_meta(spark, now.meta)
    emails.createOrReplaceTempView("emails")
    apps.createOrReplaceTempView("applications")
    meta.createOrReplaceTempView("dashboard_meta")
    return emails, apps, meta
