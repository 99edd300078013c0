
from __future__ import annotations

import atexit
import datetime as dt
import importlib.util
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_queries  # noqa: E402
from inboxlens.functions import mail, rules  # noqa: E402
from inboxlens.functions.clock import from_micros, instant  # noqa: E402
from inboxlens.operators import dashboard, ingest, models, quality  # noqa: E402
from inboxlens.plans import build, compact, refresh, sync  # noqa: E402
from inboxlens.session import prepare, shared_folder  # noqa: E402
from inboxlens.sources import files, landed_fixture, landing, mailbox, tables  # noqa: E402
from inboxlens.streaming import mailstream  # noqa: E402

try:
    from inboxlens.llm import registry as llm_registry
except ModuleNotFoundError as missing:
    # The training-data operators may be absent; a broken import inside them still raises.
    if missing.name not in ("inboxlens.llm", "corpus_pipeline"):
        raise
    llm_registry = None
except ImportError:
    if importlib.util.find_spec("inboxlens.llm.registry"):
        raise
    llm_registry = None

AS_OF = mailbox.AS_OF
UTC = dt.timezone.utc
FLOOR = dt.date(2024, 1, 1)
Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mailbox.mail_from_events(_table(spark, sf_dir, "events"))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.staging(_mail(spark, sf_dir))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.classify(models.find_job_mail(_staged(spark, sf_dir)))


def _guessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    threaded = _classified(spark, sf_dir).filter(F.col("thread_id").isNotNull())
    return models.with_guesses(threaded)


def _apps(spark: SparkSession, sf_dir: str, days: int = rules.NO_RESPONSE_DAYS) -> DataFrame:
    return models.applications(_classified(spark, sf_dir), as_of=AS_OF, no_response_days=days)


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mailbox.ledger_from_events(_table(spark, sf_dir, "events"))


def _bounds(spark: SparkSession, sf_dir: str) -> tuple[dt.datetime, dt.datetime]:
    """First second of the events, and the second after the last one."""
    at = F.col("ts").cast("timestamp")
    lo, hi = _table(spark, sf_dir, "events").agg(
        F.unix_micros(F.min(at)), F.unix_micros(F.max(at))
    ).first()
    first, last = from_micros(lo), from_micros(hi)
    return first.replace(microsecond=0), last.replace(microsecond=0) + dt.timedelta(seconds=1)


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Mail of the first two thirds of the days, landed before, and all mail, which arrives now."""
    everything = _mail(spark, sf_dir)
    lo, hi = _bounds(spark, sf_dir)
    cut = (lo + 2 * ((hi - lo) / 3)).replace(hour=0, minute=0, second=0, microsecond=0)
    return everything.filter(F.col("received_at") < instant(cut)), everything


def _data_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return _table(spark, sf_dir, "events").agg(
        F.date_trunc("second", F.min(at)).alias("lo"),
        F.date_trunc("second", F.max(at)).alias("hi"),
    )


def _placed(spark: SparkSession, sf_dir: str, days: int = 1) -> DataFrame:
    return ingest.assign_window(_mail(spark, sf_dir), *_bounds(spark, sf_dir), days=days)


def _window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed, arriving = _split(spark, sf_dir)
    limits = _bounds(spark, sf_dir)
    keys = ingest.assign_window(arriving.select("message_id", "received_at"), *limits)
    spans = ingest.windows(ingest.bounds(spark, *limits))
    return ingest.window_counts(spans, keys, ingest.new_rows(keys, landed))


def _ingest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed, arriving = _split(spark, sf_dir)
    batch = arriving.select("message_id", "thread_id", "received_at")
    return ingest.new_rows(batch, landed)


def _first_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a copy-heavy batch: the earliest copy and the number of copies."""
    lines = _table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("message_id"),
        F.col("l_shipdate").cast("date").alias("received_at"),
    )
    return ingest.first_copies(lines, count="copies")


def _flat(raw: DataFrame, **options) -> DataFrame:
    return landing.flatten(raw, ingested_at=AS_OF, **options)[0]


def _landed_mail(df: DataFrame) -> DataFrame:
    return df.select(
        "message_id", "thread_id", "history_id", "subject", "sender", "snippet",
        "plain_body", "html_body", "labels", "received_at",
    )


def _digests(df: DataFrame) -> DataFrame:
    return df.select(
        "message_id",
        "thread_id",
        "subject",
        "labels",
        F.md5(F.encode("plain_body", "UTF-8")).alias("plain_md5"),
        F.length("plain_body").cast("bigint").alias("plain_chars"),
        F.md5(F.encode("html_body", "UTF-8")).alias("html_md5"),
    )


def _page_digests(df: DataFrame) -> DataFrame:
    html_md5 = F.md5(F.encode("html_body", "UTF-8")).alias("html_md5")
    return df.select("message_id", "subject", "plain_body", html_md5)


#: Landed JSON of a table and what is read from the flattened messages.
LANDED = {
    "landing_roundtrip": (
        lambda s, d: landed_fixture.landed_from_mail(_mail(s, d)), _landed_mail
    ),
    "landing_documents": (
        lambda s, d: landed_fixture.landed_from_documents(_table(s, d, "documents")), _digests
    ),
    "landing_pages": (
        lambda s, d: landed_fixture.landed_from_pages(_table(s, d, "pages")), _page_digests
    ),
}


def _landed(name: str) -> Query:
    lines, pick = LANDED[name]
    return lambda spark, sf_dir: pick(_flat(lines(spark, sf_dir)))


def _landing_body_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = landed_fixture.landed_from_documents(_table(spark, sf_dir, "documents"))
    return _flat(raw, max_body_chars=500).select("message_id", "plain_body", "html_body")


def _landing_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = landed_fixture.landed_from_turns(_table(spark, sf_dir, "conversations"))
    return _flat(raw).select("message_id", "plain_body", "html_body")


def _folder(spark: SparkSession) -> str:
    """A new folder in the shared one; a local session without any gets its own."""
    context = prepare(spark).sparkContext
    unset = not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir()
    if unset and context.master.startswith("local"):
        own = tempfile.mkdtemp(prefix="inboxlens-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _targets(base: str) -> sync.Targets:
    return sync.Targets(f"{base}/messages", f"{base}/ledger", f"{base}/bad")


def _land(spark: SparkSession, sf_dir: str) -> tuple[str, sync.Targets]:
    """Write the mail of the test tables as landed JSON, and name empty targets beside it."""
    base = _folder(spark)
    landed_fixture.landed_from_mail(_mail(spark, sf_dir)).write.text(f"{base}/json")
    return f"{base}/json", _targets(base)


def _days(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.datetime, dt.datetime]:
    """Floor of a sync, a ceiling in the middle, and one that covers all mail."""
    lo, hi = _bounds(spark, sf_dir)
    midnight = (lo + (hi - lo) / 2).replace(hour=0, minute=0, second=0, microsecond=0)
    end = hi.replace(hour=0, minute=0, second=0) + dt.timedelta(days=1)
    return lo.date(), midnight, end


def _synced(spark: SparkSession, sf_dir: str, **options) -> sync.Targets:
    """Two incremental syncs, the second of which finds the mail the first had to leave."""
    landed, targets = _land(spark, sf_dir)
    floor, middle, end = _days(spark, sf_dir)
    for ceiling in (middle, end):
        sync.run(spark, landed, targets, floor=floor, ceiling=ceiling, **options)
    return targets


def _ledger_rows(spark: SparkSession, targets: sync.Targets) -> DataFrame:
    ledger = tables.read_ledger(spark, targets.ledger)
    return ledger.select("status", "sync_start", "sync_end", "fetched", "inserted")


def _sync_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger_rows(spark, _synced(spark, sf_dir))


def _sync_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed_mail(tables.read_messages(spark, _synced(spark, sf_dir).messages))


def _sync_daily_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day a commit of its own, from one parse of the landing area."""
    return _ledger_rows(spark, _synced(spark, sf_dir, windows_per_commit=1))


def _sync_late_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third mail lands after the watermark has passed its day."""
    base = _folder(spark)
    everything = landed_fixture.landed_from_mail(_mail(spark, sf_dir), "message_id")
    floor, _, end = _days(spark, sf_dir)
    for late in (False, True):
        part = everything.filter((F.col("message_id").cast("bigint") % 3 == 0) == late)
        part.select("value").write.mode("append").text(f"{base}/json")
        sync.run(spark, f"{base}/json", _targets(base), floor=floor, ceiling=end)
    return _landed_mail(tables.read_messages(spark, f"{base}/messages"))


def _sync_again(full: bool) -> Query:
    """The range once more, incrementally or from the start: nothing is inserted twice."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        landed, targets = _land(spark, sf_dir)
        floor, _, end = _days(spark, sf_dir)
        sync.run(spark, landed, targets, floor=floor, ceiling=end)
        sync.run(spark, landed, targets, floor=floor, ceiling=end, full_backfill=full)
        kept = tables.read_messages(spark, targets.messages).agg(F.count(F.lit(1)).alias("messages"))
        done = _ledger_rows(spark, targets).groupBy("status").agg(
            F.count(F.lit(1)).alias("windows"), F.sum("fetched").alias("fetched"),
            F.sum("inserted").alias("inserted"),
        )
        return done.select("*", kept.scalar().alias("messages"))

    return run


def _sync_error_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that fails on mail landed since the last one, recorded with zero counts, and its retry."""
    base = _folder(spark)
    landed, targets = f"{base}/json", _targets(base)
    floor, middle, end = _days(spark, sf_dir)
    early = F.col("received_at") < instant(middle)
    everything = _mail(spark, sf_dir)
    landed_fixture.landed_from_mail(everything.filter(early)).write.text(landed)
    sync.run(spark, landed, targets, floor=floor, ceiling=middle)
    landed_fixture.landed_from_mail(everything.filter(~early)).write.mode("append").text(landed)
    failing = lambda m: F.raise_error(F.lit("quota")).cast("boolean")
    try:
        sync.run(spark, landed, targets, floor=floor, ceiling=end, predicate=failing)
    except Exception as failure:
        if "quota" not in str(failure):
            raise
    sync.run(spark, landed, targets, floor=floor, ceiling=end)
    ledger = tables.read_ledger(spark, targets.ledger)
    return ledger.select(
        "status", "sync_start", "sync_end", "fetched", "inserted",
        F.col("error").contains("quota").alias("names_error"),
        F.col("run_id").rlike("^[0-9a-f]{32}$").alias("has_run_id"),
        (F.col("started_at") <= F.col("finished_at")).alias("in_order"),
    )


def _sync_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days in windows that each hold more than the cap: runs that stop and resume to the end."""
    landed, targets = _land(spark, sf_dir)
    floor, _, end = _days(spark, sf_dir)
    cap = max(1, _mail(spark, sf_dir).count() // 6)
    options = {"floor": floor, "ceiling": end, "cap": cap, "days": 8, "windows_per_commit": 1}
    while sync.run(spark, landed, targets, **options)["status"] == "capped":
        pass
    return _landed_mail(tables.read_messages(spark, targets.messages))


#: Names that need care in paths, in URLs or in patterns.
ODD_NAMES = ("a b", "c[1]", "50%", "d%20e", "f+g", "{h,i}", "j?k", "l*m", "ünï", "n#o", "p=q", "r&s;t")


def _sync_odd_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two syncs of files with odd names, some of which land after the first."""
    landed, targets = _land(spark, sf_dir)
    floor, _, end = _days(spark, sf_dir)
    parts = sorted(p for p in files.matching(spark, f"{landed}/part-*"))
    for n, part in enumerate(parts):
        files.move(spark, part, f"{landed}/{ODD_NAMES[n % len(ODD_NAMES)]}.{n}.json")
    sync.run(spark, landed, targets, floor=floor, ceiling=end)
    late = landed_fixture.landed_from_mail(_mail(spark, sf_dir), "message_id").select(
        F.replace("value", F.lit('"id":"'), F.lit('"id":"late ')).alias("value")
    )
    late.repartition(len(ODD_NAMES)).write.mode("append").text(landed)
    for n, part in enumerate(sorted(files.matching(spark, f"{landed}/part-*"))):
        files.move(spark, part, f"{landed}/late {ODD_NAMES[n % len(ODD_NAMES)]}.{n}.json")
    sync.run(spark, landed, targets, floor=floor, ceiling=end)
    return _landed_mail(tables.read_messages(spark, targets.messages))


SEARCH = (
    "(in:inbox OR label:starred) -category:promotions after:2024/01/03 -subject:dinner "
    '{from:acme subject:"interview for" "schedule a call" from:(hire lever) snippet-free hello}'
)


def _sync_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sync whose mail is chosen by a search string."""
    landed, targets = _land(spark, sf_dir)
    floor, _, end = _days(spark, sf_dir)
    sync.run(spark, landed, targets, floor=floor, ceiling=end, predicate=SEARCH)
    return _landed_mail(tables.read_messages(spark, targets.messages))


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail appended in eight parts, compacted, appended to and compacted again: the same rows in fewer files."""
    base = _folder(spark)
    path = f"{base}/messages"
    mails = _mail(spark, sf_dir).withColumns(
        {c: F.lit(None).cast("string") for c in ("history_id", "recipient", "date", "html_body")}
    )
    part = F.pmod(F.col("message_id").cast("bigint"), F.lit(8))
    for number in range(6):
        tables.append_messages(mails.filter(part == number).coalesce(2), path)
    first = compact.compact(spark, path, least_files=6)
    for number in (6, 7):
        tables.append_messages(mails.filter(part == number).coalesce(2), path)
    second = compact.compact(spark, path, least_files=3)
    fewer = all(0 < done["files_after"] < done["files_before"] for done in (first, second))
    return tables.read_messages(spark, path).select(
        "message_id", "thread_id", "sender", "subject", "received_at", F.lit(fewer).alias("fewer_files")
    )


def _refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The application mart after three refreshes, each of which reads a third of the mail."""
    base = _folder(spark)
    mails = _mail(spark, sf_dir).withColumns(
        {c: F.lit(None).cast("string") for c in ("history_id", "recipient", "date", "html_body")}
    )
    for number in range(3):
        part = mails.filter(F.pmod(F.col("message_id").cast("bigint"), F.lit(3)) == number)
        at = AS_OF + dt.timedelta(hours=number)
        tables.append_messages(part.withColumn("ingested_at", instant(at)), f"{base}/messages")
        states = refresh.refresh(spark, f"{base}/messages", f"{base}/threads")
    return models.applications_of(states, as_of=AS_OF)


def _ingested_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message carries the time of its run, not before it was received."""
    messages = tables.read_messages(spark, _synced(spark, sf_dir).messages)
    return messages.select(
        "message_id",
        (F.col("ingested_at") >= F.col("received_at")).alias("after_receipt"),
        F.col("ingested_at").isNotNull().alias("is_set"),
    )


def _stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed, targets = _land(spark, sf_dir)
    mailstream.start(
        spark, landed, targets, f"{targets.messages}-checkpoint", max_files_per_trigger=8
    ).awaitTermination()
    return _landed_mail(tables.read_messages(spark, targets.messages))


def _landing_deep(levels: int) -> Query:
    """Turns so many MIME levels deep; one expression walks four, the rest goes level by level."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = landed_fixture.landed_from_turns(_table(spark, sf_dir, "conversations"), levels=levels)
        staged = landing.stage(raw, f"{_folder(spark)}/rows", ingested_at=AS_OF)
        return landing.messages_of(staged).select("message_id", "plain_body")

    return run


def _landing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged landing lines by reason; every third of the documents' lines is damaged."""
    raw = landed_fixture.damaged(_table(spark, sf_dir, "documents"))
    staged = landing.stage(raw, f"{_folder(spark)}/rows", ingested_at=AS_OF, dated_only=True)
    bad = landing.quarantine_of(staged)
    return bad.groupBy("reason").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("payload_sha") == F.sha2("value", 256)).alias("kept_whole"),
    )


def _built(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, build.Marts]:
    """The marts built from a stored message table, and the report of their checks."""
    base = _folder(spark)
    mails = _mail(spark, sf_dir).withColumns(
        {c: F.lit(None).cast("string") for c in ("history_id", "recipient", "date", "html_body")}
    )
    tables.append_messages(mails, f"{base}/messages")
    marts = build.Marts(*(f"{base}/{n}" for n in ("emails", "applications", "meta")))
    return build.build(spark, f"{base}/messages", marts, as_of=AS_OF, check=False), marts


def _build_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.read_marts(spark, _built(spark, sf_dir)[1])[0].drop("received_date")


def _build_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = _built(spark, sf_dir)[1]
    return build.read_marts(spark, marts)[1].drop("latest_status_date")


def _build_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.read_marts(spark, _built(spark, sf_dir)[1])[2]


def _build_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir)[0].groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


def _text_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mailbox.mail_from_documents(_table(spark, sf_dir, "documents"))


def _text_guesses(spark: SparkSession, sf_dir: str, body_chars: int = 0) -> DataFrame:
    found = models.classify(models.find_job_mail(models.staging(_text_mail(spark, sf_dir))))
    return models.with_guesses(found, body_chars=body_chars)


def _turn_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails = mailbox.mail_from_turns(_table(spark, sf_dir, "conversations"))
    return models.classify(models.find_job_mail(models.staging(mails)))


def _check(df: DataFrame, *rules_: quality.Rule, as_of: dt.datetime = AS_OF) -> DataFrame:
    return quality.check(df, rules_, as_of=as_of)


def _dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails = _check(_mail(spark, sf_dir), quality.Fresh("ingested_at"))
    late = dt.datetime(2024, 2, 20)
    return mails.unionByName(
        _check(_ledger(spark, sf_dir), quality.Fresh("finished_at"), as_of=late)
    )


def _portable(query: Query) -> Query:
    """Hand timestamps over without a zone, so that no client shifts them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        return df.select(
            *(
                F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
                for name, kind in df.dtypes
            )
        )

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the application mart of the smallest test tables."""
    return queries()["application_mart"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One query per operator; each reads its tables whole."""
    registered: dict[str, Query] = {
        # mail models
        "category_counts": lambda s, d: _classified(s, d)
        .groupBy("job_pipeline_category")
        .agg(F.count(F.lit(1)).alias("emails")),
        "staging_messages": _staged,
        "job_email_finder": lambda s, d: models.find_job_mail(_staged(s, d)).select(
            "message_id", "thread_id", "sender", "subject", "snippet", "is_job_email"
        ),
        "email_classifier": lambda s, d: _classified(s, d).select(
            "message_id", "subject", "job_pipeline_category"
        ),
        "email_mart": lambda s, d: models.email_mart(_classified(s, d)),
        "status_rank": lambda s, d: _classified(s, d).select(
            "message_id",
            "job_pipeline_category",
            mail.status_rank(F.col("job_pipeline_category")).alias("status_rank"),
        ),
        "company_extract": lambda s, d: _guessed(s, d).select("message_id", "company_guess"),
        "role_extract": lambda s, d: _guessed(s, d).select("message_id", "role_guess"),
        "ats_source": lambda s, d: _guessed(s, d).select("message_id", "ats_source_guess"),
        "application_extract": lambda s, d: models.extract(_classified(s, d)),
        "thread_rollup": lambda s, d: models.thread_rollup(_classified(s, d)),
        "latest_status": lambda s, d: models.latest_status(_classified(s, d)),
        "extract_winners": lambda s, d: models.extract_winners(_classified(s, d)),
        "application_mart": _apps,
        "application_mart_21_days": lambda s, d: _apps(s, d, days=21),
        # dashboard tiles
        "scorecards": lambda s, d: dashboard.scorecards(_apps(s, d)),
        "scorecard_month_delta": lambda s, d: dashboard.month_delta(
            _apps(s, d), dt.datetime(2024, 1, 31)
        ),
        "funnel": lambda s, d: dashboard.funnel(_apps(s, d)),
        "outcome_donut": lambda s, d: dashboard.outcomes(_apps(s, d)),
        "applications_over_time": lambda s, d: dashboard.weekly(_apps(s, d)),
        "company_role_table": lambda s, d: dashboard.listing(_apps(s, d)),
        "outcome_filter": lambda s, d: dashboard.pills(_apps(s, d)),
        "dashboard_meta": lambda s, d: models.meta(_staged(s, d), _apps(s, d), as_of=AS_OF),
        # incremental ingestion
        "ingest_windows": lambda s, d: ingest.windows(_data_bounds(s, d)),
        "ingest_windows_3_days": lambda s, d: ingest.windows(_data_bounds(s, d), days=3),
        "window_assignment": lambda s, d: _placed(s, d, days=2).select(
            "message_id", "sync_start", "sync_end"
        ),
        "ingest_dedup": _ingest_dedup,
        "first_copies": _first_copies,
        "window_counts": _window_counts,
        "window_cap": lambda s, d: ingest.capped(_placed(s, d), 100).select(
            "message_id", "sync_start"
        ),
        "watermark": lambda s, d: ingest.watermark_frame(
            _ledger(s, d), _mail(s, d), floor=FLOOR, spark=s
        ),
        "watermark_fallback": lambda s, d: ingest.watermark_frame(
            None, _mail(s, d), floor=FLOOR, spark=s
        ),
        "run_summary": lambda s, d: ingest.run_summary(_ledger(s, d)),
        "sync_ledger": _sync_ledger,
        "sync_messages": _sync_messages,
        "stream_messages": _stream_messages,
        "sync_daily_commits": _sync_daily_commits,
        "sync_late_mail": _sync_late_mail,
        "sync_backfill": _sync_again(full=True),
        "sync_rerun": _sync_again(full=False),
        "sync_error_ledger": _sync_error_ledger,
        "sync_capped": _sync_capped,
        "sync_odd_files": _sync_odd_files,
        "sync_search": _sync_search,
        "sync_ingested_at": _ingested_at,
        "compacted_messages": _compacted,
        "refreshed_applications": _refreshed,
        # build
        "build_emails": _build_emails,
        "build_applications": _build_applications,
        "build_meta": _build_meta,
        "build_report": _build_report,
        "last_updated": lambda s, d: dashboard.last_updated(_build_meta(s, d)),
        # whole texts through the models
        "documents_classified": lambda s, d: _text_guesses(s, d).select(
            "message_id", "job_pipeline_category"
        ),
        "documents_company": lambda s, d: _text_guesses(s, d).select(
            "message_id", "company_guess", "ats_source_guess"
        ),
        "documents_company_head": lambda s, d: _text_guesses(
            s, d, rules.BODY_HEAD_CHARS
        ).select("message_id", "company_guess"),
        "documents_role": lambda s, d: _text_guesses(s, d).select("message_id", "role_guess"),
        "conversations_classified": lambda s, d: _turn_mail(s, d).select(
            "message_id", "job_pipeline_category"
        ),
        # landed JSON
        "landing_deep": _landing_deep(12),
        "landing_40_levels": _landing_deep(40),
        "landing_quarantine": _landing_quarantine,
        **{name: _landed(name) for name in LANDED},
        "landing_body_cap": _landing_body_cap,
        "landing_parts": _landing_parts,
        # data checks
        "dq_not_null": lambda s, d: _check(
            _mail(s, d),
            *(
                quality.NotNull(c)
                for c in ("message_id", "thread_id", "subject", "labels", "received_at")
            ),
        ),
        "dq_unique": lambda s, d: _check(
            _mail(s, d), quality.Unique("message_id"), quality.Unique("thread_id")
        ),
        "dq_accepted_values": lambda s, d: _check(
            _classified(s, d),
            quality.Accepted("job_pipeline_category", rules.CATEGORIES),
            quality.Accepted("labels", ("INBOX,STARRED",)),
        ),
        "dq_freshness": _dq_freshness,
        "dq_recency": lambda s, d: _check(_staged(s, d), quality.Recent("received_at")),
        "dq_relationship": lambda s, d: _check(
            _mail(s, d), quality.References("thread_id", _apps(s, d), "application_id")
        ),
        "dq_declared": lambda s, d: _check(_apps(s, d), *quality.APPLICATIONS),
    }
    portable = {name: _portable(query) for name, query in registered.items()}
    return portable | (llm_registry.queries() if llm_registry else {})


def oracle_sql() -> dict[str, str]:
    """The same results, stated for DuckDB over the same tables."""
    return oracle_queries.statements() | (llm_registry.oracle_sql() if llm_registry else {})
