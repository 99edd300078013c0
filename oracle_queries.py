"""DuckDB statements that state each registered query a second time.

They keep the unfused shape: one common table expression per model, joins between thread
aggregates, and the patterns in RE2, which DuckDB runs natively.
"""

from __future__ import annotations

from inboxlens.functions import rules
from inboxlens.sources.mailbox import CLOSINGS, SENDERS, SUBJECTS, TEMPLATES, UNTHREADED

_SPACES = (
    "' ' || " + " || ".join(f"chr({c})" for c in (
        9, 10, 11, 12, 13, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288
    ))
)


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _any(words: tuple[str, ...]) -> str:
    return _text("|".join(words))


def _phrases(words: tuple[str, ...]) -> str:
    return _text(r"\b(" + "|".join(words) + r")\b")


def _group(column: str, pattern: str) -> str:
    return f"nullif(regexp_extract({column}, {_text(pattern)}, 1), '')"


def _domains(names: tuple[str, ...]) -> str:
    return _text("(?i)" + "|".join(n.replace(".", r"\.") for n in names))


_TEMPLATE_ROWS = ",\n".join(
    f"({t.k}, {_text(t.sender)}, {_text(t.subject)}, {_text(t.snippet)}, "
    f"{_text(t.plain_body)}, {_text(t.labels)})"
    for t in TEMPLATES
)
MAIL = f"""
templates(k, sender, subject, snippet, plain_body, labels) AS (VALUES
{_TEMPLATE_ROWS}),
mail AS (
  SELECT CAST(e.event_id AS VARCHAR) AS message_id,
         CASE WHEN t.k <> {UNTHREADED}
              THEN CAST(e.user_id AS VARCHAR) || '-' || CAST(e.event_id % 25 AS VARCHAR)
         END AS thread_id,
         t.sender, t.subject, t.snippet, t.plain_body, t.labels,
         CAST(e.ts AS TIMESTAMP) AS received_at,
         CAST(e.ts AS TIMESTAMP) + INTERVAL 1 HOUR AS ingested_at
  FROM events e JOIN templates t ON t.k = (e.event_id * 7 + e.user_id) % {len(TEMPLATES)})"""

STAGED = MAIL + """,
staged AS (
  SELECT message_id, thread_id, sender, subject, snippet, plain_body, labels, received_at,
         ingested_at, lower(labels) AS labels_lower,
         lower(subject || ' ' || snippet) AS subject_snippet_lower
  FROM mail WHERE message_id IS NOT NULL)"""

FOUND = STAGED + f""",
found AS (
  SELECT *, true AS is_job_email FROM staged
  WHERE NOT (labels_lower LIKE {_text(rules.PROMOTIONS_LIKE)})
    AND (coalesce(regexp_matches(lower(sender), {_any(rules.SENDER_WORDS)}), false)
      OR coalesce(regexp_matches(lower(subject), {_any(rules.SUBJECT_WORDS)}), false)
      OR coalesce(regexp_matches(lower(snippet), {_any(rules.SNIPPET_WORDS)}), false)))"""

_CATEGORY = "\n".join(
    f"WHEN regexp_matches(subject_snippet_lower, {_phrases(words)}) THEN {_text(name)}"
    for name, words in rules.CATEGORY_PHRASES
)
CLASSIFIED = FOUND + f""",
classified AS (
  SELECT *, CASE {_CATEGORY}
    WHEN regexp_matches(lower(plain_body), {_phrases(rules.BODY_REJECTION_PHRASES)})
    THEN {_text(rules.REJECTION)}
    ELSE {_text(rules.OTHER)} END AS job_pipeline_category
  FROM found)"""

_SOURCES = "\n".join(
    f"WHEN regexp_matches(domain, {_domains(domains)}) THEN {_text(label)}"
    for label, domains in rules.SOURCE_DOMAINS
)
_RANKS = " ".join(f"WHEN {_text(c)} THEN {r}" for c, r in rules.STATUS_RANK.items())

GUESSED = CLASSIFIED + f""",
signals AS (
  SELECT *, {_group('sender', rules.SENDER_DOMAIN)} AS domain,
         nullif(trim(regexp_replace(
           coalesce({_group('sender', rules.SENDER_DISPLAY)}, ''),
           {_text(rules.GENERIC_SUFFIX)}, ''), {_SPACES}), '') AS display,
         coalesce(plain_body, '') AS body_head
  FROM classified WHERE thread_id IS NOT NULL),
labelled AS (
  SELECT *, CASE WHEN NOT regexp_matches(domain, {_domains(rules.NOT_AN_EMPLOYER)})
                 THEN {_group('domain', rules.DOMAIN_LABEL)} END AS label
  FROM signals),
guessed AS (
  SELECT message_id, thread_id, received_at, job_pipeline_category,
    coalesce(
      CASE WHEN length(display) BETWEEN 2 AND 60 THEN display END,
      {_group('subject', rules.COMPANY_IN_SUBJECT[0])},
      {_group('body_head', rules.COMPANY_IN_BODY[0])},
      array_to_string(list_transform(string_split(lower(label), '-'),
        lambda w: upper(w[1:1]) || w[2:]), '-')) AS company_guess,
    coalesce(
      {_group('subject', rules.ROLE_APPLYING_SUBJECT[0])},
      {_group('subject', rules.ROLE_FOR_THE_SUBJECT[0])},
      {_group('subject', rules.ROLE_AT_SUBJECT[0])},
      {_group('body_head', rules.ROLE_APPLYING_BODY[0])}) AS role_guess,
    CASE {_SOURCES} WHEN domain IS NOT NULL THEN {_text(rules.DIRECT)} END AS ats_source_guess
  FROM labelled)"""

ROLLUP = """
rollup AS (
  SELECT thread_id,
    min(received_at) FILTER (WHERE job_pipeline_category = 'applications submitted') AS applied_at,
    min(received_at) AS first_email_at, max(received_at) AS last_email_at,
    count(*) AS email_count,
    bool_or(job_pipeline_category = 'interview scheduling') AS has_interview,
    bool_or(job_pipeline_category = 'offer') AS has_offer,
    bool_or(job_pipeline_category = 'rejection') AS has_rejection,
    bool_or(job_pipeline_category = 'recruiter outreach') AS has_recruiter_outreach
  FROM classified WHERE thread_id IS NOT NULL GROUP BY thread_id)"""

RANKED = f"""
ranked AS (
  SELECT message_id, thread_id, received_at, job_pipeline_category,
         CASE job_pipeline_category {_RANKS} ELSE 0 END AS status_rank
  FROM classified)"""

LATEST = RANKED + """,
latest AS (
  SELECT thread_id, received_at AS latest_status_at FROM ranked WHERE thread_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY thread_id
    ORDER BY status_rank DESC, received_at DESC NULLS LAST) = 1)"""


def _winner(guess: str, name: str) -> str:
    return f"""
{name}_winner AS (
  SELECT thread_id, {guess} AS {name} FROM guessed WHERE {guess} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY thread_id
    ORDER BY received_at NULLS FIRST, message_id) = 1)"""


WINNERS = ",".join(
    (
        _winner("company_guess", "company"),
        _winner("role_guess", "role"),
        _winner("ats_source_guess", "ats_source"),
        """
winners AS (
  SELECT t.thread_id, c.company, r.role, a.ats_source
  FROM (SELECT DISTINCT thread_id FROM guessed) t
  LEFT JOIN company_winner c ON c.thread_id = t.thread_id
  LEFT JOIN role_winner r ON r.thread_id = t.thread_id
  LEFT JOIN ats_source_winner a ON a.thread_id = t.thread_id)""",
    )
)


def _apps(no_response_days: int = 14) -> str:
    return f"""{GUESSED},{ROLLUP},{LATEST},{WINNERS},
assembled AS (
  SELECT r.thread_id AS application_id, w.company, w.role, w.ats_source, r.applied_at,
    r.first_email_at, r.last_email_at, r.email_count, l.latest_status_at, r.has_interview,
    r.has_offer, r.has_rejection, r.has_recruiter_outreach,
    (r.applied_at IS NOT NULL AND NOT r.has_interview AND NOT r.has_offer
      AND NOT r.has_rejection
      AND date_sub('day', r.applied_at, TIMESTAMP '2024-02-01') >= {no_response_days}
    ) AS is_no_response
  FROM rollup r
  LEFT JOIN latest l ON l.thread_id = r.thread_id
  LEFT JOIN winners w ON w.thread_id = r.thread_id),
apps AS (
  SELECT *,
    CASE WHEN has_offer THEN 'offer' WHEN has_rejection THEN 'rejection'
         WHEN has_interview THEN 'interview' WHEN is_no_response THEN 'no_response'
         WHEN applied_at IS NOT NULL THEN 'application'
         WHEN has_recruiter_outreach THEN 'recruiter' ELSE 'other' END AS outcome,
    CASE WHEN has_offer OR has_rejection
         THEN date_sub('day', coalesce(applied_at, first_email_at), latest_status_at)
    END AS days_in_pipeline
  FROM assembled)"""


APPS = _apps()

LEDGER = """
daily AS (
  SELECT date_trunc('day', CAST(ts AS TIMESTAMP)) AS sync_start, count(*) AS n,
         max(CAST(ts AS TIMESTAMP)) AS newest
  FROM events GROUP BY 1),
ledger AS (
  SELECT 'run-' || (dayofweek(sync_start) + 1) AS run_id, newest AS started_at,
         newest + INTERVAL 5 MINUTE AS finished_at,
         CASE WHEN dayofweek(sync_start) > 3 THEN 'error' ELSE 'ok' END AS status,
         sync_start, sync_start + INTERVAL 1 DAY AS sync_end,
         CAST(CASE WHEN dayofweek(sync_start) > 3 THEN 0 ELSE n END AS BIGINT) AS fetched,
         CAST(CASE WHEN dayofweek(sync_start) > 3 THEN 0 ELSE n END AS BIGINT) AS inserted
  FROM daily)"""


def _windows(limits: str, days: int) -> str:
    """CTE ``windows`` over a one-row relation ``(lo, hi)``."""
    return f"""
limits AS ({limits}),
cuts AS (
  SELECT lo, hi, unnest(generate_series(date_trunc('day', lo), hi, INTERVAL {days} DAY)) AS cut
  FROM limits WHERE lo < hi),
windows AS (
  SELECT greatest(cut, lo) AS sync_start, least(cut + INTERVAL {days} DAY, hi) AS sync_end
  FROM cuts WHERE greatest(cut, lo) < least(cut + INTERVAL {days} DAY, hi))"""


_DATA_LIMITS = (
    "SELECT date_trunc('second', min(CAST(ts AS TIMESTAMP))) AS lo, "
    "date_trunc('second', max(CAST(ts AS TIMESTAMP))) AS hi FROM events"
)
_FIRST = "(SELECT date_trunc('second', min(CAST(ts AS TIMESTAMP))) FROM events)"
_LAST = "(SELECT date_trunc('second', max(CAST(ts AS TIMESTAMP))) + INTERVAL 1 SECOND FROM events)"
_CUT = f"date_trunc('day', {_FIRST} + 2 * (({_LAST} - {_FIRST}) / 3))"
_ALL_LIMITS = f"SELECT {_FIRST} AS lo, {_LAST} AS hi"
# a sync begins at midnight of the first day and ends at midnight after the last
_FLOOR = f"date_trunc('day', {_FIRST})"
_END = f"(date_trunc('day', {_LAST}) + INTERVAL 1 DAY)"
_MIDDLE = f"date_trunc('day', {_FIRST} + ({_LAST} - {_FIRST}) / 2)"
_SYNC_LIMITS = f"SELECT {_FLOOR} AS lo, {_END} AS hi"
SPLIT = f"""
landed AS (SELECT * FROM mail WHERE received_at < {_CUT}),
arriving AS (SELECT * FROM mail)"""

_LANDED_COLUMNS = (
    "message_id, thread_id, 'h' || message_id AS history_id, subject, sender, snippet, "
    "coalesce(plain_body, '') AS plain_body, "
    "CASE WHEN plain_body IS NULL THEN '' ELSE '<p>' || plain_body || '</p>' END AS html_body, "
    "coalesce(labels, '') AS labels, date_trunc('milliseconds', received_at) AS received_at"
)

def _synced(select: str) -> str:
    """A select over ``done``: the windows of a sync with their counts."""
    return (
        f"WITH {MAIL}, inbox AS (SELECT * FROM mail WHERE labels LIKE '%INBOX%'), "
        + _windows(_SYNC_LIMITS, 1).strip()
        + ", done AS (SELECT w.sync_start, w.sync_end, count(m.message_id) AS fetched, "
        "count(m.message_id) AS inserted FROM windows w LEFT JOIN inbox m ON "
        "date_trunc('milliseconds', m.received_at) >= w.sync_start AND "
        f"date_trunc('milliseconds', m.received_at) < w.sync_end GROUP BY ALL) SELECT {select}"
    )


def _listed(values: tuple[str, ...], number: str) -> str:
    return f"([{', '.join(_text(v) for v in values)}])[({number}) % {len(values)} + 1]"


_BODY = "concat_ws(chr(10), text, {closing})"
DOCUMENT_MAIL = f"""
mail AS (
  SELECT CAST(doc_id AS VARCHAR) AS message_id, concat_ws('-', source, doc_id % 50) AS thread_id,
         {_listed(SENDERS, 'doc_id')} AS sender, {_listed(SUBJECTS, 'doc_id')} AS subject,
         lang AS snippet, {_BODY.format(closing=_listed(CLOSINGS, 'doc_id'))} AS plain_body,
         'INBOX' AS labels, TIMESTAMP '2024-01-01' + to_seconds(doc_id * 60) AS received_at,
         TIMESTAMP '2024-01-01' AS ingested_at
  FROM documents)"""
TURN_MAIL = f"""
mail AS (
  SELECT conv_id || '/' || turn AS message_id, CAST(conv_id AS VARCHAR) AS thread_id,
         'jobs@' || role || '.com' AS sender, 'Application of the ' || role AS subject,
         substr(text, 1, 80) AS snippet,
         {_BODY.format(closing=_listed(CLOSINGS, 'conv_id + turn'))} AS plain_body,
         'INBOX' AS labels, TIMESTAMP '2024-01-01' + to_seconds(conv_id * 60 + turn) AS received_at,
         TIMESTAMP '2024-01-01' AS ingested_at
  FROM conversations)"""


def _on(chain: str, mail: str) -> str:
    """The same models over another mail relation."""
    return chain.replace(MAIL, mail)


_AS_OF = "TIMESTAMP '2024-02-01'"


def _status(failures: str) -> str:
    return f"CAST({failures} AS BIGINT) AS failures, CASE WHEN {failures} > 0 THEN 'error' ELSE 'pass' END AS status"


def _not_null(table: str, column: str) -> str:
    count = f"(SELECT count(*) FROM {table} WHERE {column} IS NULL)"
    return f"""SELECT 'not_null:{column}' AS "check", {_status(count)}"""


def _unique(table: str, column: str) -> str:
    count = (
        f"(SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1))"
    )
    return f"""SELECT 'unique:{column}' AS "check", {_status(count)}"""


def _accepted(table: str, column: str, values: tuple[str, ...]) -> str:
    allowed = ", ".join(_text(v) for v in values)
    count = f"(SELECT count(*) FROM {table} WHERE {column} NOT IN ({allowed}))"
    return f"""SELECT 'accepted_values:{column}' AS "check", {_status(count)}"""


def _fresh(table: str, column: str, as_of: str) -> str:
    age = f"({as_of} - (SELECT max({column}) FROM {table}))"
    return f"""SELECT 'freshness:{column}' AS "check",
      CAST(coalesce({age} > INTERVAL 24 HOUR, true) AS BIGINT) AS failures,
      CASE WHEN coalesce({age} > INTERVAL 72 HOUR, true) THEN 'error'
           WHEN {age} > INTERVAL 24 HOUR THEN 'warn' ELSE 'pass' END AS status"""


def _recent(table: str, column: str, as_of: str) -> str:
    late = f"CAST(coalesce((SELECT max({column}) FROM {table}) < {as_of} - INTERVAL 72 HOUR, false) AS BIGINT)"
    return f"""SELECT 'recency:{column}' AS "check", {_status(late)}"""


def _union(*selects: str) -> str:
    return "\nUNION ALL\n".join(selects)


def statements() -> dict[str, str]:
    """One statement per query key."""
    return {
        "category_counts": f"WITH {CLASSIFIED} SELECT job_pipeline_category, count(*) AS emails "
        "FROM classified GROUP BY 1",
        "staging_messages": f"WITH {STAGED} SELECT * FROM staged",
        "job_email_finder": f"WITH {FOUND} SELECT message_id, thread_id, sender, subject, "
        "snippet, is_job_email FROM found",
        "email_classifier": f"WITH {CLASSIFIED} SELECT message_id, subject, "
        "job_pipeline_category FROM classified",
        "email_mart": f"WITH {CLASSIFIED} SELECT message_id, thread_id, sender, subject, snippet, "
        "plain_body, labels, received_at, job_pipeline_category FROM classified",
        "status_rank": f"WITH {CLASSIFIED},{RANKED} SELECT message_id, job_pipeline_category, "
        "status_rank FROM ranked",
        "company_extract": f"WITH {GUESSED} SELECT message_id, company_guess FROM guessed",
        "role_extract": f"WITH {GUESSED} SELECT message_id, role_guess FROM guessed",
        "ats_source": f"WITH {GUESSED} SELECT message_id, ats_source_guess FROM guessed",
        "application_extract": f"WITH {GUESSED} SELECT thread_id, received_at, company_guess, "
        "role_guess, ats_source_guess FROM guessed",
        "thread_rollup": f"WITH {CLASSIFIED},{ROLLUP} SELECT * FROM rollup",
        "latest_status": f"WITH {CLASSIFIED},{LATEST} SELECT * FROM latest",
        "extract_winners": f"WITH {GUESSED},{WINNERS} SELECT * FROM winners",
        "application_mart": f"WITH {APPS} SELECT * FROM apps",
        "application_mart_21_days": f"WITH {_apps(21)} SELECT * FROM apps",
        "scorecards": f"WITH {APPS} SELECT count(applied_at) AS total_applied, "
        "count(*) FILTER (WHERE has_interview) AS interviews, "
        "count(*) FILTER (WHERE has_offer) AS offers, "
        "count(*) FILTER (WHERE is_no_response) AS no_response FROM apps",
        "scorecard_month_delta": f"WITH {APPS} SELECT count(*) FILTER (WHERE "
        "date_trunc('month', applied_at) = TIMESTAMP '2024-01-01') AS applied_this_month FROM apps",
        "funnel": f"WITH {APPS} "
        + _union(
            "SELECT 1 AS position, 'applied' AS stage, count(applied_at) AS applications FROM apps",
            "SELECT 2, 'recruiter', count(*) FILTER (WHERE has_recruiter_outreach) FROM apps",
            "SELECT 3, 'interview', count(*) FILTER (WHERE has_interview) FROM apps",
            "SELECT 4, 'offer', count(*) FILTER (WHERE has_offer) FROM apps",
        ),
        "outcome_donut": f"WITH {APPS} SELECT outcome, count(*) AS applications FROM apps GROUP BY 1",
        "applications_over_time": f"WITH {APPS} SELECT CAST(date_trunc('week', applied_at) AS DATE) "
        "AS week, count(*) AS applications FROM apps GROUP BY 1",
        "company_role_table": f"WITH {APPS} SELECT company, role, ats_source, applied_at, outcome "
        "FROM apps",
        "outcome_filter": f"WITH {APPS} SELECT * FROM apps WHERE outcome IN "
        "('interview', 'offer', 'rejection', 'no_response')",
        "dashboard_meta": f"WITH {APPS} SELECT {_AS_OF} AS mart_built_at, "
        "(SELECT max(received_at) FROM staged) AS data_through, "
        "(SELECT count(*) FROM apps) AS application_count",
        "ingest_windows": f"WITH {_windows(_DATA_LIMITS, 1)} SELECT * FROM windows",
        "ingest_windows_3_days": f"WITH {_windows(_DATA_LIMITS, 3)} SELECT * FROM windows",
        "window_assignment": f"WITH {MAIL},{_windows(_ALL_LIMITS, 2)} "
        "SELECT m.message_id, w.sync_start, w.sync_end FROM mail m JOIN windows w "
        "ON m.received_at >= w.sync_start AND m.received_at < w.sync_end",
        "ingest_dedup": f"WITH {MAIL},{SPLIT} SELECT message_id, thread_id, received_at FROM arriving "
        "WHERE message_id NOT IN (SELECT message_id FROM landed)",
        "first_copies": "SELECT l_orderkey || '-' || l_linenumber AS message_id, "
        "min(CAST(l_shipdate AS DATE)) AS received_at, count(*) AS copies FROM lineitem GROUP BY 1",
        "window_counts": f"WITH {MAIL},{SPLIT},{_windows(_ALL_LIMITS, 1)} "
        "SELECT w.sync_start, w.sync_end, count(m.message_id) AS fetched, "
        f"count(*) FILTER (WHERE m.message_id IS NOT NULL AND m.received_at >= "
        f"{_CUT}) AS inserted FROM windows w LEFT JOIN arriving m "
        "ON m.received_at >= w.sync_start AND m.received_at < w.sync_end GROUP BY ALL",
        "window_cap": f"WITH {MAIL},{_windows(_ALL_LIMITS, 1)} "
        "SELECT m.message_id, w.sync_start FROM mail m JOIN windows w "
        "ON m.received_at >= w.sync_start AND m.received_at < w.sync_end "
        "QUALIFY row_number() OVER (PARTITION BY w.sync_start "
        "ORDER BY m.received_at, m.message_id) <= 100",
        "watermark": f"WITH {LEDGER} SELECT date_trunc('second', coalesce("
        "(SELECT max(sync_end) FROM ledger WHERE status = 'ok'), "
        "(SELECT max(CAST(ts AS TIMESTAMP)) FROM events), TIMESTAMP '2026-03-01')) AS sync_start",
        "watermark_fallback": "SELECT date_trunc('second', max(CAST(ts AS TIMESTAMP))) "
        "AS sync_start FROM events",
        "run_summary": f"WITH {LEDGER} SELECT run_id, CAST(sum(fetched) AS BIGINT) AS fetched, "
        "CAST(sum(inserted) AS BIGINT) AS inserted, count(*) AS windows_completed, "
        "min(sync_start) AS sync_start, max(sync_end) AS sync_end "
        "FROM ledger WHERE status = 'ok' GROUP BY run_id",
        "sync_ledger": _synced("'ok' AS status, sync_start, sync_end, fetched, inserted FROM done"),
        "sync_daily_commits": _synced(
            "'ok' AS status, sync_start, sync_end, fetched, inserted FROM done"
        ),
        "sync_backfill": _synced(
            "'ok' AS status, 2 * count(*) AS windows, CAST(2 * sum(fetched) AS BIGINT) AS fetched, "
            "CAST(sum(inserted) AS BIGINT) AS inserted, CAST(sum(inserted) AS BIGINT) AS messages FROM done"
        ),
        "sync_rerun": _synced(
            "'ok' AS status, count(*) AS windows, CAST(sum(fetched) AS BIGINT) AS fetched, "
            "CAST(sum(inserted) AS BIGINT) AS inserted, CAST(sum(inserted) AS BIGINT) AS messages FROM done"
        ),
        "sync_error_ledger": _synced(
            "'ok' AS status, sync_start, sync_end, fetched, inserted, CAST(NULL AS BOOLEAN) AS names_error, "
            "true AS has_run_id, true AS in_order FROM done "
            f"UNION ALL SELECT 'error', {_MIDDLE}, {_END}, 0, 0, true, true, true"
        ),
        "sync_late_mail": f"WITH {MAIL} SELECT {_LANDED_COLUMNS} FROM mail "
        "WHERE labels LIKE '%INBOX%'",
        "sync_capped": f"WITH {MAIL} SELECT {_LANDED_COLUMNS} FROM mail "
        "WHERE labels LIKE '%INBOX%'",
        "sync_odd_files": f"WITH {MAIL} SELECT {_LANDED_COLUMNS} FROM mail WHERE labels LIKE '%INBOX%' "
        "UNION ALL SELECT * REPLACE ('late ' || message_id AS message_id) FROM "
        f"(SELECT {_LANDED_COLUMNS} FROM mail WHERE labels LIKE '%INBOX%')",
        "sync_search": f"WITH {MAIL} SELECT {_LANDED_COLUMNS} FROM mail "
        "WHERE (',' || labels || ',') SIMILAR TO '.*,(INBOX|STARRED),.*' "
        "AND NOT contains(labels, 'CATEGORY_PROMOTIONS') AND received_at >= TIMESTAMP '2024-01-03' "
        "AND NOT contains(lower(coalesce(subject, '')), 'dinner') AND ("
        "contains(lower(sender), 'acme') OR contains(lower(coalesce(subject, '')), 'interview for') "
        "OR contains(lower(concat_ws(chr(10), subject, sender, snippet)), 'schedule a call') "
        "OR (contains(lower(sender), 'hire') AND contains(lower(sender), 'lever')) "
        "OR contains(lower(concat_ws(chr(10), subject, sender, snippet)), 'snippet-free') "
        "OR contains(lower(concat_ws(chr(10), subject, sender, snippet)), 'hello'))",
        "sync_ingested_at": f"WITH {MAIL} SELECT message_id, true AS after_receipt, true AS is_set "
        "FROM mail WHERE labels LIKE '%INBOX%'",
        "compacted_messages": f"WITH {MAIL} SELECT message_id, thread_id, sender, subject, received_at, "
        "true AS fewer_files FROM mail",
        "build_emails": f"WITH {CLASSIFIED} SELECT message_id, thread_id, sender, subject, snippet, "
        "plain_body, labels, received_at, job_pipeline_category FROM classified",
        "build_applications": f"WITH {APPS} SELECT * FROM apps",
        "refreshed_applications": f"WITH {APPS} SELECT * FROM apps",
        "build_meta": f"WITH {APPS} SELECT {_AS_OF} AS mart_built_at, "
        "(SELECT max(received_at) FROM staged) AS data_through, "
        "(SELECT count(*) FROM apps) AS application_count",
        "last_updated": f"SELECT {_AS_OF} AS mart_built_at",
        "build_report": f"WITH {CLASSIFIED} SELECT CASE WHEN failed THEN 'error' ELSE 'pass' END AS status, "
        "count(*) AS checks FROM (SELECT unnest(list_concat("
        "list_transform(range(26), lambda x: false), "
        f"[(SELECT max(received_at) < {_AS_OF} - INTERVAL 72 HOUR FROM staged)])) AS failed) GROUP BY 1",
        "documents_classified": f"WITH {_on(CLASSIFIED, DOCUMENT_MAIL)} SELECT message_id, "
        "job_pipeline_category FROM classified",
        "documents_company": f"WITH {_on(GUESSED, DOCUMENT_MAIL)} SELECT message_id, company_guess, "
        "ats_source_guess FROM guessed",
        "documents_company_head": f"WITH {_on(GUESSED, DOCUMENT_MAIL)} ".replace(
            "coalesce(plain_body, '') AS body_head",
            f"substr(coalesce(plain_body, ''), 1, {rules.BODY_HEAD_CHARS}) AS body_head",
        )
        + "SELECT message_id, company_guess FROM guessed",
        "documents_role": f"WITH {_on(GUESSED, DOCUMENT_MAIL)} SELECT message_id, role_guess FROM guessed",
        "conversations_classified": f"WITH {_on(CLASSIFIED, TURN_MAIL)} SELECT message_id, "
        "job_pipeline_category FROM classified",
        "landing_deep": "SELECT conv_id || '/' || turn AS message_id, "
        "role || chr(10) || text AS plain_body FROM conversations",
        "landing_40_levels": "SELECT conv_id || '/' || turn AS message_id, "
        "role || chr(10) || text AS plain_body FROM conversations",
        "landing_quarantine": "SELECT reason, count(*) AS lines, count(*) AS kept_whole FROM (SELECT "
        "CASE doc_id % 12 WHEN 1 THEN 'malformed json' WHEN 2 THEN 'malformed json' "
        "WHEN 4 THEN 'no message id' WHEN 5 THEN 'bad internal date' WHEN 7 THEN 'bad base64' "
        "ELSE 'no internal date' END AS reason FROM documents) GROUP BY reason",
        "sync_messages": f"WITH {MAIL} SELECT {_LANDED_COLUMNS} FROM mail "
        "WHERE labels LIKE '%INBOX%'",
        "stream_messages": f"WITH {MAIL} SELECT {_LANDED_COLUMNS} FROM mail "
        "WHERE labels LIKE '%INBOX%'",
        "landing_roundtrip": f"WITH {MAIL} SELECT {_LANDED_COLUMNS} FROM mail",
        "landing_documents": "SELECT CAST(doc_id AS VARCHAR) AS message_id, source AS thread_id, "
        "lang AS subject, 'INBOX,' || lang AS labels, md5(text) AS plain_md5, "
        "CAST(length(text) AS BIGINT) AS plain_chars, md5('<p>' || text || '</p>') AS html_md5 "
        "FROM documents",
        "landing_body_cap": "SELECT CAST(doc_id AS VARCHAR) AS message_id, "
        "substr(text, 1, 500) AS plain_body, substr('<p>' || text || '</p>', 1, 500) AS html_body "
        "FROM documents",
        "landing_pages": "SELECT CAST(page_id AS VARCHAR) AS message_id, url AS subject, "
        "'' AS plain_body, md5(html) AS html_md5 FROM pages",
        "landing_parts": "SELECT conv_id || '/' || turn AS message_id, "
        "role || chr(10) || text AS plain_body, '' AS html_body FROM conversations",
        "dq_not_null": f"WITH {MAIL} "
        + _union(*(_not_null("mail", c) for c in ("message_id", "thread_id", "subject", "labels", "received_at"))),
        "dq_unique": f"WITH {MAIL} " + _union(*(_unique("mail", c) for c in ("message_id", "thread_id"))),
        "dq_accepted_values": f"WITH {CLASSIFIED} "
        + _union(
            _accepted("classified", "job_pipeline_category", rules.CATEGORIES),
            _accepted("classified", "labels", ("INBOX,STARRED",)),
        ),
        "dq_freshness": f"WITH {MAIL},{LEDGER} "
        + _union(
            _fresh("mail", "ingested_at", _AS_OF),
            _fresh("ledger", "finished_at", "TIMESTAMP '2024-02-20'"),
        ),
        "dq_recency": f"WITH {STAGED} SELECT * FROM ("
        + _union(_recent("staged", "received_at", _AS_OF))
        + ")",
        "dq_relationship": f"""WITH {APPS} SELECT 'references:thread_id' AS "check", """
        + _status(
            "(SELECT count(*) FROM mail m WHERE m.thread_id IS NOT NULL AND NOT EXISTS "
            "(SELECT 1 FROM apps a WHERE a.application_id = m.thread_id))"
        ),
        "dq_declared": f"WITH {APPS} "
        + _union(
            _unique("apps", "application_id"),
            *(
                _not_null("apps", c)
                for c in (
                    "application_id", "first_email_at", "last_email_at", "email_count",
                    "latest_status_at", "has_interview", "has_offer", "has_rejection",
                    "has_recruiter_outreach", "is_no_response", "outcome",
                )
            ),
            _accepted("apps", "outcome", rules.OUTCOMES),
        ),
    }
