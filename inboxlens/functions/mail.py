"""Column expressions for single mails: detection, category, source system, rank."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from inboxlens.functions import rules
from inboxlens.functions.regex import contains_any, has_phrase

# All characters that Unicode calls white space.
_WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x85\xa0          "
    "      　"
)


def is_job_mail(sender: Column, subject: Column, snippet: Column) -> Column:
    """Whether sender, subject or snippet carries a word of the job vocabulary.

    NULL inputs never match.  Under a filter the three-valued OR keeps the same rows as
    testing the three columns in turn.
    """
    return F.coalesce(
        contains_any(F.lower(sender), rules.SENDER_WORDS)
        | contains_any(F.lower(subject), rules.SUBJECT_WORDS)
        | contains_any(F.lower(snippet), rules.SNIPPET_WORDS),
        F.lit(False),
    )


def not_promotion(labels_lower: Column) -> Column:
    """Keep-predicate for mail outside the promotions tab; NULL labels give NULL."""
    return ~labels_lower.like(rules.PROMOTIONS_LIKE)


def headline_category(subject_snippet_lower: Column) -> Column:
    """First category whose phrases occur in subject and snippet, else NULL."""
    chain = F
    for name, words in rules.CATEGORY_PHRASES:
        chain = chain.when(has_phrase(subject_snippet_lower, words), F.lit(name))
    return chain


def body_category(body_lower: Column) -> Column:
    """Category of a mail whose headline says nothing."""
    declined = has_phrase(body_lower, rules.BODY_REJECTION_PHRASES)
    return F.when(declined, F.lit(rules.REJECTION)).otherwise(F.lit(rules.OTHER))


def status_rank(category_column: Column) -> Column:
    chain = F
    for name, rank in rules.STATUS_RANK.items():
        chain = chain.when(category_column == name, F.lit(rank))
    return chain.otherwise(F.lit(0))


def source_system(domain: str) -> Column:
    """Label of the first system whose domain occurs in a folded sender domain.

    NULL without a domain.  Matching against a constant list keeps the generated code
    small: the JVM never compiles a method beyond 8,000 bytes.
    """
    systems = ", ".join(
        f"named_struct('domain', '{d}', 'label', '{label}')"
        for label, domains in rules.SOURCE_DOMAINS
        for d in domains
    )
    first = F.expr(f"get(filter(array({systems}), s -> contains({domain}, s.domain)), 0).label")
    return F.when(F.col(domain).isNotNull(), F.coalesce(first, F.lit(rules.DIRECT)))


def is_employer_domain(domain: str) -> Column:
    """Whether a folded sender domain may name the employer."""
    others = ", ".join(f"'{d}'" for d in rules.NOT_AN_EMPLOYER)
    return F.expr(f"NOT exists(array({others}), d -> contains({domain}, d))")


def title_case(label: Column) -> Column:
    """Capitalise each hyphen-separated word of a domain label."""
    hyphen, space = F.lit("-"), F.lit(" ")
    return F.replace(F.initcap(F.replace(label, hyphen, space)), space, hyphen)


def strip_white_space(text: Column) -> Column:
    return F.btrim(text, F.lit(_WHITE_SPACE))


def null_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_true(conditions: list[tuple[Column, str]], default: str) -> Column:
    """Label of the first condition that holds."""
    chain = reduce(lambda acc, c: acc.when(c[0], F.lit(c[1])), conditions, F)
    return chain.otherwise(F.lit(default))
