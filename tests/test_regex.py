"""The Java spelling of every pattern agrees with RE2, with DuckDB as the RE2 engine."""

import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from inboxlens.functions import rules
from inboxlens.functions.regex import first_group, has_phrase, phrases, re2
from inboxlens.sources.mailbox import TEMPLATES

TEXTS = [
    "caféoffer position",
    "offerings are no offer",
    "job\n",
    "applying for the Lead job\n",
    "applying for Data Engineer",
    "Applying for  the  R&D / Ops - Lead   role",
    "a\x0bposition",
    "interview\x0bat noon",
    "for the\x0bBuilder role",
    "Open role at Hooli",
    "thank you for applying to stripe today now ok bye",
    "Application for A.B-C & Sons",
    "we met AT\tFoo\nBar",
    "to Émile",
    "to Emile Zola Jr. III Esq",
    '"Stripe Careers" <x@stripe.com>',
    "Steam <a@b.c>",
    ' "  Acme  Talent Acquisition " <jobs@mail.acme.com>',
    "no-reply@x.io",
    "<only@angle.brackets>",
    "two@signs@here.org",
    "NO REPLY <no_reply@x>",
    "",
    "x" * 70 + " <long@name.com>",
    "opportunity at Foo",
    "not selected_ not selected",
    "_interview interview_ (interview)",
]
GROUPS = [
    rules.SENDER_DOMAIN,
    rules.SENDER_DISPLAY,
    rules.DOMAIN_LABEL,
    rules.COMPANY_IN_SUBJECT[0],
    rules.COMPANY_IN_BODY[0],
    rules.ROLE_APPLYING_SUBJECT[0],
    rules.ROLE_FOR_THE_SUBJECT[0],
    rules.ROLE_AT_SUBJECT[0],
    rules.ROLE_APPLYING_BODY[0],
]


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    """Odd strings, the mail templates, and the texts of the documents table."""
    fixed = TEXTS + [v for t in TEMPLATES for v in t[1:5] if v]
    folder = str(tmp_path_factory.mktemp("texts"))
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").select("text")
    spark.createDataFrame([(t,) for t in fixed], "text string").unionByName(
        documents
    ).coalesce(1).write.mode("overwrite").parquet(folder)
    return folder


def test_groups_agree(spark, texts):
    df = spark.read.parquet(texts)
    mine = df.select("text", *(first_group(F.col("text"), p).alias(f"g{i}") for i, p in enumerate(GROUPS)))
    columns = ", ".join(f"regexp_extract(text, ?, 1) AS g{i}" for i in range(len(GROUPS)))
    theirs = duckdb.execute(f"SELECT text, {columns} FROM '{texts}/*.parquet'", GROUPS).fetchall()
    assert sorted(map(tuple, mine.collect())) == sorted(theirs)


def test_phrases_agree(spark, texts):
    df = spark.read.parquet(texts).select("text", F.lower("text").alias("low"))
    lists = [words for _, words in rules.CATEGORY_PHRASES]
    mine = df.select("low", *(has_phrase(F.col("low"), w).alias(f"m{i}") for i, w in enumerate(lists)))
    low = [r[0] for r in mine.collect()]
    frame = spark.createDataFrame([(t,) for t in low], "low string").toPandas()
    con = duckdb.connect()
    con.register("frame", frame)
    columns = ", ".join("regexp_matches(low, ?)" for _ in lists)
    theirs = con.execute(f"SELECT low, {columns} FROM frame", [phrases(w) for w in lists]).fetchall()
    assert sorted(map(tuple, mine.collect())) == sorted(theirs)


def test_suffix_strip_agrees(spark, texts):
    df = spark.read.parquet(texts)
    mine = df.select("text", F.regexp_replace("text", re2(rules.GENERIC_SUFFIX), F.lit("")))
    theirs = duckdb.execute(
        f"SELECT text, regexp_replace(text, ?, '') FROM '{texts}/*.parquet'", [rules.GENERIC_SUFFIX]
    ).fetchall()
    assert sorted(map(tuple, mine.collect())) == sorted(theirs)


def test_prefilter_words_are_necessary(spark, texts):
    """No text matches a pattern without one of the words that guard it."""
    df = spark.read.parquet(texts).withColumn("low", F.lower("text"))
    for pattern, words in (
        rules.COMPANY_IN_SUBJECT,
        rules.COMPANY_IN_BODY,
        rules.ROLE_APPLYING_SUBJECT,
        rules.ROLE_FOR_THE_SUBJECT,
        rules.ROLE_AT_SUBJECT,
        rules.ROLE_APPLYING_BODY,
    ):
        guarded = F.lit(False)
        for word in words:
            guarded = guarded | F.col("low").contains(word)
        assert df.filter(~guarded & (first_group(F.col("text"), pattern) != "")).count() == 0


def test_spelling():
    assert re2(r"\b(a|b)\b") == r"(?<![A-Za-z0-9_])(a|b)(?![A-Za-z0-9_])"
    assert re2(r"(?i)\bx$") == r"(?i)(?<![A-Za-z0-9_])x\z"
    assert re2(r"[^>\s]\s") == r"[^>\t\n\f\r ][\t\n\f\r ]"
