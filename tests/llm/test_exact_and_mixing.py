"""Exact de-duplication and mixing."""

import math

import duckdb
import pytest
from helpers import DOCS, no_documents, odd_documents, rows_of
from pyspark.sql import functions as F

from inboxlens.llm import exact_dedup, mixing
from tools.compare import rows_of as counted

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("module", [exact_dedup, mixing])
def test_statement(spark, module):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    df = module.query(spark, SMALL)
    result = db.execute(module.SQL)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert counted(df.columns, [tuple(r) for r in df.collect()]) == counted(columns, result.fetchall())


def test_groups_of_odd_rows(spark):
    got = {}
    for r in exact_dedup.decide(odd_documents(spark, extra=True)).collect():
        got.setdefault(r["doc_id"], []).append((r["keep_id"], r["group_size"], r["kept"]))
    assert got[1] == [(2, 2, False)] and got[2] == [(2, 2, True)]
    assert got[3] == [(4, 2, False)] and got[4] == [(4, 2, True)]
    assert got[8] == [(8, 2, True)] * 2
    assert got[7] == [(7, 1, True)] and got[5] == [(5, 1, True)]


def test_only_ascii_letters_are_folded(spark):
    docs = spark.createDataFrame([(1, "É"), (2, "é"), (3, "K"), (4, "K"), (None, "k")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["keep_id"] for r in exact_dedup.decide(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, None: 3}


def test_one_row_of_a_group_stays_with_its_columns(spark):
    docs = odd_documents(spark, extra=True)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 5, 6, 7, 8, 9, 10]


def test_hot_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Same").otherwise(F.col("id").cast("string")).alias("text"))
    kept = exact_dedup.decide(docs).filter("kept")
    assert kept.count() == 2001
    assert kept.filter("group_size > 1").collect()[0]["group_size"] == 1000


@pytest.mark.parametrize("salts", [1, 32, 63])
def test_any_number_of_salts(spark, salts):
    docs = spark.range(700).selectExpr("id AS doc_id", "CAST(id % 5 AS string) AS text", "'x' AS salt", "'y' AS used")
    got = {(r["keep_id"], r["group_size"]) for r in exact_dedup.decide(docs, salts=salts).collect()}
    assert got == {(695 + k, 140) for k in range(5)}
    assert exact_dedup.decide(docs, salts=salts).count() == 700
    with pytest.raises(ValueError):
        exact_dedup.decide(docs, salts=64)


def test_a_repeated_row_is_the_first_by_its_content(spark):
    rows = [(1, "Same", "en", "b", 1), (1, "same", "en", "a", 2), (1, "same", "en", "a", 2), (0, "SAME", "en", "c", 3)]
    for order in (rows, rows[::-1]):
        kept = exact_dedup.keep_one(spark.createDataFrame(order, DOCS).repartition(3))
        assert [tuple(r) for r in kept.collect()] == [(1, "Same", "en", "b", 1)]


def test_empty_tables(spark):
    none = no_documents(spark)
    assert exact_dedup.decide(none).count() == 0
    assert exact_dedup.keep_one(none).count() == 0
    assert mixing.replicate(none).count() == 0
    assert mixing.rates(none).count() == 0


def test_mixing_of_odd_rows(spark):
    docs = odd_documents(spark, extra=True)
    mixed = mixing.replicate(docs, seed=3)
    assert mixed.columns[: len(docs.columns)] == docs.columns
    assert "_copy" in mixed.columns and "_position" in mixed.columns
    again = mixing.replicate(docs.repartition(3), seed=3)
    assert rows_of(mixed) == rows_of(again)


def test_target_shares_are_met(spark):
    text = "x" * 100
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.lit(text).alias("text"),
        F.when(F.col("id") % 3 > 0, "big").otherwise("small").alias("source"),
    )
    weights = spark.createDataFrame([("big", 1.0), ("small", 3.0), ("none", 5.0)], "source string, weight double")
    got = {r["source"]: r["n"] for r in mixing.replicate(docs, weights, seed=1).groupBy("source").agg(F.count("*").alias("n")).collect()}
    # 'none' holds no text, so the other two share the whole
    rate = {r["source"]: r["rate"] for r in mixing.rates(docs, weights).collect()}
    assert rate["small"] == pytest.approx(3 / 4 * 3) and rate["big"] == pytest.approx(1 / 4 * 3 / 2)
    for source, size in (("big", 4000), ("small", 2000)):
        mean = size * rate[source]
        assert abs(got[source] - mean) < 5 * math.sqrt(mean)


def test_large_rates_are_sums_of_parts(spark):
    rows = [(k, "ab", "tiny") for k in range(200)] + [(k, "y" * 200, "big") for k in range(200, 2200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    counts = mixing.replicate(docs).filter("source = 'tiny'").groupBy("doc_id").count().collect()
    rate = {r["source"]: r["rate"] for r in mixing.rates(docs).collect()}["tiny"]
    values = [r["count"] for r in counts]
    assert rate > 400 and len(values) == 200
    mean = sum(values) / 200
    spread = sum((v - mean) ** 2 for v in values) / 199
    assert abs(mean - rate) < 5 * math.sqrt(rate / 200) and 0.6 < spread / rate < 1.6


def test_no_weight_left(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS)
    weights = spark.createDataFrame([("s", 0.0)], "source string, weight double")
    assert mixing.replicate(docs, weights).count() == 0


def test_native_plans(plan_of, spark):
    docs = odd_documents(spark)
    for df in (exact_dedup.decide(docs), exact_dedup.keep_one(docs), mixing.replicate(docs)):
        assert not any(w in plan_of(df) for w in ("Python", "Arrow", "Pandas", "Cartesian"))
