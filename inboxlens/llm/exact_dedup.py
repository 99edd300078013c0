"""Exact de-duplication by skew-safe combining.

Three levels, each grouping by the digest *and* the whole text, so that texts are equal because
they were compared and not because their digests are:

1. copies inside one task are combined before anything is sent (map-side aggregation),
2. the rest meets by (digest, salt), the salt drawn from the id, so that a group with a third of
   all rows is spread over ``salts`` tasks,
3. the winners of the salts, at most ``salts`` rows a text, are combined globally.

Rows then meet their group's winner at the salt they had, to which the winner is sent once for each
salt its group uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inboxlens.llm.common import ascii_lower, fresh

SALTS = 32


def _body(text: str) -> Column:
    return ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit("")))


def decide(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  The largest id
    of a group stays (a null id loses to any other).  Rows that repeat an id and a text each get
    a row and count in ``group_size``.  An empty table gives an empty result; other columns of
    the input, whatever their names, are not read.

    Rows find their group again by salt, SHA-256 and a second 64-bit hash of the text, so that
    texts do not travel a third time and a group with a third of all rows is spread over its
    salts there too.  ``salts`` is at most 63.
    """
    if not 1 <= salts <= 63:
        raise ValueError("salts: 1 to 63")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int").alias("salt"),
        _body(text_col).alias("body"),
    ).withColumn("sha", F.sha2("body", 256))
    salted = rows.groupBy("sha", "salt", "body").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    used = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("salt"))
    groups = (
        salted.groupBy("sha", "body")
        .agg(
            F.max("keep_id").alias("keep_id"),
            F.sum("n").alias("group_size"),
            F.bit_or(used).alias("used"),
        )
        .select(
            "sha",
            F.xxhash64("body").alias("check"),
            "keep_id",
            "group_size",
            F.explode(
                F.filter(
                    F.sequence(F.lit(0), F.lit(salts - 1)),
                    lambda k: F.call_function("getbit", F.col("used"), k) == 1,
                )
            ).alias("salt"),
        )
    )
    narrow = rows.select("id", "salt", "sha", F.xxhash64("body").alias("check"))
    return narrow.join(groups, ["sha", "check", "salt"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_one(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS
) -> DataFrame:
    """The input's rows and columns, one row of every group of equal texts.

    Rows that repeat both the id and the text are reduced to one, the first by its JSON form.
    """
    winner, times = fresh(docs, "winner"), fresh(docs, "times")
    winners = (
        decide(docs, id_col=id_col, text_col=text_col, salts=salts)
        .filter("kept")
        .groupBy(F.col(id_col).alias(winner), "text_sha256")
        .agg(F.count(F.lit(1)).alias(times))
        .withColumnRenamed("text_sha256", fresh(docs, "text_sha256"))
    )
    sha = fresh(docs, "text_sha256")
    found = docs.withColumn(fresh(docs, "own_sha"), F.sha2(_body(text_col), 256)).join(
        winners,
        F.col(id_col).eqNullSafe(F.col(winner)) & (F.col(fresh(docs, "own_sha")) == F.col(sha)),
    )
    once = found.filter(F.col(times) == 1).select(*docs.columns)
    row = F.struct(*docs.columns)
    again = (
        found.filter(F.col(times) > 1)
        .groupBy(F.col(winner).alias("of"), F.col(sha).alias("sha"))
        .agg(F.min_by(row, F.to_json(row)).alias("row"))
        .select("row.*")
    )
    return once.unionByName(again)


QUERY = "op7_exact_dedup"

SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(body) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') AS body
      FROM documents)
WINDOW same AS (PARTITION BY body)
"""


def query(spark, sf_dir: str) -> DataFrame:
    """op7: every row of ``documents`` with its group's winner."""
    return decide(spark.read.parquet(f"{sf_dir}/documents.parquet"))
