"""Mixing sources to target weights by Poisson replication.

The rate of a source is its target share of all characters over its present share; every
document is repeated as often as a Poisson variable with that mean says.  The variable is found by
inverting the distribution function at a number drawn from a hash of the document's id, so that
a re-run or a re-tried task repeats every decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inboxlens.llm.common import fresh, settle

#: A Poisson variable with a large mean is a sum of parts with means of at most this size.
PART_MEAN = 8
#: Terms of the distribution function of one part; at mean 8 the rest is below 2**-53.
TERMS = 60
#: Numbers drawn from a hash are multiples of 2**-48.
DRAW_DIGITS = 12


def draw(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the keys only."""
    words = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(k.cast("string"), F.lit("")) for k in keys))
    digits = F.substring(F.md5(words), 1, DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(float(16**DRAW_DIGITS))


def rates(
    docs: DataFrame, weights: DataFrame | None = None, *, source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``(source, rate)``: target share over present share, in characters of text.

    ``weights(source, weight)`` need not sum to one; a source without a weight gets rate 0.
    Without weights every source gets the same share.  Null is a source of its own.  A source
    without any character cannot reach a target: its rows keep rate 1.  When no weight is left
    (all are zero or null), all rates are 0.
    """
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(F.length(F.coalesce(F.col(text_col), F.lit("")))).cast("double").alias("chars")
    )
    if weights is None:
        weighed = sizes.withColumn("weight", F.lit(1.0))
    else:
        given = weights.select(
            F.col("source").alias("given"), F.col("weight").cast("double").alias("weight")
        ).groupBy("given").agg(F.sum("weight").alias("weight"))
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("given")), "left").select(
            "source", "chars", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight")
        )
    active = weighed.filter("chars > 0").agg(
        F.sum("chars").alias("total"), F.sum("weight").alias("parts")
    )
    return weighed.join(F.broadcast(active)).select(  # one row
        "source",
        F.when(F.col("chars") == 0, 1.0)
        .when(F.col("parts") > 0, F.col("weight") / F.col("parts") * F.col("total") / F.col("chars"))
        .otherwise(0.0)
        .alias("rate"),
    )


def _steps(mean: Column) -> Column:
    """The distribution function of a Poisson variable at 0, 1, 2 ... as an array."""
    first = F.struct(
        F.exp(-mean).alias("term"), F.exp(-mean).alias("total"), F.array(F.exp(-mean)).alias("all")
    )

    def add(so_far, k):
        term = so_far["term"] * mean / k
        total = so_far["total"] + term
        return F.struct(
            term.alias("term"), total.alias("total"),
            F.concat(so_far["all"], F.array(total)).alias("all"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), first, add, lambda s: s["all"])


def replicate(
    docs: DataFrame,
    weights: DataFrame | None = None,
    *,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Every document as often as drawn, in a globally shuffled order.

    Adds ``copy`` (from 0), ``copies`` and ``position``, a hash that spreads the rows over tasks
    and orders them inside each; a clashing name gets underscores in front.  Null texts are empty; rows that repeat an
    id get the same count.  An empty table gives an empty result.  The table of rates has a row
    a source and is left to Spark's own size check, as is a split of a hot source.
    """
    copy, copies, position = (fresh(docs, c) for c in ("copy", "copies", "position"))
    rate, at, parts, steps = (fresh(docs, c) for c in ("rate", "at_source", "parts", "steps"))
    # written, so that its size is known before the join is planned and texts stay where they are
    table = settle(
        rates(docs, weights, source_col=source_col, text_col=text_col)
        .select(F.col("source").alias(at), F.col("rate").alias(rate))
        .withColumn(parts, F.ceil(F.col(rate) / PART_MEAN).cast("int"))
        .withColumn(steps, _steps(F.col(rate) / F.greatest(F.col(parts), F.lit(1))))
    )
    ident = F.col(id_col)

    def part(j):
        u = draw(seed, ident, j)
        return F.size(F.filter(F.col(steps), lambda step: step <= u))

    count = F.when(F.col(parts) < 1, F.lit(0)).otherwise(
        F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.col(parts), F.lit(1))),
            F.lit(0),
            lambda total, j: total + part(j),
        )
    )
    drawn = docs.join(table, F.col(source_col).eqNullSafe(F.col(at))).withColumn(copies, count)
    repeated = drawn.filter(F.col(copies) > 0).select(
        *docs.columns, F.col(copies),
        F.explode(F.sequence(F.lit(0), F.col(copies) - 1)).alias(copy),
    )
    placed = repeated.withColumn(
        position,
        F.conv(
            F.substring(F.md5(F.concat_ws(":", F.lit(f"at{seed}"), ident.cast("string"), copy)), 1, 15),
            16, 10,
        ).cast("bigint"),
    )
    return placed.repartition(position).sortWithinPartitions(position)


QUERY = "op2_mixing"

SQL = """
WITH RECURSIVE sizes AS (
  SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS chars FROM documents GROUP BY source
), active AS (SELECT sum(chars) AS total, count(*)::DOUBLE AS parts FROM sizes WHERE chars > 0),
rate AS (
  SELECT source,
         CASE WHEN chars = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE / parts * total / chars END AS rate
  FROM sizes, active
), split AS (SELECT source, ceil(rate / 8)::INT AS m, rate / ceil(rate / 8) AS mean FROM rate),
step(source, m, mean, k, term, total) AS (
  SELECT source, m, mean, 0, exp(-mean), exp(-mean) FROM split
  UNION ALL
  SELECT source, m, mean, k + 1, term * mean / (k + 1), total + term * mean / (k + 1)
  FROM step WHERE k < 60
), table_ AS (SELECT source, m, list(total) AS totals FROM step GROUP BY source, m),
drawn AS (
  SELECT d.*, list_sum(list_transform(range(1, m + 1), lambda j: len(list_filter(totals, lambda t: t <=
           ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || j), 1, 12))::BIGINT::DOUBLE
           / 281474976710656.0))))::INT AS copies
  FROM documents d JOIN table_ ON d.source IS NOT DISTINCT FROM table_.source
)
SELECT doc_id, text, lang, source, n_chars, copies, copy::INT AS copy,
       ('0x' || substr(md5('at7:' || doc_id || ':' || copy), 1, 15))::BIGINT AS position
FROM (SELECT *, unnest(range(copies)) AS copy FROM drawn WHERE copies > 0)
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: ``documents`` with every source at the same share of characters."""
    return replicate(spark.read.parquet(f"{sf_dir}/documents.parquet"), seed=7)
