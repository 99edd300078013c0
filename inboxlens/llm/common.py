"""Helpers the training-data operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inboxlens.session import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def work_folder(spark: SparkSession) -> str:
    """A new folder below the one that all executors share.

    The folder comes from ``spark.checkpoint.dir``.  Only a local session without that setting
    gets a folder of its own, removed when Python ends.
    """
    context = spark.sparkContext
    unset = not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir()
    if unset and context.master.startswith("local"):
        own = tempfile.mkdtemp(prefix="inboxlens-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand whole texts to Python in batches of few rows, so that long ones fit in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def settle(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and go on from the files.

    Lineage ends there: a lost executor costs a read, not the work before it, and every later
    reader sees the same rows.
    """
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII text takes the quick built-in way, with the same result."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: every node with the smallest node it reaches.

    Rounds of smallest-neighbour labels with pointer jumping, each written to the shared folder;
    they end when no label changes.  Neighbours are combined map-side, so that a node with very
    many links costs one row a task.  Returns ``(node, component)``; no edges, no rows.
    """
    both = settle(
        edges.select("a", "b")
        .unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a <> b")
        .distinct()
    )
    labels = settle(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.col("node")).alias("component")
        )
    )
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).select(
            F.col("a").alias("node"), "component"
        )
        lower = settle(
            near.unionByName(labels).groupBy("node").agg(F.min("component").alias("component"))
        )
        # a label is a node too: take over the label it has by now
        jump = lower.select(F.col("node").alias("at"), F.col("component").alias("further"))
        jumped = settle(
            lower.join(jump, F.col("component") == F.col("at")).select(
                "node", F.least("component", "further").alias("component")
            )
        )
        changed = (
            jumped.join(labels.withColumnRenamed("component", "old"), "node")
            .filter("component <> old")
            .limit(1)
            .count()
        )
        if not changed:
            return jumped
        labels = jumped
