"""Landed message JSON, one message per line, flattened to the message table.

``parse`` keeps every input line: a row either is a message or carries the reason why it
is not one.  ``flatten`` splits the two.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inboxlens.functions import mime
from inboxlens.functions.clock import instant
from inboxlens.schemas import MESSAGES, MIME_DEPTH, landed_message
from inboxlens.sources import files

#: Bodies are kept whole; a positive number cuts them to as many characters.
MAX_BODY_CHARS = 0
#: MIME levels that one expression walks; deeper messages are walked level by level.
FIRST_DEPTH = 4
#: MIME levels that one step of the walk of a deeper message covers.
WALKED = 8
INBOX = "INBOX"
TOO_DEEP = "mime too deep"
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}

#: Files whose names a batch of the stream hands over at once.
FILES_A_BATCH = 500
_FILES = "path string, modificationTime timestamp, length bigint, content binary"

STAGED = T.StructType(
    [
        *MESSAGES.fields,
        T.StructField("reason", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("digest", T.LongType()),
        T.StructField("row_id", T.LongType()),
        T.StructField("round", T.IntegerType()),
        T.StructField("received_date", T.DateType()),
    ]
)


def read(spark: SparkSession, *paths: str) -> DataFrame:
    """Landed lines as a ``value`` column; a folder is read whole, whatever its files are called."""
    return spark.read.text(list(paths)).select("value")


def arriving(spark: SparkSession, path: str, **options) -> DataFrame:
    """A stream of the files that land in a folder, each once, as a ``path`` column; no content is read.

    Spark's text stream reads a batch's files again for every one of them whose name is a glob pattern, so
    only the names are streamed, where that costs nothing but repeated names; see :func:`lines_of`.
    ``options`` are those of a file stream.
    """
    names = spark.readStream.format("binaryFile").schema(_FILES).options(**options)
    return names.load(path).select("path")


def lines_of(batch: DataFrame) -> DataFrame:
    """The landed lines of a batch of :func:`arriving`, every file read once whatever it is called."""
    paths = sorted(r["path"] for r in batch.distinct().collect())
    return read(batch.sparkSession, *(re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths))


def in_inbox(message: Column) -> Column:
    """The default search predicate, on the parsed message struct."""
    return F.array_contains(message["labelIds"], INBOX)


def parse(
    raw: DataFrame,
    *,
    ingested_at: dt.datetime | Column,
    max_body_chars: int = MAX_BODY_CHARS,
    depth: int = MIME_DEPTH,
    keep: Column | None = None,
    predicate: Callable[[Column], Column] | None = None,
    dated_only: bool = False,
) -> DataFrame:
    """The 13 message columns plus ``reason`` (NULL for a good row) and ``value``.

    A line may hold one object, several with commas between, or an array of them; anything
    else is a bad row as a whole.

    ``predicate`` maps the parsed message struct to a boolean Column, and ``keep`` is one
    over the column ``received_at``; messages that fail either are not decoded.  Lines that
    cannot be parsed or dated are kept whatever ``keep`` says; under ``dated_only`` a
    message without a date is a bad row.  ``value`` holds the landed text of bad rows only.
    """
    lines = raw.select("value").filter(F.btrim("value", F.lit(" \t\r\n")) != "")
    parsed = _dated(_objects(lines, depth))
    malformed = F.col("broken") | F.col("m._malformed").isNotNull()
    wanted = F.lit(True)
    if keep is not None:
        wanted = wanted & (keep | F.col("received_at").isNull())
    if predicate is not None:
        wanted = wanted & F.coalesce(predicate(F.col("m")), F.lit(False))
    texts = F.expr(mime.decoded(mime.text_parts("m.payload", depth)))
    listed = _once(parsed.filter(malformed | wanted), "_texts", texts)
    return _shaped(listed, malformed, ingested_at, max_body_chars, dated_only)


def _message(text: Column | str, depth: int) -> Column:
    return F.from_json(text, landed_message(depth), _PERMISSIVE)


def _dated(parsed: DataFrame) -> DataFrame:
    """The rows with the time of receipt of their message struct ``m``."""
    return parsed.withColumn(
        "received_at", F.timestamp_millis(F.col("m.internalDate").try_cast("bigint"))
    )


def _shaped(
    listed: DataFrame,
    malformed: Column,
    ingested_at: dt.datetime | Column,
    max_body_chars: int,
    dated_only: bool,
) -> DataFrame:
    """Message columns, reason and value of rows ``(m, received_at, _texts, value)``."""
    m, undated = F.col("m"), F.col("received_at").isNull()
    has_date_text = F.length(m["internalDate"]) > 0
    reason = (
        F.when(malformed, F.lit("malformed json"))
        .when(m["id"].isNull(), F.lit("no message id"))
        .when(has_date_text & undated, F.lit("bad internal date"))
        .when(undated & F.lit(dated_only), F.lit("no internal date"))
        .when(mime.too_deep("_texts"), F.lit(TOO_DEEP))
        .when(mime.undecodable("_texts"), F.lit("bad base64"))
    )
    headers = "m.payload.headers"
    columns = {
        "message_id": m["id"],
        "thread_id": m["threadId"],
        "history_id": m["historyId"],
        "subject": mime.header(headers, "subject"),
        "sender": mime.header(headers, "from"),
        "recipient": mime.header(headers, "to"),
        "date": mime.header(headers, "date"),
        "snippet": m["snippet"],
        "plain_body": F.coalesce(
            mime.body("_texts", mime.PLAIN, max_body_chars), F.lit("")
        ),
        "html_body": F.coalesce(
            mime.body("_texts", mime.HTML, max_body_chars), F.lit("")
        ),
        "labels": F.array_join(F.coalesce(m["labelIds"], F.array().cast("array<string>")), ","),
        "received_at": F.col("received_at"),
        "ingested_at": instant(ingested_at),
    }
    judged = listed.withColumn("reason", reason)
    return judged.select(
        *(columns[name].alias(name) for name in MESSAGES.fieldNames()),
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"),
    )


def _objects(lines: DataFrame, depth: int) -> DataFrame:
    """One row an object: ``value``, its message struct ``m`` and whether the line is ``broken``.

    A line is read as the elements of an array, so one walk parses it and shows whether it is one sound
    object.  Only other lines are counted, taken apart and parsed once more.
    """
    listed = T.StructType(
        [
            T.StructField("_landed", T.ArrayType(landed_message(depth))),
            T.StructField("_malformed", T.StringType()),
        ]
    )
    wrapped = F.concat(F.lit('{"_landed":['), "value", F.lit("]}"))
    # counting takes no NaN for a number either
    strict = {**_PERMISSIVE, "allowNonNumericNumbers": "false"}
    read = _once(lines, "_line", F.from_json(wrapped, listed, strict))
    only = F.try_element_at("_line._landed", F.lit(1))
    sound = (
        (F.size("_line._landed") == 1)
        & ~F.contains("value", F.lit("_landed"))
        & F.col("_line._malformed").isNull()
        & only.isNotNull()
        & only["_malformed"].isNull()
    )
    is_array = F.btrim("value", F.lit(" \t\r\n")).startswith("[")
    array = F.when(is_array, F.col("value")).otherwise(F.concat(F.lit("["), "value", F.lit("]")))
    size = F.coalesce(F.json_array_length(array), F.lit(0))
    several = F.transform(
        F.from_json(array, "array<string>"), lambda v: F.coalesce(v, F.lit("null"))
    )
    apart = F.when((size > 1) | (is_array & (size == 1)), several).otherwise(F.array("value"))
    parsed = F.transform(
        F.coalesce(apart, F.array("value")),
        lambda v: F.struct(v.alias("value"), _message(v, depth).alias("m"), (size == 0).alias("broken")),
    )
    whole = F.array(F.struct("value", only.alias("m"), F.lit(False).alias("broken")))
    return read.select(F.explode(F.when(sound, whole).otherwise(parsed)).alias("_object")).select(
        "_object.*"
    )


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters cannot pull apart.

    A filter on a projected column is pushed below the projection, which would parse the
    JSON once for the filter and once for the columns.  Filters stop at a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def flatten(
    raw: DataFrame,
    *,
    ingested_at: dt.datetime | Column,
    max_body_chars: int = MAX_BODY_CHARS,
    depth: int = MIME_DEPTH,
) -> tuple[DataFrame, DataFrame]:
    """Split landed lines into ``(messages, quarantined)``; no line is lost.

    Lazy, and so bound to one ``depth``: messages nested deeper are quarantined with their text.
    :func:`stage` flattens any depth.
    """
    rows = parse(raw, ingested_at=ingested_at, max_body_chars=max_body_chars, depth=depth)
    return messages_of(rows), quarantine_of(rows)


def stage(
    raw: DataFrame,
    folder: str,
    *,
    ingested_at: dt.datetime,
    max_body_chars: int = MAX_BODY_CHARS,
    depth: int = FIRST_DEPTH,
    dated_only: bool = False,
    **options,
) -> DataFrame:
    """Parse landed lines once and write the rows to ``folder``, by day of receipt.

    Few messages are nested deeply, so one expression walks the first levels of all; those it does not
    reach the bottom of are taken up again and walked level by level, however deep.  The rows
    carry an id and a digest, so that copies are decided on without their bodies.  ``options`` are
    those of :func:`parse`.
    """
    spark = raw.sparkSession
    shape = {"ingested_at": ingested_at, "max_body_chars": max_body_chars, "dated_only": dated_only}
    _write_rows(parse(raw, depth=depth, **shape, **options), folder, 0)
    written = spark.read.schema(STAGED).parquet(folder)
    deep = written.filter((F.col("reason") == TOO_DEEP) & (F.col("round") == 0))
    if not deep.isEmpty():
        rows = _walked(deep.select("value", "row_id"), f"{folder}_walk", shape)
        _write_rows(rows, folder, 1)
        files.drop(spark, f"{folder}_walk")
    return staged_rows(spark, folder)


def staged_rows(spark: SparkSession, folder: str, schema: T.StructType = STAGED) -> DataFrame:
    """What :func:`stage` wrote; rows taken up again count once."""
    written = spark.read.schema(schema).option("basePath", folder).parquet(folder)
    return written.filter(F.coalesce("reason", F.lit("")) != TOO_DEEP)


def _write_rows(rows: DataFrame, folder: str, number: int) -> None:
    identified = rows.withColumns(
        {
            "digest": F.xxhash64(*(c for c in MESSAGES.fieldNames() if c != "ingested_at")),
            "received_date": F.to_date("received_at"),
        }
    ).hint("rebalance", "received_date")
    (
        identified.withColumn("row_id", F.monotonically_increasing_id() * 2 + number)
        .sortWithinPartitions("received_date", "sender", "thread_id")
        .write.partitionBy("received_date")
        .parquet(f"{folder}/round={number}")
    )


def _walked(deep: DataFrame, folder: str, shape: dict) -> DataFrame:
    """Messages of any depth: their MIME parts some levels at a time, one written table a step.

    A part is a VARIANT row with its place in the tree, the positions from the root down; sorted by
    it, the text parts come in the order of the walk.  A step walks ``WALKED`` levels and writes their
    texts and the parts below; the walk ends where there is none.
    """
    spark = deep.sparkSession
    node = "row_id bigint, place array<int>, mime string, data string, part variant"
    step = f"inline({mime.nodes('part', 'place', WALKED)})"
    # few files hold the deep messages, so they are dealt out to all tasks first
    level = deep.repartition("row_id").select(
        "row_id", F.expr("CAST(array() AS array<int>)").alias("place"),
        F.expr("try_variant_get(try_parse_json(value), '$.payload', 'variant')").alias("part"),
    )
    number = 0
    while number == 0 or not level.isEmpty():
        level.selectExpr("row_id", step).write.parquet(f"{folder}/{number}")
        # parts that a step does not walk have no type yet
        level = spark.read.schema(node).parquet(f"{folder}/{number}").filter("mime IS NULL")
        number += 1
    walked = spark.read.schema(node).parquet(*(f"{folder}/{n}" for n in range(number)))
    texts = walked.filter("mime IS NOT NULL")
    in_order = texts.groupBy("row_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "mime", "data"))).alias("parts")
    )
    found = deep.join(in_order, "row_id", "left")
    parsed = _dated(_once(found, "m", _message("value", 0)))
    listed = _once(parsed, "_texts", F.expr(f"coalesce({mime.decoded('parts')}, array())"))
    return _shaped(listed, F.lit(False), **shape)


def messages_of(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reason").isNull()).select(*MESSAGES.fieldNames())


def quarantine_of(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reason").isNotNull()).select(
        F.sha2("value", 256).alias("payload_sha"),
        "reason",
        "value",
        F.col("ingested_at").alias("quarantined_at"),
    )
