"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Class ``k`` holds pieces of ``capacity // k`` tokens; a bin of the class takes ``k`` pieces.  A
document is cut into whole sequences and a rest, and the rest is cut greedily at the largest
reciprocal lengths, so that every piece fills its share of a bin and a bin wastes fewer than
``k`` tokens.  Every task fills the bins of every class by itself.  What stays in unfinished bins
(fewer than ``k`` pieces a class and task) is filled by class over groups of tasks, then over all,
and the last rest, less than one bin a class, is laid end to end.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from inboxlens.llm.common import settle, short_batches

CAPACITY = 1024
#: Words whose ids a Python worker remembers, over all its tasks; forgetting only costs time.
REMEMBERED = 800_000
#: Signs that often end a word.  Between a letter and a sign the pre-tokenizer always cuts.
SIGNS = ".,;:!?|&%$*#"
END = b"\0\0\0\0"
_GROUP_TASKS = 64


def _letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the others follow 255."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + k) for k, b in enumerate(others)}


LETTERS = _letters()


class WordIds(dict):
    """Token ids of a text, word by word.

    The byte-level pre-tokenizer never joins a blank to what stands before it, and a single blank
    between two words opens the second one's token.  So a text without two white-space
    characters in a row falls apart at its blanks, and every part can be looked up.  Other texts
    go to the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model

    def one(self, word: str) -> bytes:
        """Ids of a run of letters, with its blank: the pre-tokenizer leaves it whole."""
        ids = [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(LETTERS))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        # the key carries its blank; "" after the blank, or white space at an end, is no word
        bare = word[1:] if word[0] == " " else word
        if not bare or bare[0].isspace() or bare[-1].isspace():
            raise ValueError("white space in a row")
        if len(self) >= REMEMBERED:
            self.clear()
        stem = word.rstrip(SIGNS)
        if len(stem) < len(word) and stem and stem[-1].isalpha():
            ids = self[stem] + self[word[len(stem) :]]
        elif bare.isalpha():
            ids = self.one(word)
        else:
            ids = self.whole(word)
        self[word] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        first, *rest = text.split(" ")
        try:
            if not first:
                raise ValueError("blank in front")
            return self[first] + b"".join([self[" " + word] for word in rest])
        except ValueError:
            return self.whole(text)


@cache
def word_ids(path: str) -> WordIds:
    """One table a Python worker, so that the next task starts with what is known."""
    return WordIds(path)


def cuts(tokens: int, capacity: int = CAPACITY) -> Iterator[int]:
    """Lengths of a document's pieces, each a reciprocal of the capacity rounded down."""
    while tokens:
        # the smallest k whose share, capacity // k, is not over what is left
        length = capacity // (capacity // (tokens + 1) + 1)
        yield length
        tokens -= length


def holds(length: int, capacity: int = CAPACITY) -> int:
    """Pieces in a bin of the class that the length belongs to."""
    return capacity // length


PIECES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("task", T.LongType()),
        T.StructField("bin", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def _fill(tokenizer: str, capacity: int, keep_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        task = TaskContext.get().partitionId()
        open_bins: dict[int, list[tuple]] = {}
        bins = 0
        out: list[tuple] = []

        def table() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[] for _ in PIECES]
            kinds = [pa.int64()] * 8 + [pa.binary()]
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names=PIECES.names)

        held = 0
        for batch in batches:
            for ident, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = words(text or "") + END
                total, start = len(ids) // 4, 0
                for length in cuts(total, capacity):
                    part = ids[4 * start : 4 * (start + length)]
                    piece = (
                        ident, start, length, zlib.crc32(part), total, part if keep_ids else None,
                    )
                    start += length
                    waiting = open_bins.setdefault(length, [])
                    waiting.append(piece)
                    held += len(part) if keep_ids else 0
                    if len(waiting) == holds(length, capacity):
                        out.extend(
                            (*p[:5], task, bins, nth * length, p[5])
                            for nth, p in enumerate(waiting)
                        )
                        waiting.clear()
                        bins += 1
                if len(out) >= 20_000 or held > 16_000_000:
                    held = 0
                    yield table()
        out.extend(
            (*p[:5], task, None, None, p[5]) for waiting in open_bins.values() for p in waiting
        )
        yield table()

    return run


def _refill(left: DataFrame, capacity: int, *by: str) -> DataFrame:
    """Bins of one class from the pieces of a group; ``whole`` says which ones are complete."""
    size = F.floor(F.lit(capacity) / F.col("length"))
    order = Window.partitionBy("length", *by).orderBy("task", "id", "start", "ids_crc32")
    group = Window.partitionBy("length", *by)
    return (
        left.withColumn("nth", F.row_number().over(order) - 1)
        .withColumn("pieces", F.count(F.lit(1)).over(group))
        .withColumn("bin", F.floor(F.col("nth") / size))
        .withColumn("offset", F.pmod(F.col("nth"), size) * F.col("length"))
        .withColumn("whole", (F.col("bin") + 1) * size <= F.col("pieces"))
        .drop("nth", "pieces")
    )


def pack(
    docs: DataFrame,
    *,
    tokenizer: str,
    capacity: int = CAPACITY,
    keep_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    A document is its token ids and id 0.  Null and empty texts are the single id 0; a long text
    is cut into whole sequences and a rest.  Rows that repeat an id are documents of their own;
    a null id stays null.  An empty table gives no pieces; other columns are not read.  Returns
    id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and, with
    ``keep_ids``, ``ids`` (little-endian unsigned 32-bit).  Every sequence is gapless from 0.

    The bulk never leaves its task: only unfinished bins are shuffled.  The last rest is under
    one bin a class, so fewer than ``capacity`` times the number of classes tokens meet in one
    task, whatever the input.
    """
    short_batches(docs.sparkSession)
    found = settle(
        docs.select(
            F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")
        )
        .mapInArrow(_fill(tokenizer, capacity, keep_ids), PIECES)
        .withColumn("group", F.floor(F.col("task") / _GROUP_TASKS))
    )
    # sequence numbers: two bits say which level filled the bin, the rest is unique there
    done = found.filter(F.col("bin").isNotNull()).withColumn(
        "sequence", _number(0, ("task", 32), ("bin", 0))
    )
    grouped = settle(_refill(found.filter(F.col("bin").isNull()), capacity, "group"))
    by_group = grouped.filter("whole").withColumn(
        "sequence", _number(1, ("group", 30), ("length", 10), ("bin", 0))
    )
    overall = settle(_refill(grouped.filter("not whole").drop("whole"), capacity))
    by_class = overall.filter("whole").withColumn(
        "sequence", _number(2, ("bin", 20), ("length", 0))
    )
    last = _lay_out(overall.filter("not whole"), capacity).withColumn(
        "sequence", _number(3, ("bin", 0))
    )
    columns = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence", "offset", "ids"]
    every = done.select(columns)
    for more in (by_group, by_class, last):
        every = every.unionByName(more.select(columns))
    return every.select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        F.col("sequence").alias("sequence_id"), F.col("offset").cast("bigint").alias("offset"),
        *(["ids"] if keep_ids else []),
    )


def _number(level: int, *fields: tuple[str, int]) -> Column:
    total = F.lit(level).cast("bigint") * (1 << 61)
    for name, bits in fields:
        total = total + F.col(name).cast("bigint") * (1 << bits)
    return total


def _lay_out(rest: DataFrame, capacity: int) -> DataFrame:
    """The last pieces, largest first, first fit: smaller ones close the gaps of larger ones."""

    def run(frames):
        parts = [f for f in frames if len(f)]
        if not parts:
            return
        frame = pd.concat(parts).sort_values(
            ["length", "task", "id", "start"], ascending=[False, True, True, True]
        )
        bins, offsets, used = [], [], []
        for length in frame["length"]:
            at = next((k for k, n in enumerate(used) if n + length <= capacity), len(used))
            if at == len(used):
                used.append(0)
            bins.append(at)
            offsets.append(used[at])
            used[at] += length
        yield frame.assign(bin=bins, offset=offsets)[names]

    schema = (
        "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "bin bigint, offset bigint, ids binary"
    )
    names = [f.split()[0] for f in schema.split(", ")]
    narrow = rest.select("id", "start", "length", "ids_crc32", "doc_tokens", "task", "ids")
    # an exchange, so that the windows before it keep their own tasks
    return narrow.repartition(1).mapInPandas(run, schema)


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(sequence_id, length, ids)``: the pieces of every sequence in order, as one binary.

    ``padded_length`` is the capacity, or the length itself where that is a power of two.
    """
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), ordered.alias("parts")
    )
    power = F.bit_count("length") == 1
    joined = F.aggregate(
        "parts", F.lit("").cast("binary"), lambda all_, p: F.concat(all_, p["ids"])
    )
    return whole.select(
        "sequence_id", "length", joined.alias("ids"),
        F.when(power, F.col("length")).otherwise(F.lit(capacity)).alias("padded_length"),
    )


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERY = "op8_packing"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: all ``documents`` in sequences of at most 1,024 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, tokenizer=tokenizer_path(), keep_ids=False)
