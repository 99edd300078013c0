"""Resharding by minimum-cost flow.

Every old shard is an ordered run of bytes.  The flow says how many bytes of it go to which new
shard so that all new shards get their capacity and the fewest bytes move; the run is cut there,
and a document goes where its middle lies.  Only sums by block reach the driver: at most
``old shards * blocks`` numbers, whatever the number of documents.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from inboxlens.llm.common import fresh, settle, work_folder

OVERHEAD = 16
BLOCKS = 256
LARGE = 200


@dataclass
class _Arc:
    to: int
    room: int
    cost: int
    back: int


def min_cost_flow(
    supply: list[int], capacity: list[int], cost: list[list[int]]
) -> list[list[int]]:
    """Bytes from every old to every new shard, of least total cost.

    Shortest augmenting paths with node potentials (Dijkstra), costs not negative.  The supplies
    must fit into the capacities.  The work depends on the number of shards only.
    """
    if sum(supply) > sum(capacity):
        raise ValueError("the new shards are smaller than the old ones together")
    n, m = len(supply), len(capacity)
    start, end = n + m, n + m + 1
    arcs: list[list[_Arc]] = [[] for _ in range(n + m + 2)]

    def link(a: int, b: int, room: int, price: int) -> None:
        arcs[a].append(_Arc(b, room, price, len(arcs[b])))
        arcs[b].append(_Arc(a, 0, -price, len(arcs[a]) - 1))

    for i, size in enumerate(supply):
        link(start, i, size, 0)
        for j in range(m):
            link(i, n + j, size, cost[i][j])
    for j, size in enumerate(capacity):
        link(n + j, end, size, 0)
    potential = [0] * len(arcs)
    left = sum(supply)
    while left:
        best: list[int | None] = [None] * len(arcs)
        best[start] = 0
        via: dict[int, tuple[int, _Arc]] = {}
        queue = [(0, start)]
        while queue:
            far, a = heapq.heappop(queue)
            if best[a] is not None and far > best[a]:
                continue
            for arc in arcs[a]:
                if not arc.room:
                    continue
                length = far + arc.cost + potential[a] - potential[arc.to]
                if best[arc.to] is None or length < best[arc.to]:
                    best[arc.to] = length
                    via[arc.to] = (a, arc)
                    heapq.heappush(queue, (length, arc.to))
        potential = [
            p + (b if b is not None else 0) for p, b in zip(potential, best, strict=True)
        ]
        amount, at = left, end
        while at != start:
            a, arc = via[at]
            amount, at = min(amount, arc.room), a
        at = end
        while at != start:
            a, arc = via[at]
            arc.room -= amount
            arcs[at][arc.back].room += amount
            at = a
        left -= amount
    flow = [[0] * m for _ in range(n)]
    for i in range(n):
        for arc in arcs[i]:
            if n <= arc.to < n + m:
                flow[i][arc.to - n] = arcs[arc.to][arc.back].room
    return flow


def equal_capacities(total: int, shards: int) -> list[int]:
    """Sizes that differ by one byte at most and hold the total."""
    return [total // shards + (k < total % shards) for k in range(shards)]


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) and a fixed overhead a row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("bigint")


def crc_of(text: Column) -> Column:
    """CRC-32 of the text's UTF-8 bytes; a null counts as empty."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def reshard(
    docs: DataFrame,
    *,
    old: Column,
    shards: int,
    capacities: list[int] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    blocks: int = BLOCKS,
) -> DataFrame:
    """Every row with old shard, new shard and its place there.

    ``old`` gives the present shard, 0 up; a null counts as 0.  New shard ``k`` is old shard
    ``k`` rewritten: bytes that stay cost nothing, bytes that move cost one.  ``capacities``
    defaults to equal sizes.  Returns id, ``size``, ``text_crc32``, ``old_shard``, ``shard`` and
    ``slot`` (gapless from 0 in every shard).  A null text has no bytes and the CRC of the empty
    text.  A null id is a row like any other; rows that repeat an id keep an order among
    themselves by text, and equal rows are interchangeable.  An empty table gives no rows; other
    columns are not read.

    Shards hold their capacity up to half a document on either side of a cut.  Rows over 1/200 of
    a capacity come first in an old shard, by falling size (a capacity holds fewer than 200), the
    others follow by block of a hash.  No window holds more than a block of an old shard, so
    ``blocks`` is to grow with the data; a hot old shard has as many blocks as any.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    sized = settle(
        docs.select(
            F.col(id_col).alias("id"),
            size_of(text).alias("size"),
            crc_of(text).alias("crc"),
            F.coalesce(old.cast("int"), F.lit(0)).alias("old"),
        )
    )
    total = sized.agg(F.sum("size")).first()[0] or 0
    large = max(1, min(capacities or [total // shards]) // LARGE)
    rows = sized.withColumn(
        "block",
        F.when(F.col("size") > large, F.lit(0))
        .otherwise(F.pmod(F.xxhash64("id", "crc"), F.lit(blocks)) + 1)
        .cast("int"),
    )
    sums = rows.groupBy("old", "block").agg(F.sum("size").alias("bytes")).collect()
    supply = [0] * (max((r["old"] for r in sums), default=-1) + 1)
    for r in sums:
        supply[r["old"]] += r["bytes"]
    room = capacities or equal_capacities(sum(supply), shards)
    price = [[int(i != j) for j in range(len(room))] for i in range(len(supply))]
    flow = min_cost_flow(supply, room, price)

    starts, seen = [], {}
    for r in sorted(sums, key=lambda r: (r["old"], r["block"])):
        starts.append((r["old"], r["block"], seen.get(r["old"], 0)))
        seen[r["old"]] = seen.get(r["old"], 0) + r["bytes"]
    cuts = []
    for i, targets in enumerate(flow):
        at, runs = 0, []
        # what stays comes first, then the moves in order of shard
        for j in sorted(range(len(targets)), key=lambda j: (j != i, j)):
            if targets[j]:
                runs.append((at, j))
                at += targets[j]
        cuts.append((i, runs))
    begin = spark.createDataFrame(starts, "old int, block int, begin bigint")
    ways = spark.createDataFrame(cuts, "old int, runs array<struct<at: bigint, to: int>>")

    # large rows by falling size, so that a cut among them meets a small one; others by id
    in_order = (F.when(F.col("block") == 0, -F.col("size")).otherwise(F.lit(0)), "id", "crc", "size")
    in_block = Window.partitionBy("old", "block").orderBy(*in_order)
    before = F.coalesce(
        F.sum("size").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    placed = settle(
        rows.withColumn("before", before)
        .join(begin, ["old", "block"])
        .join(ways, "old")
        .withColumn("at", F.col("begin") + F.col("before") + F.floor(F.col("size") / 2))
        .select(
            "id", "size", "crc", "old", "block", "before",
            F.element_at(F.filter("runs", lambda r: r["at"] <= F.col("at")), -1)["to"].alias("shard"),
        )
    )
    counts = placed.groupBy("shard", "old", "block").agg(F.count(F.lit(1)).alias("n"))
    over = Window.partitionBy("shard").orderBy("old", "block")
    offsets = counts.select(
        "shard", "old", "block",
        (F.sum("n").over(over) - F.col("n")).alias("offset"),
    )
    inside = Window.partitionBy("shard", "old", "block").orderBy("before", "id", "crc", "size")
    return (
        placed.withColumn("nth", F.row_number().over(inside) - 1)
        .join(offsets, ["shard", "old", "block"])
        .select(
            F.col("id").alias(id_col),
            "size",
            F.col("crc").alias("text_crc32"),
            F.col("old").alias("old_shard"),
            "shard",
            (F.col("offset") + F.col("nth")).cast("bigint").alias("slot"),
        )
    )


def _numbered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The rows with their number from 1 among those of equal keys; nulls are equal.

    Rows get a place when they are written, are numbered inside each task's part of a key, and add
    what the parts before hold, so that a key with a third of all rows is no single task's.
    """
    place, part, before = (fresh(rows, c) for c in ("row_place", "row_part", "rows_before"))
    rows = settle(rows.withColumn(place, F.monotonically_increasing_id())).withColumn(
        part, F.shiftright(F.col(place), 33)
    )
    inside = Window.partitionBy(*keys, part).orderBy(place)
    earlier = Window.partitionBy(*keys).orderBy(part)
    counts = rows.groupBy(*keys, part).agg(F.count(F.lit(1)).alias(before)).select(
        F.struct(*keys, part).alias("of"), (F.sum(before).over(earlier) - F.col(before)).alias(before)
    )
    numbered = rows.withColumn(name, F.row_number().over(inside))
    same = F.struct(*(F.col(c) for c in (*keys, part))).eqNullSafe(F.col("of"))
    return numbered.join(counts, same).withColumn(name, F.col(name) + F.col(before)).drop(
        place, part, before, "of"
    )


def rewrite(docs: DataFrame, placed: DataFrame, path: str, *, id_col: str = "doc_id",
            text_col: str = "text", old: Column | None = None, row_col: str | None = None,
            compression: str | None = None) -> list[int]:
    """Write the files of those shards that lose or gain a row, and return their numbers.

    Files go to ``path/shard=<k>``; shards without a move keep theirs, and the folder of one that
    loses all rows is removed.  Rows meet their places by id and text, nulls being equal, and by a
    number among equal ones, so every row is written once.  Give ``old`` as to ``reshard`` where
    rows of equal id and text differ in other columns.  Columns ``shard`` and ``slot`` of the input
    are replaced.  The input is copied first, as it may lie under ``path``.

    An input of stored files elsewhere needs no copy if ``row_col`` names a column of theirs that numbers the
    rows.  Texts then cross one exchange only, and a shard's rows lie in one file a task, each in order of slot.

    ``compression`` is the codec of the files (default: the session's).
    """
    spark = docs.sparkSession
    moves = placed.filter("old_shard <> shard")
    touched = sorted(
        r[0] for r in moves.select("shard").union(moves.select("old_shard")).distinct().collect()
    )
    text = F.col(text_col).cast("string")
    keys = ["row_id", "row_size", "row_crc", "row_old"]
    copied = docs.withColumns({
        "row_id": F.col(id_col),
        "row_size": size_of(text),
        "row_crc": crc_of(text),
        "row_old": F.lit(0) if old is None else F.coalesce(old.cast("int"), F.lit(0)),
        "row_at": F.col(row_col) if row_col else F.monotonically_increasing_id(),
    }).drop("shard", "slot")
    if row_col is None:
        copied = settle(copied)
    places = placed.select(
        F.col(id_col).alias("row_id"), F.col("size").alias("row_size"),
        F.col("text_crc32").alias("row_crc"),
        (F.lit(0) if old is None else F.col("old_shard")).alias("row_old"), "shard", "slot",
    )
    numbered = _numbered(places, keys, "row_number").filter(F.col("shard").isin(touched)).select(
        F.struct(*keys, "row_number").alias("at"), "shard", "slot"
    )
    same = F.struct(*(F.col(c) for c in (*keys, "row_number"))).eqNullSafe(F.col("at"))
    # texts stay in the copy until every row's place is known
    ways = settle(
        _numbered(copied.select("row_at", *keys), keys, "row_number")
        .join(numbered, same)
        .select("row_at", "shard", "slot")
    )
    rows = copied.drop(*keys).join(ways, "row_at").drop("row_at")
    if row_col is None:
        rows = rows.repartition("shard", F.floor(F.col("slot") / 100_000))
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path, compression=compression)
    # a dynamic overwrite leaves the folders that get no row
    filled = {r["shard"] for r in ways.select("shard").distinct().collect()}
    for k in touched:
        if k not in filled:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/shard={k}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return touched


QUERY = "op9_resharding"
SQL = None
OLD_SHARDS, SHARDS = 32, 40
#: Old and new files of all texts lie side by side for a while, so they are to be small.
COMPRESSION = "zstd"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: ``documents``, laid out by id over the files of 32 shards, to 40 shards of equal bytes.

    The rows are read back from the shards that were rewritten.  A shard without a move keeps its files, and
    its rows their places.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS)).cast("int")
    laid_out = docs.withColumns({"old_shard": shard, "row": F.monotonically_increasing_id(), "shard": shard})
    before, after = work_folder(spark), work_folder(spark)
    laid_out.write.partitionBy("shard").parquet(before, compression=COMPRESSION)
    laid = spark.read.schema(laid_out.schema).parquet(before)
    placed = reshard(laid, old=F.col("shard"), shards=SHARDS)
    touched = rewrite(laid, placed, after, old=F.col("shard"), row_col="row", compression=COMPRESSION)
    text = F.col("text").cast("string")
    fields = [f for f in laid_out.schema.fields if f.name != "shard"]
    fields += [T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())]
    written = spark.read.schema(T.StructType(fields)).parquet(after)
    moved = written.select(
        "doc_id", size_of(text).alias("size"), crc_of(text).alias("text_crc32"), "old_shard", "shard", "slot"
    )
    rows = moved.unionByName(placed.filter(~F.col("shard").isin(touched)))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )
