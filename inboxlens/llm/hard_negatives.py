"""Hard negatives by best-first search in STR-packed R-trees.

Vectors are rounded to integers, so scores are exact integer inner products.  The vectors are sorted
and tiled into slices of bounded size over all rows (dimension, label, then coordinates), and every
slice is packed into an R-tree by the same sort-tile-recursive rule inside a task.  The minimum
bounding box of a node gives, coordinate by coordinate, an interval for the inner product of an anchor
with anything in it.  An anchor keeps its boxes in a queue, best upper bound first; a box is
passed over when its interval misses every score window that is asked for, or lies strictly below
the k-th score found in all windows it meets.

The boxes of whole slices are the upper level: each anchor visits its eight most promising slices first
and takes the k-th scores found there along to the next, eightfold round, so that later slices
hand on only what can still enter a result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inboxlens.llm.common import settle

#: Rows of a slice: a sixteenth of all, but within these bounds.
LEAST_SLICE, MOST_SLICE = 4_096, 65_536
#: Slices whose boxes are sent to every task; beyond them slices get longer.
MOST_SLICES = 16_384
#: Anchors that meet a slice in one task.
ANCHORS = 65_536
#: Rows of a leaf, children of a node.
LEAF, FANOUT = 128, 16
#: Slices of the first round, and the factor from round to round.
FIRST = 8
_LARGEST = 2**63 - 1


class Tree:
    """An R-tree over the rows of a slice; nodes are numbered from the leaves up, the root last."""

    def __init__(self, points: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> None:
        order = _tiled(points, labels)
        self.points, self.labels, self.ids = points[order], labels[order], ids[order]
        starts = np.arange(0, len(order), LEAF)
        self.spans = [(int(s), int(min(s + LEAF, len(order)))) for s in starts]
        self.leaves = len(self.spans)
        low = [np.minimum.reduceat(self.points, starts)]
        high = [np.maximum.reduceat(self.points, starts)]
        first = [np.minimum.reduceat(self.labels, starts)]
        last = [np.maximum.reduceat(self.labels, starts)]
        base = 0
        while len(low[-1]) > 1:
            starts = np.arange(0, len(low[-1]), FANOUT)
            self.spans += [
                (base + int(s), base + int(min(s + FANOUT, len(low[-1])))) for s in starts
            ]
            base += len(low[-1])
            low.append(np.minimum.reduceat(low[-1], starts))
            high.append(np.maximum.reduceat(high[-1], starts))
            first.append(np.minimum.reduceat(first[-1], starts))
            last.append(np.maximum.reduceat(last[-1], starts))
        self.low, self.high = np.concatenate(low), np.concatenate(high)
        self.first, self.last = np.concatenate(first), np.concatenate(last)


def _tiled(points: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Row numbers in sort-tile-recursive order: by label, then by the two widest coordinates."""
    spread = points.max(axis=0) - points.min(axis=0) if points.size else np.empty(0)
    widest = sorted(range(points.shape[1]), key=lambda c: (-spread[c], c))[:2]
    keys = [points[:, c] for c in widest if spread[c]]
    if len(labels) and labels.min() != labels.max():
        keys.insert(0, labels)
    pieces = [np.arange(len(labels))]
    for k, key in enumerate(keys):
        tiled = []
        for rows in pieces:
            leaves = -(-len(rows) // LEAF)
            # as many slabs as give the remaining keys an equal part of the cutting
            slabs = max(1, round(leaves ** (1 / (len(keys) - k))))
            step = LEAF * -(-leaves // slabs)
            rows = rows[np.argsort(key[rows], kind="stable")]
            tiled += [rows[s : s + step] for s in range(0, len(rows), step)]
        pieces = tiled
    return np.concatenate(pieces)


def intervals(
    vectors: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of every vector with anything in every box."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as doubles where every inner product is exact in them, else as Python integers."""
    size = 1
    for a in arrays:
        size *= max((max(abs(int(a.min())), abs(int(a.max()))) for a in (a,) if a.size), default=0)
    wide = max((a.shape[1] for a in arrays if a.ndim == 2), default=0)
    kind = np.float64 if 4 * size * max(1, wide) < 2**53 else object
    return [a.astype(kind) for a in arrays]


class Windows:
    """What one anchor looks for: score windows with the best ``k`` rows of each so far."""

    def __init__(self, low: list, high: list, floors: list, k: int) -> None:
        self.low, self.high, self.k = low, high, k
        # nothing strictly below the floor can enter: the window's end or the k-th score known
        self.floor = [max(a, f) for a, f in zip(low, floors, strict=True)]
        self.found = [(np.empty(0, np.float64), np.empty(0, np.int64)) for _ in low]

    def wants(self, least, most) -> bool:
        return any(
            most >= f and least <= h for f, h in zip(self.floor, self.high, strict=True)
        )

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for w, (floor, high) in enumerate(zip(self.floor, self.high, strict=True)):
            inside = (scores >= floor) & (scores <= high)
            if not inside.any():
                continue
            all_scores = np.concatenate([self.found[w][0], scores[inside]])
            all_ids = np.concatenate([self.found[w][1], ids[inside]])
            best = np.lexsort((all_ids, -all_scores))[: self.k]
            self.found[w] = all_scores[best], all_ids[best]
            if len(best) == self.k:
                self.floor[w] = max(floor, all_scores[best[-1]])


def search(tree: Tree, vector, label, ident, same: bool, windows: Windows, least, most) -> None:
    """Best-first search of one tree; ``least`` and ``most`` bound the scores in its nodes."""

    def eligible(node: int) -> bool:
        if same:
            return tree.first[node] <= label <= tree.last[node]
        return not tree.first[node] == label == tree.last[node]

    root = len(tree.spans) - 1
    queue = [(-most[root], root)]
    while queue:
        _, node = heapq.heappop(queue)
        # bounds are looked at again: scores found since then may have ruled the box out
        if not eligible(node) or not windows.wants(least[node], most[node]):
            continue
        a, b = tree.spans[node]
        if node >= tree.leaves:
            for child in range(a, b):
                heapq.heappush(queue, (-most[child], child))
            continue
        alike = tree.labels[a:b] == label
        allowed = (alike if same else ~alike) & (tree.ids[a:b] != ident)
        if allowed.any():
            scores = tree.points[a:b][allowed] @ vector
            windows.add(scores, tree.ids[a:b][allowed])


def _bounds(positive: int | None, low: int, high: int) -> tuple:
    """Whole scores within ``low`` to ``high`` percent of a score; everything without one."""
    if positive is None or pd.isna(positive):
        return -np.inf, np.inf
    positive = int(positive)
    return -((-low * positive) // 100), (high * positive) // 100


def _windows(row, low: int, high: int, k: int) -> Windows:
    targets = list(row.targets) if row.targets is not None and len(row.targets) else [None]
    edges = [_bounds(t, low, high) for t in targets]
    known = list(row.floors) if row.floors is not None and len(row.floors) else [None] * len(targets)
    floors = [-np.inf if f is None or pd.isna(f) else int(f) for f in known]
    return Windows([e[0] for e in edges], [e[1] for e in edges], floors, k)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.int64).reshape(len(column), -1)


_FOUND = "query bigint, target int, score bigint, other bigint"


def _visit(same: bool, low: int, high: int, k: int):
    """One slice and the anchors that visit it: rows that may still enter their results."""

    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(rows) and len(anchors):
            size = anchors["q"].iloc[0].shape[0]
            points, vectors = _exact(_matrix(rows["q"]), _matrix(anchors["q"]))
            if points.shape[1] == size:
                # a row that is repeated as a whole counts once
                order = rows.assign(h=[v.tobytes() for v in rows["q"]]).drop_duplicates(["id", "label", "h"])
                points = points[order.index.to_numpy()]
                tree = Tree(points, order["label"].to_numpy(), order["id"].to_numpy())
                for begin in range(0, len(anchors), 512):
                    some = vectors[begin : begin + 512]
                    least, most = intervals(some, tree.low, tree.high)
                    for k_row, row in enumerate(anchors.iloc[begin : begin + 512].itertuples()):
                        wanted = _windows(row, low, high, k)
                        search(tree, some[k_row], row.label, row.id, same, wanted, least[k_row], most[k_row])
                        for w, (scores, ids) in enumerate(wanted.found):
                            out += [
                                (row.query, w, max(-_LARGEST, min(_LARGEST, int(s))), int(i))
                                for s, i in zip(scores, ids, strict=True)
                            ]
        return pd.DataFrame(out, columns=["query", "target", "score", "other"])

    return lambda _, rows, anchors: run(rows.reset_index(drop=True), anchors.reset_index(drop=True))


def _choose(boxes: list[tuple], same: bool, low: int, high: int, k: int, begin: int, end: int):
    """The slices an anchor visits in a round: ranks ``begin`` to ``end`` by their upper bound."""

    by_size: dict[int, list[tuple]] = {}
    for box in boxes:
        by_size.setdefault(len(box[3]), []).append(box)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            picks: list[tuple[int, int]] = []
            sizes = frame["q"].map(len)
            for size, held in by_size.items():
                rows = frame[sizes == size]
                for at in range(0, len(rows), 256):
                    some = rows.iloc[at : at + 256]
                    vectors, lows, highs = _exact(
                        _matrix(some["q"]),
                        np.array([b[3] for b in held], np.int64).reshape(len(held), size),
                        np.array([b[4] for b in held], np.int64).reshape(len(held), size),
                    )
                    least, most = intervals(vectors, lows, highs)
                    first, last = (np.array([b[c] for b in held]) for c in (1, 2))
                    for n, row in enumerate(some.itertuples()):
                        alike = (first <= row.label) & (row.label <= last)
                        only = (first == row.label) & (row.label == last)
                        usable = np.flatnonzero(alike if same else ~only)
                        order = usable[np.argsort(-most[n][usable], kind="stable")][begin:end]
                        wanted = _windows(row, low, high, k)
                        picks += [
                            (row.Index, held[b][0]) for b in order if wanted.wants(least[n][b], most[n][b])
                        ]
            if picks:
                visits = frame.loc[[i for i, _ in picks]].reset_index(drop=True)
                visits.insert(0, "slice", [s for _, s in picks])
                yield visits

    return run


def _box(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bounding boxes of the slices' rows in a batch."""
    for frame in frames:
        for (piece, _), rows in frame.groupby(["slice", frame["q"].map(len)]):
            points = _matrix(rows["q"])
            yield pd.DataFrame(
                {
                    "slice": [piece], "first": [rows["label"].min()], "last": [rows["label"].max()],
                    "low": [points.min(axis=0)], "high": [points.max(axis=0)],
                }
            )


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of every query and target, best score first, with their ``rank``."""
    order = Window.partitionBy("query", "target").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_all(
    rows: DataFrame, boxes: list[tuple], queries: DataFrame, parts: int, *, same: bool, low: int,
    high: int, k: int,
) -> DataFrame:
    """The best ``k`` rows of every query's windows: ``(query, target, score, other, rank)``.

    ``queries(query, id, label, q, targets)``; a target is a positive score, whose window is
    ``low`` to ``high`` percent of it, and without targets there is one window that holds all.
    """
    spark = rows.sparkSession
    found = spark.createDataFrame([], f"{_FOUND}, rank int")
    sliced = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    begin, end = 0, FIRST
    while begin < len(boxes):
        floors = (
            found.filter(F.col("rank") == k)
            .groupBy("query")
            .agg(F.map_from_entries(F.collect_list(F.struct("target", "score"))).alias("kth"))
        )
        size = F.greatest(F.coalesce(F.size("targets"), F.lit(0)), F.lit(1))
        asked = queries.join(floors, "query", "left").select(
            "query", "id", "label", "q", "targets",
            F.transform(F.sequence(F.lit(0), size - 1), lambda w: F.element_at("kth", w)).alias("floors"),
        )
        schema = (
            "slice int, query bigint, id bigint, label bigint, q array<bigint>, "
            "targets array<bigint>, floors array<bigint>"
        )
        chosen = asked.mapInPandas(_choose(boxes, same, low, high, k, begin, end), schema)
        visits = chosen.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int"))
        more = (
            sliced.groupBy("slice", "part")
            .cogroup(visits.groupBy("slice", "part"))
            .applyInPandas(_visit(same, low, high, k), _FOUND)
        )
        found = settle(_best(found.drop("rank").unionByName(more), k))
        begin, end = end, end * FIRST
    return found


def mine(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    is_anchor: Column | None = None,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Hard negatives: ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components become ``floor(scale * x)``, with ``x`` as double; a score is the inner product of
    two rows, exact, higher is better and ties go to the smaller id.  An anchor's positives are
    its best ``positives`` other rows of its label; a positive's negatives the best ``negatives``
    rows of other labels with a score from ``low`` to ``high`` percent of the positive's.
    ``label`` and ``is_anchor`` are columns over the input (default: the column ``label``, every
    row).

    Rows with a null id, label, vector or component or a non-finite component take no part.  Rows of
    the anchor's id are the anchor itself, never a candidate; a row repeated as a whole counts
    once, rows that share an id only count each.  Vectors of different lengths never meet;
    empty ones all score 0.  Components and scores beyond 64 bits count as the largest integer.  An
    anchor without positives, or a window without negatives, gives no row, and an empty table an
    empty result.  Other columns are not read.
    """
    spark = vectors.sparkSession
    made = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        (F.col("label") if label is None else label).cast("bigint").alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
        (F.lit(True) if is_anchor is None else is_anchor).alias("anchor"),
    )
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # the division by 1 keeps huge products finite for floor, which takes them to the largest bigint
    whole = F.transform("v", lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(-9.2e18)), F.lit(9.2e18))))
    rows = made.filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite
    ).select("id", "label", F.coalesce("anchor", F.lit(False)).alias("anchor"), whole.alias("q"))
    total = rows.count()
    empty = (
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
        "positive_score bigint, negative_score bigint"
    )
    if not total:
        return spark.createDataFrame([], empty)
    per_slice = max(min(max(total // 16, LEAST_SLICE), MOST_SLICE), -(-total // MOST_SLICES))
    slices = -(-total // per_slice)
    # coarse steps of the first coordinate, then the second: tiles, not thin slabs, of a label
    edge = rows.agg(F.stddev(F.get("q", F.lit(0))).alias("s")).first()["s"] or 0.0
    step = max(1.0, edge * 4 / max(1.0, slices**0.5))
    tiled = settle(
        rows.repartitionByRange(
            slices,
            F.size("q"), "label", F.floor(F.get("q", F.lit(0)) / step), F.get("q", F.lit(1)),
            F.xxhash64("id"),
        ).withColumn("slice", F.spark_partition_id())
    )
    placed = tiled.select("slice", "id", "label", "q")
    box_schema = "slice int, first bigint, last bigint, low array<bigint>, high array<bigint>"
    boxes: dict[tuple[int, int], tuple] = {}
    for b in placed.mapInPandas(_box, box_schema).toLocalIterator():
        key = (b["slice"], len(b["low"]))
        old = boxes.get(key)
        new = (b["first"], b["last"], np.array(b["low"], np.int64), np.array(b["high"], np.int64))
        if old:
            new = (
                min(old[0], new[0]), max(old[1], new[1]),
                np.minimum(old[2], new[2]), np.maximum(old[3], new[3]),
            )
        boxes[key] = new
    upper = [(s, *boxes[s, size]) for s, size in sorted(boxes)]
    anchors = settle(
        tiled.filter("anchor")
        .select("id", "label", "q")
        .distinct()
        .withColumn("query", F.monotonically_increasing_id())
    )
    parts = max(1, -(-anchors.count() // ANCHORS))
    # a slice that holds two lengths of vectors is two slices
    split = F.size("q")
    placed = placed.withColumn("slice", _numbered(F.col("slice"), split, upper))
    numbered = [(n, *box[1:]) for n, box in enumerate(upper)]
    options = {"low": low, "high": high}
    asked = anchors.withColumn("targets", F.lit(None).cast("array<bigint>"))
    near = _search_all(placed, numbered, asked, parts, same=True, k=positives, **options)
    targets = near.groupBy("query").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"]
        ).alias("targets")
    )
    far = _search_all(
        placed, numbered, settle(anchors.join(targets, "query")), parts,
        same=False, k=negatives, **options,
    )
    chosen = near.select(
        "query", (F.col("rank") - 1).alias("target"),
        F.col("other").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    return (
        far.join(chosen, ["query", "target"])
        .join(anchors.select("query", F.col("id").alias("anchor_id")), "query")
        .select(
            "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
    )


def _numbered(piece: Column, size: Column, upper: list[tuple]) -> Column:
    """Number of a slice among the boxes; almost always there is one length of vectors only."""
    lengths = {len(b[3]) for b in upper}
    keys = F.create_map(
        *(F.lit(x) for n, b in enumerate(upper) for x in (f"{b[0]}/{len(b[3])}", n))
    )
    if len(lengths) == 1 and [b[0] for b in upper] == list(range(len(upper))):
        return piece
    return F.element_at(keys, F.concat_ws("/", piece, size))


QUERY = "op11_hard_negatives"
SQL = """
WITH held AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), rows_ AS (
  SELECT DISTINCT id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM held
), scored AS (
  SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda k: a.q[k] * b.q[k])) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ b ON a.id <> b.id AND len(a.q) = len(b.q) WHERE a.id % 100 = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) <= 10
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: every hundredth vector of ``embeddings`` against all of them."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, label=moved, is_anchor=F.col("vec_id") % 100 == 0)
