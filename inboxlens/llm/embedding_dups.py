"""Near-duplicate vectors by dual traversal of cover trees.

For unit vectors the cosine is a distance: ``d**2 = 2 - 2 cos``, so pairs of cosine ``c`` are
pairs within ``sqrt(2 - 2c)``.  A cover tree is a set of nested levels, the radius halved from one
to the next.  Its upper levels, nodes with parents, are built on a bounded sample of centres; every
vector goes to the cell of its nearest centre, and the covering radius of a cell is measured
over all its vectors, that of an upper node over all cells below it.  The upper levels are
traversed in pairs of nodes, level by level: pairs that are further apart than their covering radii
and the threshold together are pruned.  Each pair of cells left is one task, where the lower
levels of both cells are built and traversed in the same way.  Leaf pairs are compared by a matrix
product in double precision, so the pairs found are exact.

Cells with many vectors are cut into blocks.  Pairs are never written: a task hands on counts of
links and one edge a vector.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inboxlens.llm.common import components, settle

COSINE = 0.9
#: Centres of the upper levels are drawn from this many vectors, whatever their number.
SAMPLE = 2048
#: Vectors to a block, and the number of cells aimed at follows from it.
BLOCK = 4096
#: Vectors below which a node is a leaf.
LEAF = 256
#: Rounding of double-precision distances, far above what 64 to 10,000 components add up to.
SLACK = 1e-7


@dataclass
class Node:
    """Vectors ``rows`` around a centre; ``radius`` covers all of them."""

    centre: np.ndarray
    radius: float
    rows: np.ndarray
    children: list["Node"] = field(default_factory=list)


def _net(points: np.ndarray, rows: np.ndarray, first: np.ndarray, radius: float, most: int):
    """Centres no nearer to each other than ``radius``, each row with its nearest one.

    The first centre is given, so levels are nested.  None when ``most`` centres don't cover.
    """
    centres = [first]
    best = _distance(points[rows], first)
    owner = np.zeros(len(rows), int)
    while True:
        far = int(np.argmax(best))
        if best[far] <= radius:
            return centres, owner, best
        if len(centres) == most:
            return None
        centre = points[rows[far]]
        d = _distance(points[rows], centre)
        nearer = d < best
        owner[nearer], best[nearer] = len(centres), d[nearer]
        centres.append(centre)


def _distance(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, ((points - centre) ** 2).sum(axis=1)))


def build(points: np.ndarray, rows: np.ndarray, centre: np.ndarray, level: float) -> Node:
    """A cover tree over some rows; children have half the level's radius.

    A node whose halves would hold only a few vectors each is a leaf: distances of
    high-dimensional vectors that form no groups don't shrink with the level.
    """
    reach = _distance(points[rows], centre)
    node = Node(centre, float(reach.max(initial=0.0)), rows)
    if len(rows) <= LEAF:
        return node
    level = min(level, node.radius)
    while level > 1e-3:
        level /= 2
        found = _net(points, rows, centre, level, max(2, len(rows) // (LEAF // 4)))
        if found is None:
            return node
        centres, owner, _ = found
        if len(centres) > 1:
            node.children = [
                build(points, rows[owner == k], c, level)
                for k, c in enumerate(centres)
                if (owner == k).any()
            ]
            return node
    return node


def pairs(left: Node, right: Node, limit: float):
    """Leaf pairs that may hold vectors within ``limit``; of one tree with itself, each pair once."""
    stack = [(left, right)]
    while stack:
        a, b = stack.pop()
        if a is not b:
            apart = float(np.sqrt(((a.centre - b.centre) ** 2).sum()))
            if apart > a.radius + b.radius + limit + SLACK:
                continue
        if not a.children and not b.children:
            yield a, b
        elif a is b:
            for k, x in enumerate(a.children):
                stack.extend((x, y) for y in a.children[k:])
        elif b.children and (not a.children or b.radius >= a.radius):
            stack.extend((a, y) for y in b.children)
        else:
            stack.extend((x, b) for x in a.children)


def _links(frame: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of one task: between its two blocks, or inside its only one."""
    frame = frame.sort_values("rep", ignore_index=True)
    points = np.array(frame["unit"].tolist(), np.float64)
    points /= np.sqrt((points**2).sum(axis=1, keepdims=True))
    copies, reps = frame["copies"].to_numpy(), frame["rep"].to_numpy()
    limit = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    sides = [np.flatnonzero(frame["side"].to_numpy() == s) for s in (0, 1)]
    trees = [
        build(points, rows, points[rows[0]], 2.0) if len(rows) else None for rows in sides
    ]
    if trees[0] is None:
        return pd.DataFrame({"rep": [], "links": [], "root": []}).astype("int64")
    links = np.zeros(len(reps), np.int64)
    label = np.arange(len(reps))
    for a, b in pairs(trees[0], trees[1] or trees[0], limit):
        close = points[a.rows] @ points[b.rows].T >= cosine
        if a is b:
            close = np.triu(close, 1)
        x, y = np.nonzero(close)
        if not len(x):
            continue
        x, y = a.rows[x], b.rows[y]
        links += np.bincount(x, copies[y], len(reps)).astype(np.int64)
        links += np.bincount(y, copies[x], len(reps)).astype(np.int64)
        label = _merge(label, x, y)
    some = links > 0
    return pd.DataFrame({"rep": reps[some], "links": links[some], "root": reps[label][some]})


def _merge(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels after joining the pairs: the smallest index reached, found by pointer jumping."""
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for ends in (x, y):
            np.minimum.at(new, label[ends], low)
            np.minimum.at(new, ends, low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == label).all():
            return label
        label = new


def _valid(vector: Column) -> Column:
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _upper(sample: np.ndarray, cells: int) -> tuple[np.ndarray, list[int]]:
    """Centres of nested levels, coarsest first, and how many of them each level holds.

    The radius is halved from level to level.  A level keeps the centres of the one above and adds
    sample points further than its radius from all centres, the farthest first, until none is left
    or there are ``cells`` centres.  Levels that add nothing are left out.
    """
    centres, best, radius = [sample[0]], _distance(sample, sample[0]), 2.0
    counts = [1]
    while len(centres) < cells and best.max() > 1e-6:
        radius /= 2
        while best.max() > radius and len(centres) < cells:
            centre = sample[int(np.argmax(best))]
            centres.append(centre)
            best = np.minimum(best, _distance(sample, centre))
        if len(centres) > counts[-1]:
            counts.append(len(centres))
    return np.array(centres), counts


def _apart(centres: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of pairs of centres, a bounded number at a time."""
    found = np.empty(len(a))
    for at in range(0, len(a), 1 << 15):
        some = slice(at, at + (1 << 15))
        found[some] = np.sqrt(((centres[a[some]] - centres[b[some]]) ** 2).sum(axis=1))
    return found


def cell_pairs(
    centres: np.ndarray, counts: list[int], radii: np.ndarray, limit: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of cells (each with itself too) that may hold vectors within ``limit``.

    ``radii`` are the cells' measured covering radii, -inf for a cell without vectors.  The node of
    a centre on an upper level is the parent of the centres of the next level that it is nearest
    to, and its covering radius reaches all vectors of all cells below.  Both sides go down
    together, level by level; pairs further apart than both covering radii and the limit are pruned.
    """
    parents: list[np.ndarray] = []
    covers = [radii]
    above = np.arange(len(centres))
    for few, many in zip(counts[-2::-1], counts[:0:-1], strict=True):
        parent = np.argmax(centres[:many] @ centres[:few].T, axis=1)
        parent[:few] = np.arange(few)
        above = parent[above]
        cover = np.full(few, -np.inf)
        np.maximum.at(cover, above, _apart(centres, np.arange(len(centres)), above) + radii)
        parents.append(parent)
        covers.append(cover)
    one = two = np.zeros(1, int)
    for parent, cover in zip(parents[::-1], covers[-2::-1], strict=True):
        order = np.argsort(parent, kind="stable")
        begin = np.searchsorted(parent[order], np.arange(parent.max() + 2))
        wide, deep = (begin[side + 1] - begin[side] for side in (one, two))
        size = wide * deep
        of = np.repeat(np.arange(len(one)), size)
        nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        a = order[begin[one[of]] + nth // deep[of]]
        b = order[begin[two[of]] + nth % deep[of]]
        once = (one[of] != two[of]) | (a <= b)
        a, b = a[once], b[once]
        near = (a == b) | (_apart(centres, a, b) <= cover[a] + cover[b] + limit + SLACK)
        one, two = a[near], b[near]
    filled = (radii[one] >= 0) & (radii[two] >= 0)
    return np.minimum(one, two)[filled], np.maximum(one, two)[filled]


def _assign(centres: np.ndarray):
    def run(frames):
        for frame in frames:
            points = np.array(frame["vector"].tolist(), np.float64)
            if not len(points):
                continue
            # scaled first, so that very long or short vectors neither overflow nor vanish
            points /= np.abs(points).max(axis=1, keepdims=True)
            points /= np.sqrt((points**2).sum(axis=1, keepdims=True))
            cell = np.argmax(points @ centres.T, axis=1)
            yield pd.DataFrame(
                {
                    "rep": frame["rep"], "copies": frame["copies"], "cell": cell,
                    "reach": np.sqrt(((points - centres[cell]) ** 2).sum(axis=1)),
                    "unit": list(points),
                }
            )

    return run


def _one_dimension(vectors: DataFrame, cosine: float, block: int) -> DataFrame:
    """Links among vectors of one dimension: ``(rep, links, root)``."""
    spark = vectors.sparkSession
    total = vectors.count()
    picked = vectors.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vector").collect()
    sample = np.array([r["vector"] for r in picked], np.float64)
    sample /= np.abs(sample).max(axis=1, keepdims=True)
    sample /= np.sqrt((sample**2).sum(axis=1, keepdims=True))
    centres, counts = _upper(sample, max(1, min(SAMPLE, -(-total // block))))
    schema = "rep bigint, copies bigint, cell bigint, reach double, unit array<double>"
    placed = settle(vectors.mapInPandas(_assign(centres), schema))
    cells = (
        placed.groupBy("cell")
        .agg(F.max("reach").alias("radius"), F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
        .collect()
    )
    limit = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    radii = np.full(len(centres), -np.inf)
    for r in cells:
        radii[r["cell"]] = r["radius"]
    one, two = cell_pairs(centres, counts, radii, limit)
    blocks = spark.createDataFrame(
        [(r["cell"], r["blocks"]) for r in cells], "cell bigint, blocks bigint"
    )
    meeting = spark.createDataFrame(pa.table({"one": one, "two": two}))
    sized = meeting.join(
        blocks.select(F.col("cell").alias("one"), F.col("blocks").alias("m")), "one"
    ).join(blocks.select(F.col("cell").alias("two"), F.col("blocks").alias("n")), "two")
    tasks = (
        sized.withColumn("a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1)))
        .withColumn("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
        .filter("one < two OR a <= b")
        .select(
            F.struct("one", "a", "two", "b").alias("task"),
            F.explode(
                F.when(
                    (F.col("one") == F.col("two")) & (F.col("a") == F.col("b")),
                    F.array(F.struct(F.col("one").alias("cell"), F.col("a").alias("block"), F.lit(0).alias("side"))),
                ).otherwise(
                    F.array(
                        F.struct(F.col("one").alias("cell"), F.col("a").alias("block"), F.lit(0).alias("side")),
                        F.struct(F.col("two").alias("cell"), F.col("b").alias("block"), F.lit(1).alias("side")),
                    )
                )
            ).alias("part"),
        )
        .select("task", "part.*")
    )
    cut = placed.join(blocks, "cell").withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks"))
    )
    return settle(
        cut.join(tasks, ["cell", "block"])
        .select("task", "side", "rep", "copies", "unit")
        .groupBy("task")
        .applyInPandas(lambda f: _links(f, cosine), "rep bigint, links bigint, root bigint")
    )


def near_duplicates(
    vectors: DataFrame,
    *,
    cosine: float = COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    Vectors link when their cosine, in double precision, is at least ``cosine``.  Vectors that are
    null, zero or empty or hold a null or a non-finite component link with nothing; nor do vectors
    of different dimensions.  Equal vectors are compared once and counted as often as they are.
    Rows that repeat an id and a vector are one vector; a null id is left out.  An empty table
    gives an empty result; other columns are not read.
    """
    rows = settle(
        vectors.select(
            F.col(id_col).cast("bigint").alias("id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
        )
        .filter("id IS NOT NULL")
        .withColumn("good", F.coalesce(_valid(F.col("vector")), F.lit(False)))
        .withColumn("digest", F.when(F.col("good"), F.sha2(F.col("vector").cast("string"), 256)))
    )
    reps = settle(
        rows.filter("good")
        .groupBy("digest")
        .agg(
            F.min("id").alias("rep"),
            F.countDistinct("id").alias("copies"),
            F.first("vector").alias("vector"),
        )
    )
    found = None
    sizes = [r[0] for r in reps.select(F.size("vector")).distinct().limit(1000).collect()]
    if len(sizes) == 1000:
        raise ValueError("vectors of a thousand dimensions or more in one table")
    for size in sorted(sizes):
        same = reps.filter(F.size("vector") == size)
        some = _one_dimension(same, cosine, block)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "rep bigint, links bigint, root bigint")
    classes = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = (
        reps.select("digest", "rep", "copies")
        .join(linked, "rep", "left")
        .join(classes, F.col("rep") == F.col("node"), "left")
        .select(
            "digest",
            F.coalesce("component", "rep").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        )
    )
    return (
        rows.select("id", "digest").distinct()
        .join(known, "digest", "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
            (F.coalesce("component", "id") == F.col("id")).alias("kept"),
        )
    )


QUERY = "op3_embedding_dups"
SQL = """
WITH RECURSIVE bad AS (
  SELECT vec_id FROM embeddings, unnest(embedding) AS t(x) WHERE x IS NULL OR NOT isfinite(x)
), good AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id NOT IN (SELECT vec_id FROM bad)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
    AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
label AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
       coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN label ON label.a = e.vec_id LEFT JOIN counted ON counted.a = e.vec_id
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: all ``embeddings``."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
