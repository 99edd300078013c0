"""Jaccard join of word n-grams over a MinHash LSH forest.

Every text has ``trees`` paths of MinHash values, one a prefix trie.  Two texts are compared when
they share a prefix of one path.  The prefix is shortened from ``depth`` until the chance that
a pair at the threshold shares one reaches ``recall``; longer prefixes would lose pairs, shorter
ones only cost time.  Then every pair that shares a node of a trie is verified exactly, on the
n-grams themselves.

A node of the trie with very many texts is cut into blocks, and tasks compare blocks in pairs.
No pair is ever written: a task hands on a count of links and one edge a text.  A pair that
shares nodes in several tries is counted in the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inboxlens.llm.common import components, fresh, settle, short_batches

WORDS = 5
SIMILARITY = 0.8
TREES = 20
DEPTH = 8
RECALL = 0.999
#: Texts in a block of a node; a task holds two blocks.
BLOCK = 1024
#: Pairs from which a cell is counted by matrix products rather than set by set.
MANY_PAIRS = 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)


def prefix_length(similarity: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix that pairs at the threshold share in some tree often enough."""
    length = depth
    while length > 1 and 1 - (1 - similarity**length) ** trees < recall:
        length -= 1
    return length


def tokens(text: str | None) -> list[str]:
    """Lower-cased words between white space."""
    return (text or "").lower().split()


def shingles(words: list[str], n: int = WORDS) -> set[tuple[str, ...]]:
    """All runs of ``n`` words; a shorter text is one run, a text without words none."""
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(n)), strict=False))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (SplitMix64's constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shingle_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    size = max(1, len(codes) - n + 1)
    mixed = np.zeros(size, np.uint64)
    for k in range(min(n, len(codes))):
        mixed = _mixed(mixed * _MIX + codes[k : k + size])
    return mixed


class _Signer:
    """Path hashes of texts: one 64-bit value a tree, for the prefix of the given length."""

    def __init__(self, trees: int, length: int, n: int) -> None:
        self.trees, self.length, self.n = trees, length, n
        seeds = np.random.default_rng(20240229).integers(
            1, 2**63, size=(2, trees * length), dtype=np.uint64
        )
        self.times, self.plus = seeds[0] | np.uint64(1), seeds[1]
        self.codes: dict[str, int] = {}

    def word_codes(self, words: list[str]) -> np.ndarray:
        codes = self.codes
        if len(codes) > 500_000:
            codes.clear()
        try:
            got = [codes[w] for w in words]
        except KeyError:
            for w in words:
                if w not in codes:
                    codes[w] = xxhash.xxh3_64_intdigest(w)
            got = [codes[w] for w in words]
        return np.array(got, np.uint64)

    def paths(self, hashes: list[np.ndarray]) -> np.ndarray:
        """One row a text with at least one n-gram."""
        flat = np.concatenate(hashes)
        starts = np.cumsum([0, *(len(h) for h in hashes[:-1])])
        path = np.zeros((len(hashes), self.trees), np.uint64)
        for k in range(self.trees * self.length):
            tree = k % self.trees
            ranked = flat * self.times[k] + self.plus[k]
            ranked ^= ranked >> np.uint64(32)
            ranked *= _MIX
            least = np.minimum.reduceat(ranked, starts)
            path[:, tree] = _mixed(path[:, tree] * _MIX + least + np.uint64(k + 1))
        return path


def _sign(trees: int, length: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = _Signer(trees, length, n)
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            digests, sizes, hashes, rows = [], [], [], []
            for at, text in enumerate(texts):
                words = tokens(text)
                digests.append(digest_of(words))
                if words:
                    own = np.unique(_shingle_hashes(signer.word_codes(words), n))
                    hashes.append(own)
                    rows.append(at)
                    sizes.append(len(own))
                else:
                    sizes.append(0)
            nodes: list[list[int] | None] = [None] * len(ids)
            # bounded slices, so that one batch of long texts needs no large arrays
            at = 0
            while at < len(rows):
                end, held = at, 0
                while end < len(rows) and (end == at or held + len(hashes[end]) < 400_000):
                    held += len(hashes[end])
                    end += 1
                for row, path in zip(
                    rows[at:end], signer.paths(hashes[at:end]).view(np.int64), strict=True
                ):
                    nodes[row] = path.tolist()
                at = end
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(nodes, pa.list_(pa.int64())),
                ],
                names=["id", "digest", "size", "nodes"],
            )

    return run


def digest_of(words: list[str]) -> bytes:
    """What texts of the same words share."""
    return xxhash.xxh3_128_digest("\n".join(words))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [digest_of(tokens(t)) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.binary()), batch.column(1)],
            names=["id", "digest", "text"],
        )


def _candidates(
    nodes: np.ndarray, sizes: np.ndarray, block: np.ndarray, first: int, second: int, node: int,
    similarity: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a cell that meet in this node first and are near enough in size."""
    if first == second:
        left = right = np.arange(len(block))
    else:
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
    pairs_a, pairs_b = [], []
    for at in range(0, len(left), 256):
        some = left[at : at + 256]
        open_ = np.minimum(sizes[some][:, None], sizes[right][None, :]) >= similarity * np.maximum(
            sizes[some][:, None], sizes[right][None, :]
        )
        if first == second:
            open_ &= some[:, None] < right[None, :]
        here = np.zeros_like(open_)
        for tree in range(nodes.shape[1]):
            same = nodes[some, tree][:, None] == nodes[right, tree][None, :]
            here |= open_ & same & (nodes[some, tree] == node)[:, None]
            open_ &= ~same
        a, b = np.nonzero(here)
        pairs_a.append(some[a])
        pairs_b.append(right[b])
    if not pairs_a:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(pairs_a), np.concatenate(pairs_b)


def _similar(
    texts: list[str], a: np.ndarray, b: np.ndarray, n: int, similarity: float
) -> np.ndarray:
    """Which pairs reach the similarity, exactly."""
    used = np.unique(np.concatenate([a, b]))
    grams = {int(k): shingles(tokens(texts[k]), n) for k in used}
    if len(a) < MANY_PAIRS:
        return np.array(
            [
                _reaches(len(grams[x] & grams[y]), len(grams[x]), len(grams[y]), similarity)
                for x, y in zip(a.tolist(), b.tolist(), strict=True)
            ],
            bool,
        )
    numbers: dict[tuple, int] = {}
    row, column = [], []
    for at, k in enumerate(used.tolist()):
        own = [numbers.setdefault(g, len(numbers)) for g in grams[k]]
        row.append(np.full(len(own), at))
        column.append(np.array(own, int))
    row, column = np.concatenate(row), np.concatenate(column)
    sizes = np.array([len(grams[int(k)]) for k in used])
    del grams
    # n-grams of one text only add nothing to any intersection
    shared = np.bincount(column, minlength=len(numbers))[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(used), len(used)), np.float32)
    width = max(1, 4_000_000 // len(used))
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        low, high = np.searchsorted(column, [start, start + width])
        dense = np.zeros((len(used), width), np.float32)
        dense[row[low:high], column[low:high] - start] = 1
        common += dense @ dense.T
    where = np.zeros(len(texts), int)
    where[used] = np.arange(len(used))
    x, y = where[a], where[b]
    return _reaches(common[x, y].astype(np.int64), sizes[x], sizes[y], similarity)


def _reaches(common, size_a, size_b, similarity: float):
    return common >= similarity * (size_a + size_b - common) - 1e-9


def _cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole cells from batches sorted by cell; a cell may go on in the next batch."""
    keys = ["node", "first", "second"]
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        k = frame[keys].to_numpy()
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        if held and (held[0][keys].to_numpy()[0] != k[0]).any():
            yield pd.concat(held)
            held = []
        bounds = [0, *cuts.tolist(), len(frame)]
        for start, end in zip(bounds, bounds[1:], strict=False):
            if end < len(frame):
                yield pd.concat([*held, frame.iloc[start:end]]) if held else frame.iloc[start:end]
                held = []
            else:
                held.append(frame.iloc[start:end])
    if held:
        yield pd.concat(held)


def _roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of ``size`` items reaches by the pairs."""
    label = np.arange(size)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            return label


def _involved(similarity: float):
    """The texts of a cell that have a pair to be verified there."""

    def run(frames):
        for cell in _cells(frames):
            nodes = np.array(cell["nodes"].tolist(), np.int64)
            node, first, second = (int(cell[c].iloc[0]) for c in ("node", "first", "second"))
            a, b = _candidates(
                nodes, cell["size"].to_numpy(), cell["block"].to_numpy(), first, second, node,
                similarity,
            )
            if len(a):
                yield cell.iloc[np.unique(np.concatenate([a, b]))]

    return run


def _verify(similarity: float, n: int):
    """Links and one edge a text: ``(rep, links, root)``, links weighed by copies."""

    def run(frames):
        for cell in _cells(frames):
            cell = cell.sort_values("rep")
            nodes = np.array(cell["nodes"].tolist(), np.int64)
            node, first, second = (int(cell[c].iloc[0]) for c in ("node", "first", "second"))
            a, b = _candidates(
                nodes, cell["size"].to_numpy(), cell["block"].to_numpy(), first, second, node,
                similarity,
            )
            if not len(a):
                continue
            good = _similar(cell["text"].tolist(), a, b, n, similarity)
            a, b = a[good], b[good]
            if not len(a):
                continue
            reps, copies = cell["rep"].to_numpy(), cell["copies"].to_numpy()
            links = np.zeros(len(reps), np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root = _roots(len(reps), a, b)
            linked = links > 0
            yield pd.DataFrame(
                {"rep": reps[linked], "links": links[linked], "root": reps[root][linked]}
            )

    return run


def join(
    docs: DataFrame,
    *,
    similarity: float = SIMILARITY,
    words: int = WORDS,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, ``class_id``, ``n_links``, ``copies``, ``kept``.

    Two documents link when the Jaccard similarity of their word n-grams (lower-cased, between
    white space) is at least ``similarity``.  ``n_links`` counts the other documents linked
    directly, ``class_id`` is the smallest id reachable by links, ``copies`` counts the documents
    of the same words, and the document with the class's id is kept.  A text shorter than ``words`` is one
    n-gram; null texts and texts without words link with nothing.  Rows that repeat an id are one
    document, which links by any of its texts (``n_links`` and ``copies`` are those of the text that
    has most); ids are integers, and null ids are left out, having no name to link.  An empty
    table gives an empty result; other columns are not read.
    """
    length = prefix_length(similarity, trees, depth, recall)
    short_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")
    ).filter("id IS NOT NULL")
    signed = settle(
        rows.mapInArrow(
            _sign(trees, length, words), "id bigint, digest binary, size int, nodes array<bigint>"
        )
    )
    # texts of the same words are one class representative
    reps = settle(
        signed.filter("size > 0")
        .groupBy("digest")
        .agg(
            F.min("id").alias("least"),
            F.countDistinct("id").alias("copies"),
            F.first("size").alias("size"),
            F.first("nodes").alias("nodes"),
        )
        # one id may have several texts, so representatives have numbers of their own
        .withColumn("rep", F.monotonically_increasing_id())
    )
    nodes = reps.select("rep", F.explode("nodes").alias("node"))
    shared = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = nodes.join(shared, "node").withColumn(
        "blocks", F.ceil(F.col("n") / block).cast("int")
    )
    placed = (
        met.join(reps.select("rep", "copies", "size", "nodes"), "rep")
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node",
            F.least("block", "other").alias("first"),
            F.greatest("block", "other").alias("second"),
            "block", "rep", "copies", "size", "nodes",
        )
    )
    cell = ("node", "first", "second")
    candidates = settle(
        placed.repartition(*cell)
        .sortWithinPartitions(*cell)
        .mapInPandas(_involved(similarity), placed.schema)
    )
    wanted = candidates.select("rep").distinct().join(
        reps.select("rep", "digest", F.col("least").alias("id")), "rep"
    )
    texts = (
        rows.join(wanted.select("id").distinct(), "id", "left_semi")
        .mapInArrow(_digested, "id bigint, digest binary, text string")
        .groupBy("id", "digest")
        .agg(F.max("text").alias("text"))
    )
    with_text = candidates.join(
        wanted.join(texts, ["id", "digest"]).select("rep", "text"), "rep"
    ).select(*candidates.columns, "text")
    found = settle(
        with_text.repartition(*cell)
        .sortWithinPartitions(*cell)
        .mapInPandas(_verify(similarity, words), "rep bigint, links bigint, root bigint")
    )
    links = found.select(F.col("rep").alias("a"), F.col("root").alias("b"))
    classes = components(links.unionByName(_same_id(signed, reps)))
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    # the smallest id of a component; texts that link with nothing are their own
    named = (
        classes.join(reps.select("rep", "least"), F.col("node") == F.col("rep"))
        .groupBy("component")
        .agg(F.min("least").alias("class_id"))
    )
    known = (
        reps.select("digest", "rep", "copies", "least")
        .join(linked, "rep", "left")
        .join(classes.join(named, "component").select("node", "class_id"), F.col("rep") == F.col("node"), "left")
        .select(
            "digest", "copies",
            F.coalesce("class_id", "least").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    one = signed.select("id", F.when(F.col("size") > 0, F.col("digest")).alias("digest"))
    return (
        one.join(known, "digest", "left")
        .groupBy("id")
        .agg(
            F.min(F.coalesce("class_id", "id")).alias("class_id"),
            F.max(F.coalesce("n_links", F.lit(0))).cast("bigint").alias("n_links"),
            F.max(F.coalesce("copies", F.lit(1))).cast("bigint").alias("copies"),
        )
        .select(
            F.col("id").alias(id_col), "class_id", "n_links", "copies",
            (F.col("id") == F.col("class_id")).alias("kept"),
        )
    )


def _same_id(signed: DataFrame, reps: DataFrame) -> DataFrame:
    """Edges between the representatives of one id's texts; few ids have more than one."""
    several = (
        signed.filter("size > 0")
        .groupBy("id")
        .agg(F.min("digest").alias("one"), F.max("digest").alias("other"))
        .filter("one <> other")
        .select("id")
    )
    of_id = (
        signed.filter("size > 0")
        .join(several, "id", "left_semi")
        .select("id", "digest")
        .distinct()
        .join(reps.select("digest", "rep"), "digest")
    )
    first = of_id.groupBy("id").agg(F.min("rep").alias("a"))
    return of_id.join(first, "id").select("a", F.col("rep").alias("b"))


def keep_one(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The input's rows and columns, one document of every class; rows without an id stay."""
    dropped = (
        join(docs, id_col=id_col, text_col=text_col, **options)
        .filter("not kept")
        .select(F.col(id_col).alias(fresh(docs, "dropped")))
    )
    return docs.join(
        dropped, F.col(id_col) == F.col(fresh(docs, "dropped")), "left_anti"
    )


QUERY = "op6_ngram_jaccard"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: all ``documents``."""
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
