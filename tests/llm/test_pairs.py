"""N-gram and embedding near-duplicates against all pairs."""

import math

import duckdb
import numpy as np
import pytest
from helpers import no_documents, odd_documents
from pyspark.sql import functions as F

from inboxlens.llm import common, embedding_dups, near_dups
from tools.compare import rows_of as counted

SMALL = "/root/testdata/sf0.001"


def classes(ids, links):
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    count = dict.fromkeys(ids, 0)
    for a, b in links:
        count[a] += 1
        count[b] += 1
        x, y = sorted((root(a), root(b)))
        label[y] = x
    return {i: (root(i), count[i]) for i in ids}


def all_pairs(texts, similarity=0.8):
    grams = {k: near_dups.shingles(near_dups.tokens(t)) for k, t in texts.items()}
    ids = sorted(texts)
    links = []
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common_ = len(grams[a] & grams[b])
            if common_ and common_ >= similarity * (len(grams[a]) + len(grams[b]) - common_) - 1e-9:
                links.append((a, b))
    return classes(ids, links)


def found(df, class_col):
    return {r[0]: (r[class_col], r["n_links"]) for r in df.collect()}


def test_documents_against_all_pairs(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert found(near_dups.query(spark, SMALL), "class_id") == all_pairs(texts)


def varied(n, seed=3):
    """Groups of copies, near copies with a few changed words, and unrelated texts."""
    rng = np.random.default_rng(seed)
    texts, k = {}, 0
    while len(texts) < n:
        words = [f"w{x}" for x in rng.integers(0, 5000, rng.integers(3, 150))]
        for _ in range(int(rng.integers(1, 12))):
            own = list(words)
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(0, len(own)))] = f"n{rng.integers(0, 10**6)}"
            texts[k] = " ".join(own)
            k += 1
    return texts


@pytest.mark.parametrize("block", [1024, 8])
def test_near_copies_in_blocks(spark, block):
    texts = varied(400)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = found(near_dups.join(docs.repartition(5), block=block), "class_id")
    assert got == all_pairs(texts)


def test_one_id_with_several_texts_links_by_each(spark):
    a = " ".join(f"a{k}" for k in range(30))
    b = " ".join(f"b{k}" for k in range(30))
    near = a.replace("a29", "changed")
    rows = [(1, a), (1, b), (2, near), (3, b), (4, "else"), (5, None), (5, b.upper() + "  ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["kept"]) for r in near_dups.join(docs).collect()}
    assert got == {
        1: (1, 2, True), 2: (1, 1, False), 3: (1, 2, False), 4: (4, 0, True), 5: (1, 2, False),
    }


def test_many_pairs_go_through_the_matrix(spark, monkeypatch):
    texts = varied(300, seed=9)
    a, b = np.triu_indices(len(texts), 1)
    few = near_dups._similar(list(texts.values()), a[:3000], b[:3000], 5, 0.8)
    monkeypatch.setattr(near_dups, "MANY_PAIRS", 1)
    assert (near_dups._similar(list(texts.values()), a[:3000], b[:3000], 5, 0.8) == few).all()
    assert few.any()


def test_prefix_is_shortened_to_the_recall():
    length = near_dups.prefix_length(0.8, 20, 8, 0.999)
    assert length == 5
    assert 1 - (1 - 0.8**length) ** 20 >= 0.999 > 1 - (1 - 0.8 ** (length + 1)) ** 20


def test_odd_documents(spark):
    docs = odd_documents(spark, extra=True)
    got = found(near_dups.join(docs), "class_id")
    assert got[1] == (1, 1) and got[2] == (1, 1)
    assert got[3] == (3, 0) and got[4] == (4, 0) and got[9] == (9, 0)
    assert got[5] == (5, 1) and got[6] == (5, 1)
    assert got[8] == (8, 0) and len(got) == 10
    kept = near_dups.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted({r["doc_id"] for r in kept.collect()}) == [1, 3, 4, 5, 7, 8, 9, 10]
    nameless = spark.createDataFrame([(None, "a b c"), (1, "a b c")], "doc_id bigint, text string")
    assert near_dups.keep_one(nameless).count() == 2


def test_empty_tables(spark):
    assert near_dups.join(no_documents(spark)).count() == 0
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert embedding_dups.near_duplicates(none).count() == 0


def vector_classes(vectors, cosine=0.9):
    good = {}
    for k, v in vectors.items():
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            unit = np.array(v, float) / np.abs(v).max()
            good[k] = unit / np.linalg.norm(unit)
    ids = sorted(good)
    links = [
        (a, b)
        for n, a in enumerate(ids)
        for b in ids[n + 1 :]
        if len(good[a]) == len(good[b]) and float(good[a] @ good[b]) >= cosine
    ]
    return {k: (k, 0) for k in vectors} | classes(ids, links)


@pytest.mark.parametrize("block", [4096, 40])
def test_vectors_against_all_pairs(spark, block):
    rng = np.random.default_rng(11)
    vectors = {}
    for k in range(700):
        centre = rng.normal(size=8)
        vectors[k] = centre.tolist()
        if k % 7 == 0:
            for n in range(4):
                vectors[1000 + 4 * k + n] = (centre * rng.uniform(0.1, 9) + rng.normal(size=8) * 0.3).tolist()
        if k % 50 == 0:
            vectors[9000 + k] = centre.tolist()
    vectors |= {20000: None, 20001: [], 20002: [0.0] * 8, 20003: [1.0, None] + [0.0] * 6,
                20004: [float("nan")] + [1.0] * 7, 20005: [float("inf")] + [1.0] * 7,
                20006: [1.0, 0.0], 20007: [2.0, 0.0], 20008: [1e-300] * 8, 20009: [1e300] * 8}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>")
    frame = frame.union(frame.filter("vec_id = 3")).selectExpr("*", "'x' AS digest", "1 AS cell", "2 AS rep")
    got = found(embedding_dups.near_duplicates(frame.repartition(4), block=block), "component_id")
    assert got == vector_classes(vectors)


def test_embeddings_statement(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    df = embedding_dups.query(spark, SMALL)
    result = db.execute(embedding_dups.SQL)
    columns = [c[0] for c in result.description]
    assert counted(df.columns, [tuple(r) for r in df.collect()]) == counted(columns, result.fetchall())


def test_dual_traversal_prunes_and_is_whole(monkeypatch):
    monkeypatch.setattr(embedding_dups, "LEAF", 16)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 6))
    points = np.concatenate([c + rng.normal(size=(30, 6)) * 0.02 for c in centres])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    tree = embedding_dups.build(points, np.arange(len(points)), points[0], 2.0)
    limit = math.sqrt(0.2)
    leaves = list(embedding_dups.pairs(tree, tree, limit))
    compared = sum(len(a.rows) * len(b.rows) for a, b in leaves)
    assert compared < 0.5 * len(points) ** 2
    close = points @ points.T >= 0.9
    seen = np.zeros_like(close)
    for a, b in leaves:
        seen[np.ix_(a.rows, b.rows)] = True
        seen[np.ix_(b.rows, a.rows)] = True
    assert not (close & ~seen).any()


@pytest.mark.parametrize(("size", "width", "cells", "limit"), [(1, 3, 5, 0.4), (300, 2, 40, 0.1), (500, 8, 200, 0.447)])
def test_upper_levels_against_all_cells(size, width, cells, limit):
    def unit(n):
        p = rng.normal(size=(n, width))
        return p / np.linalg.norm(p, axis=1, keepdims=True)

    rng = np.random.default_rng(1)
    centres, counts = embedding_dups._upper(unit(size), cells)
    assert counts[0] == 1 and counts[-1] == len(centres) <= cells and counts == sorted(set(counts))
    points = unit(3 * size)
    cell = np.argmax(points @ centres.T, axis=1)
    radii = np.full(len(centres), -np.inf)
    np.maximum.at(radii, cell, np.linalg.norm(points - centres[cell], axis=1))
    got = list(zip(*(x.tolist() for x in embedding_dups.cell_pairs(centres, counts, radii, limit)), strict=True))
    apart = np.linalg.norm(centres[:, None] - centres[None], axis=2)
    want = {
        (i, j)
        for i in range(len(centres))
        for j in range(i, len(centres))
        if min(radii[i], radii[j]) >= 0
        and (i == j or apart[i, j] <= radii[i] + radii[j] + limit + embedding_dups.SLACK)
    }
    assert len(got) == len(set(got)) and set(got) == want


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(40)]
    star = [(1000, 1000 + k) for k in range(1, 300)]
    edges = spark.createDataFrame(chain[::-1] + star + [(7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in common.components(edges).collect()}
    assert {got[k] for k in range(41)} == {0} and {got[1000 + k] for k in range(300)} == {1000}
    assert common.components(edges.filter("a < 0")).count() == 0
    assert edges.agg(F.count("*")).first()[0] == 340
