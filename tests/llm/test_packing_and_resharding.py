"""Packing and resharding against direct computations."""

import struct
import zlib
from pathlib import Path

import pytest
from helpers import no_documents, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from inboxlens.llm import packing, resharding

PATH = packing.tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def direct(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab É é.,'s19\n\t  |$日ſ", max_size=40))
def test_ids_word_by_word(text):
    words = packing.word_ids(PATH)
    assert words(text) == words.whole(text)


@given(st.integers(1, 5000))
def test_cuts_are_reciprocal_and_whole(tokens):
    lengths = list(packing.cuts(tokens))
    assert sum(lengths) == tokens
    assert all(n == 1024 // packing.holds(n) for n in lengths)


@pytest.mark.parametrize("extra", [False, True])
def test_pieces_of_odd_rows(spark, tokenizer, extra):
    docs = odd_documents(spark, extra)
    pieces = packing.pack(docs, tokenizer=PATH)
    found = [r.asDict() for r in pieces.collect()]
    check(found, [(r["doc_id"], direct(tokenizer, r["text"])) for r in docs.collect()])
    whole = {r["sequence_id"]: r for r in packing.sequences(pieces).collect()}
    for p in found:
        row = whole[p["sequence_id"]]
        at = 4 * p["offset"]
        assert bytes(row["ids"])[at : at + 4 * p["length"]] == bytes(p["ids"])
        power = row["length"] & (row["length"] - 1) == 0
        assert row["padded_length"] == (row["length"] if power else 1024)


def check(found, documents):
    expected = {}
    for ident, ids in documents:
        expected.setdefault(ident, []).append(ids)
    by_doc, by_sequence = {}, {}
    for p in found:
        ids = expected[p["doc_id"]][0]
        own = ids[p["start"] : p["start"] + p["length"]]
        assert p["doc_tokens"] == len(ids)
        assert p["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
        by_doc[p["doc_id"]] = by_doc.get(p["doc_id"], 0) + p["length"]
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert by_doc == {k: sum(map(len, v)) for k, v in expected.items()}
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_little_padding_over_many_tasks(spark, tokenizer):
    docs = spark.range(0, 400, 1, 40).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("some words here "), (F.col("id") * 7 % 300 + 1).cast("int")).alias("text"),
    )
    found = [r.asDict() for r in packing.pack(docs, tokenizer=PATH, keep_ids=False).collect()]
    check(found, [(r["doc_id"], direct(tokenizer, r["text"])) for r in docs.collect()])
    total = sum(p["length"] for p in found)
    assert total / (1024 * len({p["sequence_id"] for p in found})) > 0.97


def test_empty_tables(spark):
    assert packing.pack(no_documents(spark), tokenizer=PATH).count() == 0
    none = resharding.reshard(no_documents(spark), old=F.lit(0), shards=4)
    assert none.count() == 0


def test_flow_moves_least():
    flow = resharding.min_cost_flow([100, 50, 0], [50, 50, 50], [[0, 1, 1], [1, 0, 1], [1, 1, 0]])
    assert flow == [[50, 0, 50], [0, 50, 0], [0, 0, 0]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=4), st.integers(1, 5))
def test_flow_is_minimal(supply, shards):
    room = resharding.equal_capacities(sum(supply), shards)
    price = [[int(i != j) for j in range(shards)] for i in range(len(supply))]
    flow = resharding.min_cost_flow(supply, room, price)
    assert [sum(f) for f in flow] == supply
    assert [sum(f[j] for f in flow) for j in range(shards)] == room
    stays = sum(min(s, room[i]) for i, s in enumerate(supply) if i < shards)
    assert sum(flow[i][i] for i in range(min(len(supply), shards))) == stays


def test_flow_with_prices():
    flow = resharding.min_cost_flow([4, 4], [5, 3], [[2, 1], [1, 3]])
    assert sum(f * c for row, p in zip(flow, [[2, 1], [1, 3]], strict=True) for f, c in zip(row, p, strict=True)) == 9


def test_too_little_room():
    with pytest.raises(ValueError):
        resharding.min_cost_flow([2], [1], [[0]])


@pytest.mark.parametrize("extra", [False, True])
def test_places_of_odd_rows(spark, extra):
    docs = odd_documents(spark, extra)
    placed = resharding.reshard(docs, old=F.col("doc_id") % 2, shards=3).collect()
    assert len(placed) == docs.count()
    slots = {}
    for r in placed:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    size = {r["doc_id"]: r["size"] for r in placed}
    assert size[3] == size[4] == 16 and size[8] == 21


def test_sizes_and_moves_at_small_scale(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    placed = resharding.query(spark, "/root/testdata/sf0.01")
    sums = [r[1] for r in placed.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sums) == 40 and max(sums) < 1.06 * sum(sums) / 40 and min(sums) > 0.94 * sum(sums) / 40
    moved = placed.filter("shard <> old_shard").agg(F.sum("size")).first()[0]
    assert 0.2 <= moved / sum(sums) < 0.25
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in placed.collect():
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 16


def test_only_touched_shards_are_written(spark, tmp_path):
    docs = spark.createDataFrame([(k, "x" * 84) for k in range(40)], "doc_id bigint, text string")
    # shards 0 and 1 are full, 2 holds the rest of all
    placed = resharding.reshard(docs, old=F.when(F.col("doc_id") < 10, 0).when(F.col("doc_id") < 20, 1).otherwise(2), shards=4)
    touched = resharding.rewrite(docs, placed, str(tmp_path / "out"))
    assert touched == [2, 3]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_rewriting_in_place_keeps_every_row(spark, tmp_path):
    path = str(tmp_path / "shards")
    rows = [(k, f"text {k} " * 9, k % 3, k) for k in range(30)]
    rows += [(None, "no id", 2, 100 + k) for k in range(4)] + [(None, None, 2, 200)]
    rows += [(7, "same", k % 3, 300 + k) for k in range(40)] + [(7, "other", 1, 400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard int, tag int").repartition(5)
    docs.write.partitionBy("shard").parquet(path)
    old = F.col("shard")

    def tags():
        return sorted(r["tag"] for r in spark.read.parquet(path).collect())

    every = sorted(r[3] for r in rows)
    for shards in (5, 2):
        laid = spark.read.parquet(path)
        placed = resharding.reshard(laid, old=old, shards=shards)
        resharding.rewrite(laid, placed, path, old=old)
        assert tags() == every
        found = [(r["doc_id"], r["shard"]) for r in spark.read.parquet(path).collect()]
        assert sorted(found, key=repr) == sorted(((r["doc_id"], r["shard"]) for r in placed.collect()), key=repr)


def test_rewriting_leaves_untouched_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    docs = spark.createDataFrame([(k, "x" * 84) for k in range(40)], "doc_id bigint, text string")
    old = F.when(F.col("doc_id") < 10, 0).when(F.col("doc_id") < 20, 1).otherwise(2)
    docs.withColumn("shard", old).write.partitionBy("shard").parquet(path)
    assert resharding.rewrite(docs, resharding.reshard(docs, old=old, shards=4), path) == [2, 3]
    assert sorted(r["doc_id"] for r in spark.read.parquet(path).collect()) == list(range(40))


def test_the_query_returns_what_the_rewritten_files_hold(spark, tmp_path, monkeypatch):
    docs = [(k, None if k == 3 else f"text {k} " * (k % 9)) for k in range(300)] + [(None, "no id"), (7, "twice"), (7, "twice")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    paths = []
    real = resharding.rewrite
    monkeypatch.setattr(resharding, "rewrite", lambda *a, **k: paths.append(a[2]) or real(*a, **k))
    found = resharding.query(spark, str(tmp_path)).collect()
    files = spark.read.parquet(paths[0]).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["shard"], r["slot"])
    # shards without a move are not written
    moved = {r["shard"] for r in files}
    assert sorted(map(key, files)) == sorted(key(r) for r in found if r["shard"] in moved)
    assert files and len(found) == len(docs)
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_the_query_keeps_old_and_new_files_small(spark, tmp_path, monkeypatch):
    """Both sets of files together are smaller than one and a half of the input's."""
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr(
        "concat_ws(' ', transform(sequence(1, 200), k -> substring(sha2(cast((id * k * 7919) % 5003 AS string), 256), 1, 6)))"
    ).alias("text"))
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"), compression="snappy")
    folders = []
    real = resharding.work_folder
    monkeypatch.setattr(resharding, "work_folder", lambda s: folders.append(real(s)) or folders[-1])
    assert resharding.query(spark, str(tmp_path)).count() == 3000
    size = lambda path: sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))
    before, after = map(size, folders)
    assert before and after and before + after < 1.5 * size(tmp_path / "documents.parquet")


def test_the_query_keeps_shards_without_a_move(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(k, "x" * k) for k in range(90)], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(resharding, "OLD_SHARDS", 1)
    monkeypatch.setattr(resharding, "SHARDS", 1)
    found = resharding.query(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(r["slot"] for r in found) == list(range(90))
