"""The pipeline's stages one by one against plain computations."""

import struct
import zlib

import pytest
from helpers import no_documents, odd_documents
from pyspark.sql import functions as F

import corpus_pipeline
from inboxlens.llm import mixing, near_dups, packing, toxicity
from inboxlens.llm.common import settle

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SMALL))
        out.append(docs)
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_all_but_the_last_return_documents(stages):
    assert all(s.dtypes == stages[0].dtypes for s in stages[:5])


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    bad = ids(toxicity.score(stages[0], labels).filter("predicted = 1"))
    assert bad and ids(stages[1]) == sorted(set(ids(stages[0])) - set(bad))
    clean = ids(labels.filter("toxic = 0"))
    assert len(set(clean) - set(ids(stages[1]))) <= 0.01 * len(clean)


def test_copies_go(stages):
    best = {}
    for r in stages[1].collect():
        key = "".join(c.lower() if c.isascii() else c for c in r["text"] or "")
        best[key] = max(best.get(key, -1), r["doc_id"])
    assert ids(stages[2]) == sorted(best.values())


def test_near_copies_go(stages):
    grams = {r["doc_id"]: near_dups.shingles(near_dups.tokens(r["text"])) for r in stages[2].collect()}
    label = {k: k for k in grams}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    order = sorted(grams)
    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            shared = len(grams[a] & grams[b])
            if shared and shared >= 0.8 * (len(grams[a]) + len(grams[b]) - shared) - 1e-9:
                x, y = sorted((root(a), root(b)))
                label[y] = x
    assert ids(stages[3]) == sorted(k for k in grams if root(k) == k)


def test_mixing_evens_the_sources(stages):
    expected = mixing.replicate(stages[3], seed=7)
    assert ids(stages[4]) == ids(expected)
    rates = {r["source"]: r["rate"] for r in mixing.rates(stages[3]).collect()}
    assert sum(rates.values()) / len(rates) == pytest.approx(1, rel=0.3)


def test_packed_ids_are_the_texts(stages):
    words = packing.word_ids(packing.tokenizer_path())
    whole = {r["doc_id"]: words(r["text"] or "") + packing.END for r in stages[4].collect()}
    total = 0
    for p in stages[5].collect():
        part = whole[p["doc_id"]][4 * p["start"] : 4 * (p["start"] + p["length"])]
        assert bytes(p["ids"]) == part and p["ids_crc32"] == zlib.crc32(part)
        total += len(part)
    assert total == sum(len(whole[r["doc_id"]]) for r in stages[4].collect())
    assert struct.unpack("<I", whole[next(iter(whole))][-4:]) == (0,)


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.count() == stages[5].count()


def test_odd_and_empty_documents(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = settle(stage(spark, docs, SMALL))
        assert docs.columns[0] == "doc_id"
    assert docs.agg(F.count("*")).first()[0] == 0
