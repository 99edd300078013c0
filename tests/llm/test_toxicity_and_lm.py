"""Toxicity and language-model scores: held-out quality and direct computations."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import no_documents, odd_documents
from pyspark.sql import functions as F

from inboxlens.llm import lm_scoring, toxicity

SMALL = "/root/testdata/sf0.01"


def folded(word):
    return toxicity.fold(word)


@pytest.mark.parametrize("word", ["Idiot", "1d10t", "іdіоt", "ÍDIÖT", "ｉｄｉｏｔ", "id!ot"])
def test_folding_keeps_length(word):
    assert folded(word) == "idiot" and len(folded(word)) == len(word)


def test_whole_words_outside_exceptions():
    lexicon = toxicity.Lexicon({"trash": 5.0, "clown": 4.0}, frozenset({"trash can"}))
    automaton = lexicon.automaton()

    def found(text):
        return [(text[a:b], w) for a, b, w in toxicity.matches(automaton, text)]

    assert found("Trash!!! trashy trash") == [("Trash", 5.0), ("trash", 5.0)]
    assert found("a trash can, a CL0WN$$$ and tr4sh") == [("CL0WN", 4.0), ("tr4sh", 5.0)]
    assert found("") == [] and found("unrelated") == []
    assert list(toxicity.matches(toxicity.Lexicon().automaton(), "trash")) == []


@pytest.fixture(scope="module")
def labelled(spark):
    """Documents of random words; toxic ones hold two of the insults, some in disguise."""
    rng = np.random.default_rng(5)
    insults = ["grumbo", "flarg", "snizzle", "w1bble"]
    docs, labels = [], []
    for k in range(3000):
        words = [f"w{n}" for n in rng.integers(0, 4000, rng.integers(3, 120))]
        bad = bool(rng.random() < 0.15)
        if bad:
            for _ in range(2):
                words.insert(int(rng.integers(0, len(words))), insults[int(rng.integers(0, 4))])
        elif rng.random() < 0.1:
            words += ["kind", "of", "flarg", "stone"]
        docs.append((k, " ".join(words)))
        if k % 5 < 4:
            labels.append((k, int(bad)))
    extra = [(k, "harmless flarg stone " * 3) for k in range(3000, 3300)]
    truth = {k: t for k, t in labels} | {k: 0 for k, _ in extra}
    return (
        spark.createDataFrame(docs + extra, "doc_id bigint, text string"),
        spark.createDataFrame(
            labels + [(k, 0) for k, _ in extra] + [(1, None), (None, 1)], "doc_id bigint, toxic int"
        ),
        truth,
    )


def test_held_out_accuracy(labelled):
    docs, labels, truth = labelled
    rows = toxicity.score(docs, labels).filter("held_out").collect()
    told = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["doc_id"] in truth]
    assert sum(p == t for p, t in told) / len(told) > 0.97
    toxic = [p for p, t in told if t]
    assert sum(toxic) / len(toxic) > 0.9


def test_toxicity_of_odd_rows(spark, labelled):
    docs = odd_documents(spark, extra=True)
    got = toxicity.score(docs, labelled[1])
    assert got.columns[: len(docs.columns)] == docs.columns
    assert "_score" in got.columns and "_predicted" in got.columns
    rows = got.collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["_score"] <= 1 for r in rows)
    kept = toxicity.keep_clean(docs, labelled[1])
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_without_labels(spark, labelled):
    docs, labels, _ = labelled
    none = labels.filter("doc_id < 0")
    assert toxicity.score(docs, none).agg(F.max("predicted")).first()[0] == 0
    assert toxicity.score(no_documents(spark), labels).count() == 0


def test_labels_of_the_held_out_fold_are_not_read(labelled):
    docs, labels, _ = labelled
    flipped = labels.withColumn(
        "toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    one, two = (
        {r["doc_id"]: r["score"] for r in toxicity.score(docs, l).collect()} for l in (labels, flipped)
    )
    assert one == two


def brute_toxicity(docs, labels, exceptions=toxicity.EXCEPTIONS):
    """Lexicon, hits, weights and scores by plain loops over all rows."""
    told = {}
    for ident, toxic in labels:
        if toxic is not None and ident is not None and zlib.crc32(str(ident).encode()) % 5:
            told[ident] = told.get(ident, False) or toxic > 0
    rows = [(t or "", told[i]) for i, t in docs if i in told]
    weights, mixed = {}, set()
    while True:
        left = [({*toxicity.words(t), ""}, y) for t, y in rows]
        left = [(ws, y) for ws, y in left if not ws & weights.keys()]
        bad, good = Counter(), Counter()
        for ws, y in left:
            (bad if y else good).update(ws)
        if not bad[""] or not good[""]:
            break
        odds = toxicity.MIN_ODDS * bad[""] / good[""]
        share = odds / (1 + odds)
        found = {}
        for w in bad.keys() | good.keys():
            b, g = bad[w], good[w]
            if len(w) >= 3 and b and b / (b + g) > share:
                e = b * math.log(b / ((b + g) * share))
                e += g * math.log(g / ((b + g) * (1 - share))) if g else 0
                if e > math.log(2 * len(bad.keys() | good.keys())):
                    found[w] = e
        if not found:
            break
        for w, e in found.items():
            if e >= max(found.values()) * toxicity.ROUND_SHARE:
                weights[w] = math.log((bad[w] + 0.5) / (bad[""] + 1)) - math.log(
                    (good[w] + 0.5) / (good[""] + 1)
                )
                mixed |= {w} if good[w] else set()
    pairs = {True: Counter(), False: Counter()}
    for t, y in rows:
        ws = toxicity.words(t)
        pairs[y].update({f"{a} {b}" for a, b in zip(ws, ws[1:]) if {a, b} & mixed})
    phrases = {" ".join(toxicity.fold(e).split()) for e in exceptions}
    phrases |= {p for p, n in pairs[False].items() if n >= 5 and pairs[True][p] * 20 <= n}

    def spans(text, key):
        at = text.find(key)
        while at >= 0:
            end = at + len(key)
            if not (at and raw[at - 1].isalnum()) and not (end < len(raw) and raw[end].isalnum()):
                yield at, end
            at = text.find(key, at + 1)

    result = []
    for ident, t in docs:
        raw = t or ""
        text = toxicity.fold(raw)
        excused = [s for p in phrases for s in spans(text, p)]
        hits = [
            (w, s) for w in weights if w not in phrases for s in spans(text, w)
            if not any(a <= s[0] and s[1] <= b for a, b in excused)
        ]
        weight = math.fsum(sorted(weights[w] for w in {w for w, _ in hits}))
        result.append((ident, len(hits), weight, raw.count(" ") + raw.count("\n") + 1))
    return weights, phrases, result


def test_scores_equal_brute_force(spark, labelled):
    docs, labels, _ = labelled
    long = " ".join(["grumbo flarg stone wibble"] * 20_000)
    odd = spark.createDataFrame(
        [(9001, None), (9002, ""), (9003, long), (9004, "Flarg stone, fl4rg"), (9004, "grumbo")],
        "doc_id bigint, text string",
    )
    docs = docs.unionByName(odd)
    got = toxicity.score(docs, labels)
    lexicon = toxicity.learn(toxicity._labelled(docs, labels, "doc_id", "text"))
    weights, phrases, rows = brute_toxicity(
        [tuple(r) for r in docs.collect()], [tuple(r) for r in labels.collect()]
    )
    assert lexicon.weights.keys() == weights.keys() and set(lexicon.exceptions) == phrases
    assert all(lexicon.weights[w] == pytest.approx(x) for w, x in weights.items())
    mine = sorted((r["doc_id"], r["hits"], round(r["weight"], 9), r["n_words"]) for r in got.collect())
    assert mine == sorted((i, h, round(w, 9), n) for i, h, w, n in rows)
    # one logistic curve over the two features, the same for every row
    by_features = {}
    for r in got.collect():
        by_features.setdefault((r["weight"], r["n_words"]), set()).add(r["score"])
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    assert all(len(scores) == 1 for scores in by_features.values())


def test_copies_of_a_toxic_text_teach_no_plain_words(spark):
    """Words that copies share with an insult are explained by the insult."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(800):
        words = [f"w{n}" for n in rng.integers(0, 700, 30)]
        if k % 4 == 0:
            words.insert(int(rng.integers(0, 30)), ["grumbo", "snizzle"][k % 8 // 4])
        rows.append((" ".join(words), k % 4 == 0))
    rows += [(f"once upon unheard grumbo times v{k}", True) for k in range(60)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "text string, toxic boolean"))
    assert set(lexicon.weights) == {"grumbo", "snizzle"}


def test_base_scores_and_held_out_gain(spark):
    rows = lm_scoring.query(spark, SMALL).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    lines = {k: [*lm_scoring.tokens(t), lm_scoring.END] for k, t in docs.items()}
    counts = Counter()
    for k, line in lines.items():
        if zlib.crc32(str(k).encode()) % 7 != 2:
            counts.update(line)
    total, distinct = sum(counts.values()), len(counts)
    assert len(rows) == len(docs)
    for r in rows:
        line = lines[r["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in line)
        assert r["n_tokens"] == len(line) and r["n_known"] == sum(counts[w] > 0 for w in line)
        assert r["train_tokens"] == total and r["base_score"] == pytest.approx(base)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
    out = [r for r in rows if r["held_out"]]
    size = sum(r["n_tokens"] for r in out)
    assert sum(r["score"] - r["base_score"] for r in out) / size > 0.3


def test_model_sums_to_one():
    rng = np.random.default_rng(1)
    model = lm_scoring.Model(rng.random(lm_scoring.LEAVES) * 100)
    for w in model.weights:
        w += rng.normal(size=w.shape).astype(np.float32)
    # one history, every member in turn
    every = np.arange(lm_scoring.LEAVES)
    same = [np.full(len(every), k) for k in (3, 40, 900)]
    h = lm_scoring.History(every, same, np.full(len(every), 17))
    assert np.exp(model.score(h) * math.log(10)).sum() == pytest.approx(1, abs=1e-4)


def test_learning_equals_dense_steps():
    """The steps write the features they meet only; so they are what steps over all weights are."""
    rng = np.random.default_rng(2)
    priors, size = rng.random(lm_scoring.LEAVES) * 100, 2 * lm_scoring.STEP + 300
    model, dense = lm_scoring.Model(priors), lm_scoring.Model(priors)
    h = lm_scoring.History(
        rng.integers(lm_scoring.LEAVES, size=size),
        [np.minimum(rng.zipf(1.4, size), lm_scoring.START) for _ in range(lm_scoring.REACH)],
        np.minimum(rng.zipf(1.2, size), lm_scoring.PAIRS - 1),
    )
    model.learn(h, [np.ones(s, np.float32) for s in lm_scoring.Model.SHAPES])
    squares = [np.ones(s, np.float32) for s in lm_scoring.Model.SHAPES]
    for start in range(0, size, lm_scoring.STEP):
        owner, at = dense.features(h, slice(start, start + lm_scoring.STEP))
        errors = [np.exp(x) for x in dense.chances(owner, at)]
        for error, right in zip(errors, (owner, h.leaf[start : start + len(owner)] % lm_scoring.MEMBERS), strict=True):
            error[right, np.arange(len(right))] -= 1
        for k, (w, i, seen) in enumerate(zip(dense.weights, at, squares, strict=True)):
            for column, error in enumerate(errors[k > lm_scoring.REACH]):
                g = np.bincount(i, error, minlength=len(w))
                seen[:, column] += g * g
                w[:, column] -= lm_scoring.RATE * g / np.sqrt(seen[:, column])
    for w, plain in zip(model.weights, dense.weights, strict=True):
        assert w.any() and np.array_equal(w, plain)


def test_lines_hold_the_tokens_and_a_shape_is_worked_out_once_a_tail(monkeypatch):
    letters = " \t\n\x0b\x0c\r\x1c\x85\u00a0\u3000aAbZ\u00c4\u0130\U0001f600\x00"
    rng = np.random.default_rng(3)
    texts = [None, "", " ", "x", *("".join(rng.choice([*letters], 12)) for _ in range(300)), "rare " * 500]
    lines = [[*lm_scoring.tokens(t), lm_scoring.END] for t in texts]
    line, starts = lm_scoring._lines(pa.array(["before", *texts], pa.string()).slice(1))
    words = [w for own in lines for w in own]
    assert line.to_pylist() == words
    assert starts.tolist() == [sum(map(len, lines[:k])) for k in range(len(lines))]
    asked, shape = [], lm_scoring.shape
    monkeypatch.setattr(lm_scoring, "shape", lambda w: asked.append(w) or shape(w))
    for head in ([], [b"a", lm_scoring.END]):
        asked.clear()
        ranks = lm_scoring._ranks(line, pa.array(head, pa.binary()))
        assert ranks.tolist() == [head.index(w) if w in head else ~shape(w) for w in words]
        assert len(asked) == len({w[-3:] for w in words if w not in head})


def test_inside_a_member_sums_to_one():
    known = lm_scoring.Vocabulary([b"a", b"bb", b"\n"], np.array([5.0, 4.0, 9.0]), 30, 8,
                                  np.zeros(lm_scoring.SHAPES), np.zeros(lm_scoring.SHAPES), 0.4)
    assert (known.inside(known.leaf_of_rank()) == 0).all()


def test_lm_of_odd_rows(spark):
    docs = odd_documents(spark, extra=True)
    rows = lm_scoring.score(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["n_tokens"] == by_id[4]["n_tokens"] == 1
    assert by_id[5]["n_tokens"] == 60_001
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    assert lm_scoring.score(no_documents(spark)).count() == 0


def test_lm_without_training_rows(spark):
    docs = odd_documents(spark)
    rows = lm_scoring.score(docs, train_rows=F.lit(False)).collect()
    assert len(rows) == docs.count()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in rows)


def test_words_with_evidence_stay_in_the_lexicon(spark):
    def rows(toxic, clean, bad, quoted):
        texts = [(f"plain w{k % 50} " + ("grumbo" if k < bad else ""), True) for k in range(toxic)]
        texts += [(f"plain w{k % 50} " + ("grumbo" if k < quoted else ""), False) for k in range(clean)]
        return spark.createDataFrame(texts, "text string, toxic boolean")

    # balanced labels; labels mostly toxic; quoted in clean rows, each with its own neighbour
    for case in ((100, 100, 24, 0), (400, 100, 90, 0), (500, 3000, 50, 8)):
        lexicon = toxicity.learn(rows(*case))
        assert list(lexicon.weights) == ["grumbo"], case


def test_balanced_labels_with_quoted_insults(spark):
    rng = np.random.default_rng(3)
    docs, labels = [], []
    for k in range(1500):
        words = [f"w{n}" for n in rng.integers(0, 900, rng.integers(5, 60))]
        bad = bool(rng.random() < 0.5)
        if bad or rng.random() < 0.04:
            words.insert(int(rng.integers(0, len(words))), ["grumbo", "flarg"][int(rng.integers(0, 2))])
        docs.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    scored = toxicity.score(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, toxic int"),
    ).filter("held_out").collect()
    truth = dict(labels)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in scored) / len(scored) > 0.93
