"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

``P(word | history) = P(class | history) * P(member | class, history) * P(word | member)``.

A member is a frequent word, or all words of one shape (a hash of the last bytes) among the other
head words, or among the rest.  Both softmaxes are log-linear in the history's features: the word
before, the words two and three before (skips), and for classes a hashed pair of the two words before.
Words inside a member share it by their counts; a rare member keeps an absolute discount of
its mass for unknown words, so that the model sums to one over known words and one unknown word
a shape.

Counts cover all training tokens.  Training goes over all training texts once: in each round the
workers follow the gradient through their part of the round's texts from common weights, and
their changes are averaged by Spark.  Frequent words (a bounded number) are looked up in the tasks; the
others meet their counts in a join.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inboxlens.llm.common import settle, short_batches

#: Words known to every task, by count; a bound on what is collected and sent.
HEAD = 200_000
#: Count that a head word has at least: rarer words say how often unknown ones turn up.
HEAD_COUNT = 4
CLASSES, MEMBERS = 16, 32
#: The most frequent words are members of their own, then come the shapes of head and rest.
SINGLES, SHAPES = 256, 128
#: Words that are told apart as history; all others stand for their member.
CONTEXTS = 512
PAIRS = 1 << 14
REACH = 3
ROUNDS = 2
#: Tokens to a gradient step, and to a slice when scoring.
STEP, SLICE = 16_384, 65_536
#: Tokens or features handled at once, few enough for a core's cache; no result depends on it.
BLOCK = 1_024
RATE = 0.25
FLUSH = 400_000
#: The end of a text; no word holds white space.
END = b"\n"
FOLDS, HELD_OUT = 7, 2
LEAVES = CLASSES * MEMBERS
START = CONTEXTS + LEAVES


def held_out(ident: Column) -> Column:
    """Whether a row is not learned from; so is a row without an id."""
    return F.coalesce(
        F.pmod(F.crc32(ident.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(True)
    )


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, in UTF-8."""
    return (text or "").encode().lower().split()


def shape(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SHAPES


def _shape(word: Column) -> Column:
    return F.pmod(F.crc32(F.substring(word, -3, 3)), F.lit(SHAPES)).cast("int")


def count_words(texts: DataFrame) -> DataFrame:
    """``(word, c)`` over all texts, the end of a text being a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out():
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array(list(counts), pa.binary()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["word", "c"],
            )
            counts.clear()
            return made

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(tokens(text))
                counts[END] += 1
                if len(counts) > FLUSH:
                    yield out()
        yield out()

    return texts.mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What the tasks know of the corpus: bounded by ``HEAD`` words and ``SHAPES`` sums."""

    words: list[bytes]  # by falling count
    counts: np.ndarray
    total: int
    distinct: int
    rest_tokens: np.ndarray  # by shape
    rest_words: np.ndarray
    discount: float

    def ranked(self) -> pa.Array:
        """The head words by rank."""
        return pa.array(self.words, pa.binary())

    def leaf_of_rank(self) -> np.ndarray:
        return np.array(
            [k if k < SINGLES else SINGLES + shape(w) for k, w in enumerate(self.words)], np.int32
        )

    def inside(self, leaf_of_rank: np.ndarray) -> np.ndarray:
        """log10 P(word | member) of the head words."""
        sums = np.bincount(leaf_of_rank, self.counts, minlength=LEAVES)
        return np.log10(self.counts / sums[leaf_of_rank]) if len(self.words) else np.zeros(0)

    def priors(self) -> np.ndarray:
        """Training tokens of every member."""
        sums = np.zeros(LEAVES)
        if self.words:
            sums += np.bincount(self.leaf_of_rank(), self.counts, minlength=LEAVES)
        sums[SINGLES + SHAPES :] += self.rest_tokens
        return sums


def vocabulary(counts: DataFrame, head: int = HEAD) -> tuple[Vocabulary, int]:
    """The vocabulary and the smallest count of a head word."""
    by_count = (
        counts.groupBy(F.least("c", F.lit(100_000)).alias("c"))
        .agg(F.count(F.lit(1)).alias("words"), F.sum("c").alias("tokens"))
        .collect()
    )
    sums = {r["c"]: r for r in by_count}
    least, taken = 100_001, 0
    for c in sorted(sums, reverse=True):
        if c < HEAD_COUNT or taken + sums[c]["words"] > head:
            break
        least, taken = c, taken + sums[c]["words"]
    rows = counts.filter(F.col("c") >= least).collect()
    rows.sort(key=lambda r: (-r["c"], bytes(r["word"])))
    rest = (
        counts.filter(F.col("c") < least)
        .groupBy(_shape(F.col("word")).alias("shape"))
        .agg(F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("words"))
        .collect()
    )
    tokens_, words_ = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in rest:
        tokens_[r["shape"]], words_[r["shape"]] = r["tokens"], r["words"]
    once, twice = (sums[c]["words"] if c in sums else 0 for c in (1, 2))
    known = Vocabulary(
        [bytes(r["word"]) for r in rows],
        np.array([r["c"] for r in rows], float),
        sum(r["tokens"] for r in by_count),
        sum(r["words"] for r in by_count),
        tokens_,
        words_,
        once / (once + 2 * twice) if once and twice else 0.5,
    )
    return known, least


@dataclass
class History:
    """Features of a run of tokens."""

    leaf: np.ndarray
    before: list[np.ndarray]
    pair: np.ndarray


def _history(ranks: np.ndarray, starts: np.ndarray, leaf_of_rank: np.ndarray) -> History:
    head = ranks >= 0
    leaf = np.where(head, 0, SINGLES + SHAPES + ~ranks)
    leaf[head] = leaf_of_rank[ranks[head]]
    context = np.where(head & (ranks < CONTEXTS), ranks, CONTEXTS + leaf)
    place = np.arange(len(ranks)) - np.repeat(starts, np.diff([*starts, len(ranks)]))
    before = []
    for back in range(1, REACH + 1):
        moved = np.full(len(ranks), START)
        moved[back:] = context[:-back] if back < len(ranks) else context[:0]
        moved[place < back] = START
        before.append(moved)
    pair = (before[0] * 40_503 + before[1] * 2_654_435) % 1_000_003 % PAIRS
    return History(leaf, before, pair)


class Model:
    """Weights by feature, so that a feature is looked up once, and its weights lie side by side."""

    SHAPES = (
        *(((START + 1, CLASSES),) * REACH),
        (PAIRS, CLASSES),
        *((((START + 1) * CLASSES, MEMBERS),) * REACH),
    )

    def __init__(self, priors: np.ndarray, weights: list[np.ndarray] | None = None) -> None:
        share = (priors + 0.1).reshape(CLASSES, MEMBERS)
        self.class_bias = np.log(share.sum(1) / share.sum()).astype(np.float32)
        self.member_bias = np.log(share / share.sum(1, keepdims=True)).astype(np.float32)
        self.weights = weights or [np.zeros(s, np.float32) for s in self.SHAPES]

    def features(self, h: History, some: slice) -> tuple[np.ndarray, list[np.ndarray]]:
        owner = h.leaf[some] // MEMBERS
        back = [b[some] for b in h.before]
        return owner, [*back, h.pair[some], *(b * CLASSES + owner for b in back)]

    def chances(self, owner: np.ndarray, at: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Log-chances of all classes, and of all members of the right class."""
        first = _summed(self.weights[: REACH + 1], at[: REACH + 1])
        first += self.class_bias
        second = _summed(self.weights[REACH + 1 :], at[REACH + 1 :])
        second += self.member_bias.take(owner, axis=0)
        return _log_softmax(first.T.copy()), _log_softmax(second.T.copy())

    def score(self, h: History) -> np.ndarray:
        """log10 P(member | history) of every token."""
        out = np.zeros(len(h.leaf))
        for start in range(0, len(h.leaf), SLICE):
            some = slice(start, start + SLICE)
            owner, at = self.features(h, some)
            for part in _blocks(len(owner)):
                own = owner[part]
                first, second = self.chances(own, [i[part] for i in at])
                here = np.arange(len(own))
                out[some][part] = first[own, here] + second[h.leaf[some][part] % MEMBERS, here]
        return out / math.log(10)

    def learn(self, h: History, squares: list[np.ndarray]) -> None:
        """Gradient steps over a run of tokens, each weight with its own rate.

        A step changes the weights of the features it meets only: the gradient of the others is 0.
        """
        for start in range(0, len(h.leaf), STEP):
            some = slice(start, start + STEP)
            owner, at = self.features(h, some)
            member = h.leaf[some] % MEMBERS
            errors = np.empty((CLASSES, len(owner))), np.empty((MEMBERS, len(owner)))
            for part in _blocks(len(owner)):
                logs = self.chances(owner[part], [i[part] for i in at])
                for error, x, right in zip(errors, logs, (owner[part], member[part]), strict=True):
                    np.exp(x, out=x)
                    x[right, np.arange(len(right))] -= 1
                    error[:, part] = x
            for k, (w, i, seen) in enumerate(zip(self.weights, at, squares, strict=True)):
                met = np.zeros(len(w), bool)
                met[i] = True
                met = np.flatnonzero(met)
                place = np.empty(len(w), np.intp)
                place[met] = np.arange(len(met))
                place = place[i]
                sums = np.empty((w.shape[1], len(met)))
                for row, error in zip(sums, errors[k > REACH], strict=True):
                    row[:] = np.bincount(place, error, minlength=len(met))
                for part in _blocks(len(met)):
                    g, these = sums[:, part].T.copy(), met[part]
                    squared = (seen.take(these, axis=0) + g * g).astype(np.float32)
                    seen[these] = squared
                    w[these] = w.take(these, axis=0) - RATE * g / np.sqrt(squared)


def _blocks(size: int) -> Iterator[slice]:
    """Runs of ``BLOCK``."""
    return (slice(k, min(k + BLOCK, size)) for k in range(0, size, BLOCK))


def _summed(weights: list[np.ndarray], at: list[np.ndarray]) -> np.ndarray:
    total = weights[0].take(at[0], axis=0)
    for w, i in zip(weights[1:], at[1:], strict=True):
        total += w.take(i, axis=0)
    return total


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=0)
    x -= np.log(np.exp(x).sum(axis=0))
    return x


def _lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The ``tokens`` and ends of all texts, one after another, and where each text begins."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    pieces = split.values.cast(pa.binary())
    # white space at a text's start or end leaves an empty piece
    words = pc.binary_length(pieces).to_numpy() > 0
    before = np.concatenate([[0], np.cumsum(words)])[split.offsets.to_numpy()]
    count = np.arange(len(texts))
    is_word = np.ones(before[-1] + len(texts), bool)
    is_word[before[1:] + count] = False
    pick = np.full(len(is_word), len(pieces))
    pick[is_word] = np.flatnonzero(words)
    line = pa.concat_arrays([pieces, pa.array([END], pa.binary())]).take(pa.array(pick))
    return line, before[:-1] + count


def _ranks(line: pa.Array, ranked: pa.Array) -> np.ndarray:
    """Rank of a head word; the others give the complement of their shape."""
    ranks = pc.index_in(line, value_set=ranked).fill_null(-1).to_numpy().astype(np.int64)
    other = ranks < 0
    tails = pc.binary_slice(line.filter(pa.array(other)), -3).dictionary_encode()
    shapes = np.array([shape(w) for w in tails.dictionary.to_pylist()], np.int64)
    ranks[other] = ~shapes[tails.indices.to_numpy()]
    return ranks


def _parts(texts: pa.Array, size: int = 400_000) -> Iterator[pa.Array]:
    """Slices of a batch of about so many characters of text, so that arrays stay small."""
    start, held = 0, 0
    for at, length in enumerate(pc.utf8_length(texts).fill_null(0).to_pylist()):
        held += length + 1
        if held > size * 4 or at + 1 == len(texts):
            yield texts.slice(start, at + 1 - start)
            start, held = at + 1, 0


def train(
    texts: DataFrame, known: Vocabulary, *, part: Column, rounds: int = ROUNDS,
    workers: int | None = None,
) -> Model:
    """Weights after one pass over all texts, a part of them in each round.

    ``part`` is a hash that says which round a text belongs to.  Workers' changes are averaged by
    the tokens they have seen; what reaches the driver is the sum, of a fixed size.
    """
    spark = texts.sparkSession
    model = Model(known.priors())
    workers = workers or spark.sparkContext.defaultParallelism
    shared = spark.sparkContext.broadcast(known)
    for k in range(rounds):
        now = spark.sparkContext.broadcast(model.weights)

        def run(batches, now=now):
            known = shared.value
            ranked, leaf_of_rank = known.ranked(), known.leaf_of_rank()
            own = Model(known.priors(), [w.copy() for w in now.value])
            squares = [np.ones(s, np.float32) for s in Model.SHAPES]
            seen = 0
            for batch in batches:
                for texts in _parts(batch.column(0)):
                    line, starts = _lines(texts)
                    flat = _ranks(line, ranked)
                    own.learn(_history(flat, starts, leaf_of_rank), squares)
                    seen += len(flat)
            if not seen:
                return
            change = [
                ((a - b) * 64).astype(np.float16).tobytes()
                for a, b in zip(own.weights, now.value, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(change)), pa.int32()),
                    pa.array([seen] * len(change), pa.int64()),
                    pa.array(change, pa.binary()),
                ],
                names=["block", "seen", "change"],
            )

        def add(frames):
            sums: dict[int, np.ndarray] = {}
            seen: Counter[int] = Counter()
            for frame in frames:
                for block, n, raw in zip(*(frame[c] for c in frame), strict=True):
                    own = np.frombuffer(raw, np.float16).astype(np.float64) * n
                    sums[block] = sums[block] + own if block in sums else own
                    seen[block] += n
            for block, total in sums.items():
                mean = (total / seen[block] / 64).astype(np.float32)
                yield pd.DataFrame({"block": [block], "change": [mean.tobytes()]})

        changes = (
            texts.filter(F.pmod(part, F.lit(rounds)) == k)
            .select("text")
            .coalesce(workers)
            .mapInArrow(run, "block int, seen bigint, change binary")
            .repartition("block")
            .mapInPandas(add, "block int, change binary")
            .collect()
        )
        for r in changes:
            w = model.weights[r["block"]]
            w += np.frombuffer(r["change"], np.float32).reshape(w.shape)
    return model


_FOUND = (
    "row bigint, id bigint, tokens bigint, known bigint, base double, score double, "
    "word binary, n bigint"
)


def _score(shared, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Vocabulary = shared.value
        ranked, leaf_of_rank = known.ranked(), known.leaf_of_rank()
        model = Model(known.priors(), weights.value)
        inside = known.inside(leaf_of_rank)
        base = np.log10((known.counts + 1) / (known.total + known.distinct + 1))
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            done = 0
            for texts in _parts(batch.column(1)):
                count = len(texts)
                ids = batch.column(0).slice(done, count).to_pylist()
                done += count
                line, starts = _lines(texts)
                flat = _ranks(line, ranked)
                scores = model.score(_history(flat, starts, leaf_of_rank))
                head = flat >= 0
                scores[head] += inside[flat[head]]
                bases = np.zeros(len(flat))
                bases[head] = base[flat[head]]
                sizes = np.diff([*starts, len(flat)])
                # the end of a text is a head word, but where nothing was learned
                owners = np.repeat(np.arange(row, row + count), sizes)[~head].tolist()
                tail = Counter(zip(owners, line.filter(pa.array(~head)).to_pylist(), strict=True))
                rows, rest, times = [k for k, _ in tail], [w for _, w in tail], [*tail.values()]
                more = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*range(row, row + count), *rows], pa.int64()),
                        pa.array([*ids, *[None] * more], pa.int64()),
                        pa.array([*sizes.tolist(), *[None] * more], pa.int64()),
                        pa.array(
                            [*np.add.reduceat(head, starts, dtype=np.int64).tolist(), *[None] * more],
                            pa.int64(),
                        ),
                        pa.array([*np.add.reduceat(bases, starts).tolist(), *[None] * more], pa.float64()),
                        pa.array([*np.add.reduceat(scores, starts).tolist(), *[None] * more], pa.float64()),
                        pa.array([*[None] * count, *rest], pa.binary()),
                        pa.array([*[None] * count, *times], pa.int64()),
                    ],
                    names=[f.split()[0] for f in _FOUND.split(", ")],
                )
                row += count

    return run


def score(
    docs: DataFrame,
    *,
    train_rows: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    head: int = HEAD,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Every row's score under a model learned from the rows of ``train_rows``.

    Returns id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (unigrams with
    add-one) and ``score``, both log10 of the text's probability.  Null and empty texts are the
    end token alone.  Whole texts are counted, learned and scored, however long.  Rows that repeat
    an id are scored each; a null id is held out by default.  Without any training row every
    token is unknown.  An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    short_batches(spark)
    learned = ~held_out(F.col(id_col)) if train_rows is None else F.coalesce(train_rows, F.lit(False))
    text = F.col(text_col).cast("string").alias("text")
    texts = docs.filter(learned).select(text, F.col(id_col).alias("id"))
    counts = settle(count_words(texts.select("text")))
    known, least = vocabulary(counts, head)
    model = train(texts, known, part=F.xxhash64("id", F.lit(1)), rounds=rounds)
    sent = spark.sparkContext.broadcast(known), spark.sparkContext.broadcast(model.weights)
    found = settle(
        docs.select(F.col(id_col).cast("bigint").alias("id"), text).mapInArrow(_score(*sent), _FOUND)
    )

    d, whole = known.discount, known.total + known.distinct + 1
    unknown = [
        math.log10(d * w / t) if t else 0.0
        for w, t in zip(known.rest_words, known.rest_tokens, strict=True)
    ]
    sizes = [math.log10(t) if t else 0.0 for t in known.rest_tokens]
    by_shape = lambda values: F.element_at(
        F.array(*(F.lit(float(v)) for v in values)), _shape(F.col("word")) + 1
    )
    c = F.coalesce("c", F.lit(0))
    rest = (
        found.filter("word IS NOT NULL")
        .select("row", "word", "n")
        .join(counts.filter(F.col("c") < least), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more_known"),
            F.sum(F.col("n") * F.log10((c + 1) / F.lit(float(whole)))).alias("more_base"),
            F.sum(
                F.col("n")
                * F.when(c > 0, F.log10(c - F.lit(d)) - by_shape(sizes)).otherwise(by_shape(unknown))
            ).alias("more_score"),
        )
    )
    return (
        found.filter("word IS NULL")
        .select("row", "id", "tokens", "known", "base", "score")
        .join(rest, "row", "left")
        .select(
            F.col("id").alias(id_col),
            held_out(F.col("id")).alias("held_out"),
            F.col("tokens").alias("n_tokens"),
            (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(known.total).cast("bigint").alias("train_tokens"),
            (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
            (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
        )
    )


QUERY = "op1_lm_scoring"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: all ``documents``, learned from six folds of seven."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
