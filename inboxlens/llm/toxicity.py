"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding maps every character to one character, so places in the folded and the raw text agree:
homoglyphs, accents and full-width forms to plain letters, digits and signs to the letters they
stand for.  The lexicon, its weights and its exception phrases are counted from labelled rows;
a match inside an exception phrase does not count.  Two features, the weight of the different
words matched and the same per hundred words, give the score by logistic regression.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inboxlens.llm.common import fresh, settle, short_batches

#: Signs that stand for letters inside a word.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
          "!": "i"}
#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m",
    "н": "h", "о": "o", "р": "p", "ѕ": "s", "с": "c", "т": "t", "у": "y", "х": "x", "ԁ": "d",
    "ɡ": "g", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ß": "s", "ø": "o", "ł": "l", "đ": "d", "æ": "a", "œ": "o",
}
#: Harmless phrases around words that are often abuse.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pond scum")
#: Odds of the toxic label that a word must at least multiply, beyond chance, to be kept.
MIN_ODDS = 2.0
#: Words added in one round have at least this share of the evidence of the round's best word.
ROUND_SHARE = 0.5
#: Default bounds on the lexicon and its exception phrases (the best by evidence), which are held
#: by the driver and every task; ``learn`` and ``score`` take others.
MOST_WORDS, MOST_EXCEPTIONS = 100_000, 20_000
#: Folds of crc32(id) whose labels are never learned from.
FOLDS, HELD_OUT = 5, 0
#: Distinct words a task counts before it hands its sums on.
FLUSH = 300_000


def _fold_table() -> dict[int, str]:
    table: dict[int, str] = {}
    # Latin letters with marks, letter-like and full-width forms: their base letter by NFKD
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)):
        base = unicodedata.normalize("NFKD", chr(code))[0].lower()
        if base.isascii():
            table[code] = DIGITS.get(base, base)
    for look, letter in HOMOGLYPHS.items():
        table[ord(look)] = letter
        if len(look.upper()) == 1:
            table[ord(look.upper())] = letter
    for sign, letter in DIGITS.items():
        table[ord(sign)] = letter
    for code in range(ord("A"), ord("Z") + 1):
        table[code] = chr(code).lower()
    return table


FOLD = _fold_table()
#: A word: letters and digits, with signs between them.
WORD = re.compile(r"[^\W_]+(?:[@$!]+[^\W_]+)*")


def fold(text: str) -> str:
    """The text with every character folded; as long as before."""
    return text.translate(FOLD)


def words(text: str) -> list[str]:
    return [fold(w) for w in WORD.findall(text)]


@dataclass
class Lexicon:
    """Folded words with weights, and phrases (folded, single blanks) that excuse them."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), 0.0, True))
        for word, weight in self.weights.items():
            if word not in self.exceptions:
                found.add_word(word, (len(word), weight, False))
        if not len(found):
            return None
        found.make_automaton()
        return found


def matches(automaton, text: str) -> Iterator[tuple[int, int, float]]:
    """``(start, end, weight)`` of whole words outside exception phrases, in order."""
    if automaton is None or not text:
        return
    hits, excused = [], []
    last = len(text)
    for at, (size, weight, excuse) in automaton.iter(fold(text)):
        start, end = at - size + 1, at + 1
        # raw signs end a word, raw letters and digits go on with it
        if start and text[start - 1].isalnum() or end < last and text[end].isalnum():
            continue
        (excused if excuse else hits).append((start, end, weight))
    excused.sort()
    starts, ends = [a for a, _, _ in excused], []
    for _, b, _ in excused:
        ends.append(max(b, ends[-1]) if ends else b)
    for start, end, weight in hits:
        before = bisect_right(starts, start)
        # of the phrases that begin in time, does the one that goes furthest cover the word?
        if not before or ends[before - 1] < end:
            yield start, end, weight


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Training rows only: ``(text, toxic)``.  Contradicting labels of an id count as toxic."""
    told = (
        labels.filter(F.col("toxic").isNotNull() & _training(F.col(id_col)))
        .groupBy(F.col(id_col).alias("labelled"))
        .agg((F.max("toxic") > 0).alias("toxic"))
    )
    rows = docs.filter(_training(F.col(id_col))).select(
        F.col(id_col).alias("labelled"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    # sorted and merged at every size: the labels grow with the documents, so the plan is not to
    # change where they outgrow a broadcast; written, as two passes read the labelled texts
    return settle(rows.join(told.hint("merge"), "labelled").select("text", "toxic"))


def held_out(ident: Column) -> Column:
    """Whether a row is held out: crc32 of the id as text leaves ``HELD_OUT``; a null id is."""
    return F.coalesce(F.pmod(F.crc32(ident.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT,
                      F.lit(True))


def _training(ident: Column) -> Column:
    return ~held_out(ident)


def _tally(keys_of: Callable[[str], set[str]], name: str) -> Callable:
    """Documents with a key, by label, counted in the task before anything is handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: dict[str, int] = {}
        clean: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            keys = list(toxic.keys() | clean.keys())
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.string()),
                    pa.array([toxic.get(k, 0) for k in keys], pa.int64()),
                    pa.array([clean.get(k, 0) for k in keys], pa.int64()),
                ],
                names=[name, "toxic", "clean"],
            )
            toxic.clear()
            clean.clear()
            return made

        for batch in batches:
            for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                side = toxic if label else clean
                for key in keys_of(text):
                    side[key] = side.get(key, 0) + 1
            if len(toxic) + len(clean) > FLUSH:
                yield out()
        yield out()

    return run


def _counted(rows: DataFrame, keys_of: Callable[[str], set[str]], name: str) -> DataFrame:
    return (
        rows.mapInArrow(_tally(keys_of, name), f"{name} string, toxic bigint, clean bigint")
        .groupBy(name)
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def _uncovered(kept: set[str]) -> Callable[[str], set[str]]:
    """The words of a text that holds none of the kept ones; the empty word counts the text."""

    def keys_of(text: str) -> set[str]:
        found = {"", *words(text)}
        return set() if found & kept else found

    return keys_of


def _evidence(toxic: Column, clean: Column, share: float) -> Column:
    """Log-likelihood ratio of the word's own toxic share against a given one."""
    n = toxic + clean
    part = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    return part(toxic, share) + part(clean, 1 - share)


def _added(rows: DataFrame, kept: set[str], min_odds: float, most: int) -> list:
    """The words of one round of :func:`learn`: ``(word, weight, clean)``."""
    counts = settle(_counted(rows, _uncovered(kept), "word"))
    totals = counts.filter("word = ''").first()
    if not totals or not totals["toxic"] or not totals["clean"]:
        return []
    all_toxic, all_clean = totals["toxic"], totals["clean"]
    bar = math.log(2 * counts.count())
    # the toxic share among documents with a word that multiplies the odds by just the least
    share = min_odds * all_toxic / (min_odds * all_toxic + all_clean)
    toxic, clean = F.col("toxic"), F.col("clean")
    weight = F.log((toxic + 0.5) / (all_toxic + 1.0)) - F.log((clean + 0.5) / (all_clean + 1.0))
    good = (
        counts.filter("length(word) >= 3 AND toxic > 0")
        .filter(toxic / (toxic + clean) > share)
        .withColumn("evidence", _evidence(toxic, clean, share))
        .filter(F.col("evidence") > bar)
    )
    best = good.agg(F.max("evidence")).first()[0]
    if best is None:
        return []
    return (
        good.filter(F.col("evidence") >= best * ROUND_SHARE)
        .withColumn("weight", weight)
        .orderBy(F.desc("evidence"), "word")
        .limit(most)
        .select("word", "weight", "clean")
        .collect()
    )


def learn(
    rows: DataFrame,
    exceptions: tuple[str, ...] = EXCEPTIONS,
    *,
    min_odds: float = MIN_ODDS,
    most_words: int = MOST_WORDS,
    most_exceptions: int = MOST_EXCEPTIONS,
) -> Lexicon:
    """The words of labelled ``rows(text, toxic)`` that raise the odds of the toxic label, with log-odds as weights.

    A word qualifies when documents with it are toxic more often than ``min_odds`` times the
    overall odds explain, with evidence beyond that of the luckiest among all words counted
    (Bonferroni), so the bar rises with the vocabulary.  Words are added in rounds, the ones with
    most evidence first; the next round counts only documents that hold no word kept so far.  Plain
    words that a group of copies shares with an insult are thereby explained by the insult and stay
    out, however many copies there are.  The best evidence about halves from round to round, so
    there are few.  Only words that qualify reach the driver, at most ``most_words`` of them.
    Without labels of both kinds the lexicon is empty.
    """
    weights: dict[str, float] = {}
    mixed: set[str] = set()
    while len(weights) < most_words:
        added = _added(rows, set(weights), min_odds, most_words - len(weights))
        if not added:
            break
        weights |= {r["word"]: r["weight"] for r in added}
        mixed |= {r["word"] for r in added if r["clean"]}
    phrases = frozenset(map(_phrase, exceptions))
    if mixed:
        phrases |= _learn_exceptions(rows, mixed, most_exceptions)
    return Lexicon(weights, phrases if weights else frozenset())


def _phrase(text: str) -> str:
    return " ".join(fold(text).split())


def _learn_exceptions(rows: DataFrame, mixed: set[str], most: int) -> frozenset[str]:
    """Pairs of neighbours around a word of ``mixed`` that clean documents have and toxic ones lack."""

    def near(text: str) -> set[str]:
        found = words(text)
        return {
            f"{a} {b}" for a, b in zip(found, found[1:], strict=False) if a in mixed or b in mixed
        }

    best = (
        _counted(rows, near, "phrase")
        .filter("clean >= 5 AND toxic * 20 <= clean")
        .orderBy(F.desc("clean"), "phrase")
        .limit(most)
        .collect()
    )
    return frozenset(r["phrase"] for r in best)


def weigh(docs: DataFrame, lexicon: Lexicon, text_col: str, keep: list[str]) -> DataFrame:
    """The kept columns with ``hits``, ``weight`` and ``n_words`` of each whole text.

    ``hits`` counts all matches; in ``weight`` a word counts once, however often it is repeated.
    """
    hits, weight, n_words = (fresh(docs, c) for c in ("hits", "weight", "n_words"))
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found, sums, sizes = [], [], []
            for text in batch.column(0).to_pylist():
                each = [(fold(text[a:b]), w) for a, b, w in matches(automaton, text or "")]
                found.append(len(each))
                sums.append(math.fsum(sorted(dict(each).values())))
                sizes.append((text or "").count(" ") + (text or "").count("\n") + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array(found, pa.int64()),
                    pa.array(sums, pa.float64()),
                    pa.array(sizes, pa.int64()),
                ],
                names=[*keep, hits, weight, n_words],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    schema = f"{kinds}, `{hits}` bigint, `{weight}` double, `{n_words}` bigint"
    text = F.col(text_col).cast("string").alias(fresh(docs, "whole_text"))
    return docs.select(text, *keep).mapInArrow(run, schema)


def _features(weight: Column, n_words: Column) -> tuple[Column, Column]:
    return F.log1p(weight), F.log1p(weight * 100.0 / F.greatest(n_words, F.lit(1)))


def calibrate(weighed: DataFrame) -> list[float]:
    """Coefficients of the logistic regression, from all labelled rows ``(toxic, weight, n_words)``.

    The rows are summed by features rounded to a twentieth, so the driver gets a small table of
    counts, whatever the number of rows.
    """
    f1, f2 = _features(F.col("weight"), F.col("n_words"))
    cells = (
        weighed.groupBy(F.round(f1 * 20).alias("a"), F.round(f2 * 20).alias("b"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("toxic").cast("int")).alias("toxic"))
        .collect()
    )
    if not cells:
        return [-3.0, 0.0, 0.0]
    x = np.array([[1.0, r["a"] / 20, r["b"] / 20] for r in sorted(cells)])
    n = np.array([r["n"] for r in sorted(cells)], float)
    y = np.array([r["toxic"] for r in sorted(cells)], float)
    beta = np.zeros(3)
    ridge = np.diag([1e-6, 0.05, 0.05])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - n * p) - ridge @ beta
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        beta += step * min(1.0, 4.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    # without matches nothing speaks for toxicity, and more weight never speaks against it
    return [min(-0.05, float(beta[0])), max(0.0, float(beta[1])), max(0.0, float(beta[2]))]


def score(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> DataFrame:
    """Every row's kept columns (all by default) with ``score``, ``predicted``, ``held_out``.

    Also ``hits``, ``weight`` and ``n_words``; a clashing name gets underscores in front.  Null and empty texts have no
    match and get the score of a text without any.  Whole texts are matched, however long.
    Rows that repeat an id are scored each by its own text; a null id is held out.  Labels of
    null are ignored, contradicting ones count as toxic.  An empty table gives no rows; without
    labels of both kinds every score is that of the prior, under 0.5.
    """
    kept = [id_col, *(c for c in (keep or docs.columns) if c != id_col)]
    short_batches(docs.sparkSession)
    rows = _labelled(docs, labels, id_col, text_col)
    lexicon = learn(rows, exceptions)
    beta = calibrate(weigh(rows, lexicon, "text", ["toxic"]))
    weighed = weigh(docs, lexicon, text_col, kept)
    hits, weight, n_words = weighed.columns[-3:]
    f1, f2 = _features(F.col(weight), F.col(n_words))
    margin = F.lit(beta[0]) + F.lit(beta[1]) * f1 + F.lit(beta[2]) * f2
    chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return weighed.select(
        *kept,
        held_out(F.col(id_col)).alias(fresh(docs, "held_out")),
        chance.alias(fresh(docs, "score")),
        (chance >= 0.5).cast("int").alias(fresh(docs, "predicted")),
        hits, weight, n_words,
    )


def keep_clean(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The input's rows and columns without those predicted toxic."""
    scored = score(docs, labels, id_col=id_col, text_col=text_col)
    return scored.filter(F.col(fresh(docs, "predicted")) == 0).select(*docs.columns)


QUERY = "op10_toxicity"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: every whole text of ``documents``, learned from the training labels."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, labels, keep=["doc_id"]).select(
        "doc_id", "held_out", "score", "predicted", "hits", "n_words"
    )
