"""Toxicity by a weighted lexicon.

Method: texts are folded (lower case, homoglyphs, digits and signs that stand for letters) to their words. One
Aho-Corasick automaton holds the lexicon (words and beginnings of words, with weights) and phrases that are exceptions;
a hit inside an exception does not count. The weight of a document's hits and that weight per hundred words give
its score through a logistic curve.

The lexicon is learned: terms of toxic training documents, weighted by the logarithm of how much more often toxic documents hold
them. Learning takes at most ``SAMPLE`` labelled rows of each label (a documented bound), chosen by a hash, so that the
documents to read are found by a broadcast of bounded size. A term must be in at least ``SUPPORT`` of the toxic ones, so
there are at most 1 / SUPPORT times as many terms as a document has on average. Scoring reads every whole text once and shuffles nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fogline.llm.batches import slices, texts, tidied

SAMPLE = 10_000
#: Different terms that a task counts before it hands them on.
COUNTED = 1 << 17
SUPPORT, LEAST_DOCS = 0.005, 3
#: A term's weight is the log ratio of the two rates; smaller ones are left out.
LEAST_WEIGHT = 2.5
#: Beginnings of words of these lengths, and whole words of up to the last length, can be terms.
PREFIXES, LONGEST = (4, 5, 6, 7), 14
#: Documents that score this or more are toxic.
THRESHOLD = 0.7

#: Letters of other scripts that look like Latin ones, and signs that stand for letters.
HOMOGLYPHS = dict(zip("абвгезиікмнорстухѕјԁԛԝαβγεικνορτυχω", "abbreзиikmнopctyxsjdqwabyeikvoptuxw"))
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}
#: Phrases in which a term is harmless.
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "pond scum")

_TABLE = str.maketrans(HOMOGLYPHS)
_SIGN = re.compile(r"[013457@$!|]{1,2}(?=[^\W\d_])")
_WORD = re.compile(r"[^\W\d_]+")


def folded_words(text: str) -> list[str]:
    """Words of a text in lower case without disguise. Signs count as letters only before a letter."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(_TABLE)
    return _WORD.findall(_SIGN.sub(lambda m: "".join(DIGITS[c] for c in m[0]), text))


def terms_of(text: str) -> set[str]:
    """Terms of a text: a space and the beginning of a word, or a space, a word and a space."""
    found = set()
    for word in set(folded_words(text)):
        if len(word) <= LONGEST:
            found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in PREFIXES if len(word) >= n)
    return found


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    #: Intercept and factors of the logistic curve.
    curve: tuple[float, float, float] = (-3.0, 1.0, 1.0)
    _automaton: object = field(default=None, repr=False)

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            built = ahocorasick.Automaton()
            for phrase in self.exceptions:
                key = f" {' '.join(folded_words(phrase))} "
                built.add_word(key, (len(key), None))
            for term, weight in self.weights.items():
                built.add_word(term, (len(term), weight))
            built.make_automaton()
            self._automaton = built
        return self._automaton

    def hits(self, text: str) -> tuple[float, int]:
        """Weight of the hits and number of words. A word counts once, with its heaviest term."""
        words = folded_words(text)
        if not words or not self.weights:
            return 0.0, len(words)
        line = f" {' '.join(words)} "
        best: dict[int, float] = {}
        spared = []
        for end, (size, weight) in self.automaton().iter(line):
            start = end - size + 1
            if weight is None:
                spared.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if spared:
            best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in spared)}
        return sum(best.values()), len(words)

    def features(self, text: str) -> tuple[float, float]:
        weight, words = self.hits(text)
        return math.log1p(weight), math.log1p(100.0 * weight / max(words, 1))

    def score(self, text: str) -> float:
        a, b, c = self.curve
        x, y = self.features(text)
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; x: features, first column ones; y: 0 or 1."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def choose_terms(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Weights of the terms worth keeping; longer beginnings that add nothing to a shorter one are left out."""
    weights = {}
    for term in sorted(toxic, key=lambda t: (len(t), t)):
        weight = math.log((toxic[term] + 0.5) / (n_toxic + 1)) - math.log((clean.get(term, 0) + 0.5) / (n_clean + 1))
        # What chance alone could give a rare term is taken off.
        weight -= 1.0 / math.sqrt(toxic[term])
        shorter = [weights[term[:n]] for n in range(PREFIXES[0] + 1, len(term)) if term[:n] in weights]
        if weight >= LEAST_WEIGHT and (not shorter or weight > max(shorter) + 1.0):
            weights[term] = weight
    return weights


def _count_terms(read: DataFrame, wanted: set[str] | None) -> DataFrame:
    """(term, n): documents per term; only ``wanted`` terms if given."""
    known = None if wanted is None else read.sparkSession.sparkContext.broadcast(wanted)

    def as_batch(count: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["term", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                count: Counter = Counter()
                for text in texts(part):
                    found = terms_of(text)
                    count.update(found if known is None else found & known.value)
                    if len(count) >= COUNTED:
                        yield as_batch(count)
                        count.clear()
                yield as_batch(count)

    return read.select("text").mapInArrow(tidied(run), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, labels: DataFrame, may_learn: Column, sample: int = SAMPLE) -> Lexicon:
    """A lexicon from the rows of ``labels`` (doc_id, toxic) where ``may_learn`` holds and their texts.

    Labels other than 0 and 1, and rows without doc_id, are left out; several labels of a document count one by one.
    Without toxic or without clean documents nothing is learned and every score is low.
    """
    usable = labels.where(may_learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("toxic")
    )
    # A threshold on a hash leaves about twice the sample of each label; only those are ranked. Two rows of counts.
    counts = F.broadcast(usable.groupBy("toxic").agg(F.count("*").alias("all")))
    drawn = F.pmod(F.xxhash64("__id"), F.lit(1 << 30))
    few = usable.join(counts, "toxic").where(drawn < F.lit(2.0 * sample) / F.col("all") * (1 << 30))
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy(drawn, "__id"))
    chosen = few.withColumn("place", rank).where(F.col("place") <= sample).select("__id", "toxic")
    # At most 2 * sample rows of two numbers.
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    sizes = dict(read.groupBy("toxic").count().toLocalIterator())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({})
    least = max(LEAST_DOCS, math.ceil(SUPPORT * n_toxic))
    toxic = dict(_count_terms(read.where("toxic = 1"), None).where(F.col("n") >= least).toLocalIterator())
    clean = dict(_count_terms(read.where("toxic = 0"), set(toxic)).toLocalIterator())
    lexicon = Lexicon(choose_terms(toxic, clean, n_toxic, n_clean))
    rows = [(r["x"], r["y"], r["toxic"]) for r in _features(read, lexicon).toLocalIterator()]
    data = np.array(rows, float)
    x = np.column_stack([np.ones(len(data)), data[:, :2]])
    lexicon.curve = tuple(float(v) for v in fit_curve(x, data[:, 2]))
    return lexicon


def _plain(lexicon: Lexicon) -> dict:
    return {"weights": lexicon.weights, "exceptions": lexicon.exceptions, "curve": lexicon.curve}


def _features(read: DataFrame, lexicon: Lexicon) -> DataFrame:
    state = read.sparkSession.sparkContext.broadcast(_plain(lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Lexicon(**state.value)
        for batch in batches:
            found = np.array([ready.features(t) for t in texts(batch)], float).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy()), batch.column("toxic")], ["x", "y", "toxic"]
            )

    return read.select("text", "toxic").mapInArrow(tidied(run), "x double, y double, toxic int")


def score_toxicity(docs: DataFrame, lexicon: Lexicon, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every row of ``docs`` as doc_id, the ``carry`` columns, score (0 to 1), predicted (1 from ``THRESHOLD`` on, else 0).

    NULL and empty texts have no hits and the score of a text without any. Equal texts get equal scores. Other columns are
    ignored unless carried.
    """
    state = docs.sparkSession.sparkContext.broadcast(_plain(lexicon))
    names = ["doc_id", *carry]
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c) for c in carry), *(["text"] if "text" not in carry else []))
    schema = ", ".join(f"`{n}` {read.schema[n].dataType.simpleString()}" for n in names) + ", score double, predicted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Lexicon(**state.value)
        for batch in batches:
            for part in slices(batch):
                score = np.array([ready.score(t) for t in texts(part)], float)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                    [*names, "score", "predicted"],
                )

    return read.mapInArrow(tidied(run), schema)
