"""Language identification with string kernels.

Method: a text is the set of its byte n-grams of 2 to 4 bytes (A-Z in lower case, digits and ASCII punctuation as one
byte), hashed to 2**20 slots: a blended-spectrum presence kernel counts the slots that two texts share,
divided by the geometric mean of their own counts. Landmarks are some labelled texts; their kernel matrix gives
the Nystroem features, on which one ridge regression per language is fitted against the rest. Scoring is one matrix product
for many texts: presence of the landmarks' slots times landmark membership gives all kernel values at once.

The classifier is fitted on at most ``SAMPLE`` labelled rows per language and ``LANDMARKS`` of them as landmarks (both documented
bounds), chosen by a hash of their text, not by place. Only their slots, never texts, come to the driver. Predictions read every
whole text once; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fogline.llm.batches import slices, texts
from fogline.llm.words import utf8

SIZES = (2, 3, 4)
SLOT_BITS = 20
SAMPLE, LANDMARKS = 200, 24
RIDGE = 1e-2
#: Parts in which the rows of one language are ranked first.
PARTS = 8
#: How sharply the distance between languages turns into a score.
SHARPNESS = 6.0
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] = _FOLD[97:123]
_FOLD[[*range(33, 65), *range(91, 97), *range(123, 127)]] = ord("-")
_FOLD[list(b"\t\n\x0b\x0c\r")] = ord(" ")
_ODD = {2: np.uint32(0x9E3779B1), 3: np.uint32(0x85EBCA77), 4: np.uint32(0xC2B2AE3D)}
_LETTER = re.compile(r"[^\W\d_]")


def slots(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the slot at each byte, and whether an n-gram of one text begins there."""
    bytes_ = _FOLD[data].astype(np.uint32)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    code = bytes_.copy()
    for size in range(2, max(SIZES) + 1):
        more = np.zeros_like(code)
        more[: len(code) - size + 1] = bytes_[size - 1 :]
        code = (code << np.uint32(8)) | more
        if size in SIZES:
            with np.errstate(over="ignore"):
                mixed = (code ^ (code >> np.uint32(15))) * _ODD[size]
            yield (mixed >> np.uint32(32 - SLOT_BITS)).astype(np.int32), left >= size


@dataclass
class Model:
    languages: list[str]
    #: Slots of any landmark in order, which landmarks have each, and how many slots each landmark has.
    known: np.ndarray
    member: np.ndarray
    own: np.ndarray
    weights: np.ndarray

    def presence(self, column: pa.Array) -> np.ndarray:
        """Texts times known slots, 1 where the text has the slot."""
        data, offsets = utf8(column)
        place = np.full(1 << SLOT_BITS, -1, np.int32)
        place[self.known] = np.arange(len(self.known))
        found = np.zeros((len(column), len(self.known)), bool)
        flat = found.ravel()
        base = np.repeat(np.arange(len(column), dtype=np.int64) * len(self.known), np.diff(offsets))
        for slot, valid in slots(data, offsets):
            at = place[slot]
            hit = valid & (at >= 0)
            flat[base[hit] + at[hit]] = True
        return found

    def kernel(self, found: np.ndarray) -> np.ndarray:
        """Normalised kernel values with the landmarks."""
        count = found.sum(axis=1).astype(np.float32)
        both = found.astype(np.float32) @ self.member
        return both / np.maximum(np.sqrt(count[:, None] * self.own[None, :]), 1)

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Best language (its number) of each text and a score from 0 to 1."""
        margin = self.kernel(self.presence(column)) @ self.weights
        shown = np.exp(SHARPNESS * (margin - margin.max(axis=1, keepdims=True)))
        shown /= shown.sum(axis=1, keepdims=True)
        best = margin.argmax(axis=1)
        return best, shown[np.arange(len(best)), best].astype(np.float64)


def fit(labels: list[str], sets: list[np.ndarray], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """A model of labelled slot sets, in the given order; the first ``landmarks`` of each language are landmarks."""
    languages = sorted(set(labels))
    chosen = [i for lang in languages for i in [k for k, x in enumerate(labels) if x == lang][:landmarks]]
    known = np.unique(np.concatenate([np.zeros(0, np.int64), *(sets[i] for i in chosen)])).astype(np.int64)
    has = np.zeros((len(sets), len(known)), np.float32)
    for row, s in enumerate(sets):
        at = np.searchsorted(known, s)
        ok = (at < len(known)) & (known[np.minimum(at, max(len(known) - 1, 0))] == s) if len(known) else np.zeros(len(s), bool)
        has[row, at[ok]] = 1
    member = np.ascontiguousarray(has[chosen].T)
    own = member.sum(axis=0)
    model = Model(languages, known, member, own, np.zeros((len(chosen), len(languages)), np.float32))
    k_landmarks = model.kernel(has[chosen].astype(bool)).astype(np.float64)
    values, vectors = np.linalg.eigh((k_landmarks + k_landmarks.T) / 2)
    keep = values > 1e-6 * max(values.max(initial=0), 1e-12)
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = model.kernel(has.astype(bool)).astype(np.float64) @ root
    wanted = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # Languages count alike however many samples each has.
    share = np.array([1.0 / labels.count(x) for x in labels])[:, None]
    fitted = np.linalg.solve(features.T @ (share * features) + ridge * np.eye(features.shape[1]), features.T @ (share * wanted))
    model.weights = (root @ fitted).astype(np.float32)
    return model


def learn(docs: DataFrame, may_learn: Column, sample: int = SAMPLE) -> Model | None:
    """A model of the rows of ``docs`` (text, lang) where ``may_learn`` holds, text has a letter and lang is known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, offsets = utf8(part.column("text"))
                found = [np.zeros(0, np.int64)] * len(part)
                pieces = [(s[v], np.repeat(np.arange(len(part)), np.diff(offsets))[v]) for s, v in slots(data, offsets)]
                slot, of = (np.concatenate(x) for x in zip(*pieces))
                pair = np.unique(of.astype(np.int64) << SLOT_BITS | slot)
                cuts = np.searchsorted(pair >> SLOT_BITS, np.arange(len(part) + 1))
                found = [(pair[a:b] & ((1 << SLOT_BITS) - 1)).astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("drawn"), pa.array(found, pa.list_(pa.int32()))], ["lang", "drawn", "slots"]
                )

    labelled = docs.where(may_learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64("text").alias("drawn")
    )
    # Copies of a text count once. Only hashes are ranked; the chosen texts are found by a join on them.
    # In two steps, so that a language with most of the rows is first ranked in parts.
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("drawn"))
    parts = labelled.select("lang", "drawn").distinct().withColumn("part", F.pmod("drawn", F.lit(PARTS)))
    for by in (("lang", "part"), ("lang",)):
        parts = parts.withColumn("place", rank(*by)).where(F.col("place") <= sample)
    first = parts.select("lang", "drawn")
    chosen = labelled.join(first, ["lang", "drawn"], "left_semi").mapInArrow(run, "lang string, drawn long, slots array<int>")
    rows = sorted(chosen.dropDuplicates(["lang", "drawn"]).toLocalIterator(), key=lambda r: (r["lang"], r["drawn"]))
    if not rows:
        return None
    return fit([r["lang"] for r in rows], [np.array(r["slots"], np.int64) for r in rows])


def predict_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``.

    ``und`` with score 0 where the text is NULL or has no letter, or where nothing could be learned. Whole texts count. Equal
    texts get equal results; other columns are ignored.
    """
    state = docs.sparkSession.sparkContext.broadcast(None if model is None else vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = None if state.value is None else Model(**state.value)
        for batch in batches:
            for part in slices(batch, limit=1 << 20, rows=512):
                lang, score = [UNKNOWN] * len(part), np.zeros(len(part))
                if ready is not None:
                    best, score = ready.predict(part.column("text"))
                    letters = np.array([_LETTER.search(t) is not None for t in texts(part)])
                    lang = [ready.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters)]
                    score = np.where(letters, score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"]
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
