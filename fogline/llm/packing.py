"""Packing of documents into sequences by best-two-fit.

Method: a sequence is filled greedily with the longest piece that still fits. When nothing fits, its smallest piece
is exchanged for the two unpacked pieces that together fill the wider gap best, if they fill it better than the piece did.

Pieces of one length are alike, so the choices need the number of pieces per length and nothing else: at most
``capacity`` numbers, whatever the number of documents. As long as every length it uses lasts, the same choices give the
same sequence, so a sequence is planned once together with its number of repeats; each plan uses up a length or
what a sequence takes of it, and plans stay few. A piece then finds its place by its rank among the pieces of its length.

Scale: texts are encoded once, each distinct word of a slice at most once; pieces (two bytes a token) are pinned by a checkpoint with their rank among equal lengths of
their task. Counts per task and length, added up over tasks, turn this into a rank over all. No window or group spans the
pieces of a length. The plan is broadcast: one row per length in a planned sequence, bounded by the capacity.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fogline.llm.batches import slices, tidied
from fogline.session import cut_lineage

#: Texts are encoded in slices of about this many bytes, new words so many at a time or as one text; a worker remembers so many words.
TEXT_BYTES, WORDS, TOGETHER, REMEMBERED = 8 << 20, 1 << 12, 1 << 8, 1 << 19
ID_BYTES = array("I").itemsize
#: Pieces of one task and length that are dealt to one place.
TOGETHER_PIECES = 128

#: Words whose letters all lie below U+0100 have one normal form, and are the same in lower case.
_PLAIN = r"^[\x{00}-\x{ff}]*$"
#: A token never holds a letter or digit and the mark after it.
_MARKS = r"([A-Za-z0-9\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}])([.,;:!?]+)$"


class WordEncoder:
    """Token ids of texts by a vocabulary in lower case that never lets a token cross a space, a line feed or the end of a run of letters.

    Such a vocabulary gives a text the ids of its words one after the other, so each distinct word is encoded once, and a
    word with marks at its end as the word and the marks. Words that could name a special token are taken as they are.
    """

    def __init__(self, vocabulary: str):
        self.vocabulary, self.tokenizer = vocabulary, None
        self.known: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each text); NULL is empty."""
        return self._joined(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), self._words)

    def _joined(self, texts: pa.Array, encode) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts from those of their distinct words."""
        words = pc.split_pattern(texts, " ")
        flat = words.flatten().dictionary_encode()
        every, size = encode(flat.dictionary)
        code = flat.indices.to_numpy(zero_copy_only=False)
        n = size[code]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        # The step from one id to the next is 1 but at the start of a word.
        first = (np.cumsum(size) - size)[code]
        filled = np.flatnonzero(n)
        at = np.ones(total, np.int64)
        if total:
            at[(ends - n)[filled]] = first[filled] - np.concatenate([[0], (first + n)[filled][:-1] - 1])
            at = np.cumsum(at, out=at)
        borders = np.concatenate([[0], ends])[words.offsets.to_numpy(zero_copy_only=False) - words.offsets[0].as_py()]
        return every[at] if total else np.zeros(0, np.uint32), np.diff(borders)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.and_(pc.match_substring_regex(words, _PLAIN), pc.invert(pc.match_substring(words, "<|")))
        parted = pc.replace_substring_regex(pc.utf8_lower(words), _MARKS, r"\1 \2")
        return self._joined(pc.if_else(plain, parted, words), self._distinct)

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        listed = words.to_pylist()
        ids = list(map(self.known.get, listed))
        missing = [i for i, found in enumerate(ids) if found is None]
        # Words of letters only are one unit each, so many of them can be encoded as one text and told apart again.
        letters = [i for i in missing if listed[i].isalpha()]
        for at in range(0, len(letters), TOGETHER):
            part = letters[at : at + TOGETHER]
            found = self._tokenizer().encode(" ".join([listed[i] for i in part]), add_special_tokens=False)
            size = np.bincount(np.array(found.word_ids, np.int64)) if found.ids else np.zeros(0, np.int64)
            if len(size) != len(part) or not size.all():
                continue
            every = array("I", found.ids).tobytes()
            ends = (np.cumsum(size) * ID_BYTES).tolist()
            for i, start, end in zip(part, [0, *ends], ends):
                ids[i] = every[start:end]
        others = [i for i in missing if ids[i] is None]
        for at in range(0, len(others), WORDS):
            part = others[at : at + WORDS]
            for i, found in zip(part, self._tokenizer().encode_batch_fast([listed[i] for i in part], add_special_tokens=False)):
                ids[i] = array("I", found.ids).tobytes()
        room = REMEMBERED - len(self.known)
        self.known.update((listed[i], ids[i]) for i in missing[: max(room, 0)])
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // ID_BYTES
        return np.frombuffer(b"".join(ids), np.uint32), size

    def _tokenizer(self):
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.vocabulary)
        return self.tokenizer


def plan_sequences(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(repeats, [(length, pieces of it)]) of all sequences for ``counts`` pieces of each length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    plans = []
    lengths = np.flatnonzero(left)
    while len(lengths):
        used: dict[int, int] = {}
        gap, at = capacity, len(lengths)
        while True:
            at = min(at, int(np.searchsorted(lengths, gap, "right"))) - 1
            if at < 0:
                break
            length = int(lengths[at])
            used[length] = min(int(left[length]), gap // length)
            gap -= length * used[length]
        smallest = min(used)
        if gap and sum(used.values()) > 1:
            # Whatever fits the wider gap and was not taken before is shorter than the smallest piece.
            below = lengths[: np.searchsorted(lengths, smallest)]
            below = below[[int(left[b]) > used.get(int(b), 0) for b in below]] if len(below) else below
            pair = _best_pair(below, left, gap + smallest)
            if pair and sum(pair) > smallest:
                used[smallest] -= 1
                for length in pair:
                    used[length] = used.get(length, 0) + 1
                used = {length: k for length, k in used.items() if k}
        repeats = min(int(left[length]) // k for length, k in used.items())
        plans.append((repeats, sorted(used.items(), reverse=True)))
        for length, k in used.items():
            left[length] -= repeats * k
        lengths = lengths[left[lengths] > 0]
    return plans


def _best_pair(lengths: np.ndarray, left: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two unpacked pieces with the greatest sum within ``room``; of equal sums the one with the longest piece."""
    if not len(lengths):
        return None
    partner = np.minimum(np.searchsorted(lengths, room - lengths, "right") - 1, np.arange(len(lengths)))
    alone = (partner == np.arange(len(lengths))) & (left[lengths] < 2)
    partner = partner - alone
    total = np.where(partner >= 0, lengths + lengths[partner], -1)
    best = len(total) - 1 - int(np.argmax(total[::-1]))
    return None if total[best] < 0 else (int(lengths[best]), int(lengths[partner[best]]))


class Places:
    """Where the pieces of each length lie, by their rank."""

    def __init__(self, plans: list[tuple[int, list[tuple[int, int]]]]):
        rows, taken, sequence = [], {}, 0
        for repeats, used in plans:
            offset = 0
            for length, k in used:
                start = taken.get(length, 0)
                rows.append((length, start, k, sequence, offset))
                taken[length] = start + repeats * k
                offset += length * k
            sequence += repeats
        self.sequences = sequence
        self.rows = np.array(sorted(rows), np.int64).reshape(-1, 5)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces of these lengths and ranks."""
        row = np.searchsorted((self.rows[:, 0] << 48) + self.rows[:, 1], (length << 48) + rank, "right") - 1
        _, start, k, sequence, offset = self.rows[row].T
        nth, copy = np.divmod(rank - start, k)
        return sequence + nth, offset + copy * length


def pack_documents(docs: DataFrame, vocabulary_file: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset): every piece of every document with its place in a sequence.

    A document is its text's ids and ``end_id``; NULL and empty texts are that one id. Documents longer than ``capacity``
    are cut into pieces of that length, the last one may be shorter; no other document is cut. ``ids``: the piece's ids, each as
    an unsigned number of 32 bits, little-endian. ``start``: ids of the document before the piece. Pieces of a sequence lie without
    gaps from offset 0, capacity ids in all at most; sequences are numbered from 0. Rows that share a doc_id, or have none, are
    documents of their own. Equal lengths change places freely between reruns on other partitions. Other columns are
    ignored; an empty table gives an empty result. ``vocabulary_file`` is read once, by the driver.
    """
    context = docs.sparkSession.sparkContext
    # A worker keeps what was broadcast from task to task, with the words it has met.
    shared = context.broadcast(WordEncoder(open(vocabulary_file, encoding="utf-8").read()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ranks = shared.value, np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for rows in slices(batch, limit=TEXT_BYTES):
                yield _pieces(rows, encoder, ranks, part, capacity, end_id)

    schema = "doc_id long, piece int, start long, length int, tokens binary, part int, nth long"
    pieces = cut_lineage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidied(cut), schema))
    counted = cut_lineage(pieces.groupBy("part", "length").agg((F.max("nth") + 1).alias("n")))
    # At most one count per length.
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = context.broadcast(Places(plan_sequences(counts, capacity)))
    # One row per task and length: the window of a length grows with the number of tasks only.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select(
        "part",
        "length",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        # A task may have very many pieces of one length, as whole ones of long documents: they meet in TOGETHER_PIECES at most.
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / TOGETHER_PIECES))).alias("bucket"),
    )
    spread = pieces.withColumn("bucket", F.floor(F.col("nth") / TOGETHER_PIECES))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda name: batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
            sequence, offset = places.value.find(column("length"), column("nth") + column("before"))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "piece", "start")),
                    batch.column("length").cast(pa.int64()),
                    pa.array([_narrow(t).astype("<u4").tobytes() for t in batch.column("tokens").to_pylist()], pa.binary()),
                    pa.array(sequence),
                    pa.array(offset),
                ],
                ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"],
            )

    return spread.join(before, ["part", "length", "bucket"]).mapInArrow(
        tidied(place), "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
    )


def _narrow(tokens: bytes) -> np.ndarray:
    return np.frombuffer(tokens, "<u4" if tokens[0] == 4 else "<u2", offset=4 if tokens[0] == 4 else 2)


def _packed(ids: np.ndarray) -> bytes:
    """Ids in two bytes each where they fit, else in four; a leading number names the width."""
    kind = "<u2" if int(ids.max(initial=0)) < 1 << 16 else "<u4"
    return np.concatenate([[int(kind[-1])], ids]).astype(kind).tobytes()


def _pieces(rows: pa.RecordBatch, encoder: WordEncoder, ranks: np.ndarray, part: int, capacity: int, end_id: int) -> pa.RecordBatch:
    """The pieces of a slice of documents; ``ranks`` counts the task's pieces of each length and is carried on."""
    ids, sizes = encoder.encode(rows.column("text"))
    ends = np.cumsum(sizes)
    whole = np.insert(ids, ends, end_id)
    sizes = sizes + 1
    n = -(-sizes // capacity)
    doc = np.repeat(np.arange(len(rows)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = piece * capacity
    length = np.minimum(sizes[doc] - start, capacity)
    first = (np.cumsum(sizes) - sizes)[doc] + start
    order = np.argsort(length, kind="stable")
    ordered = length[order]
    fresh = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.zeros(0, bool)
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(ordered)), 0)) if len(ordered) else ordered
    nth = np.empty(len(doc), np.int64)
    nth[order] = np.arange(len(ordered)) - head + ranks[ordered]
    np.add.at(ranks, length, 1)
    return pa.RecordBatch.from_arrays(
        [
            rows.column("doc_id").take(pa.array(doc)),
            pa.array(piece, pa.int32()),
            pa.array(start, pa.int64()),
            pa.array(length, pa.int32()),
            pa.array([_packed(whole[a : a + m]) for a, m in zip(first.tolist(), length.tolist())], pa.binary()),
            pa.array(np.full(len(doc), part), pa.int32()),
            pa.array(nth),
        ],
        ["doc_id", "piece", "start", "length", "tokens", "part", "nth"],
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, n_pieces, ids): the packed sequences themselves; a group holds ``capacity`` ids at most."""
    listed = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(listed, F.lit(b"").cast("binary"), lambda ids, p: F.concat(ids, p["ids"]))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.count("*").alias("n_pieces"), joined.alias("ids")
    )
