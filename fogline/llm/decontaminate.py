"""Documents that hold passages of benchmark items.

Method: items and documents are cut into windows whose size follows the item's; each window has a
64-bit SimHash of its words. Item sizes fall into classes. A class has one window size and one
stride for documents, chosen so that every long unbroken part of an item (what is left of it when
the similarity is 0.75 or more and the edits lie at its ends) holds one whole document window, and
items have a window at every offset. One more window ends with the text, whose end may cut an item off. So a verbatim part meets a window of distance 0, and windows with some
changed words are met within ``RADIUS`` bits.

Multi-index search: fingerprints are cut into 4 blocks of 16 bits. Two fingerprints within the
radius differ by at most RADIUS // 4 bits in one block, so the tables of all block values within
that distance of an item's block find every fingerprint within the radius. Pairs inside the radius are then
verified exactly: the weighted Jaccard similarity of five-word shingles between the item and the
document window of the item's size that lines up with the hit. A shingle of k items weighs 1/k. k, the common
words and the classes are those of the whole benchmark, so results do not depend on its blocks.

Scale: documents are read once per block of at most ``ITEM_WORDS`` benchmark words, whose tables
are broadcast (about 60 bytes a word); nothing of a document is shuffled, only verified pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fogline.llm.batches import slices, tidied
from fogline.llm.words import mix, shingles, utf8, word_bounds, word_hashes

WIDTH = 5
RADIUS = 11
BLOCKS, BLOCK_BITS = 4, 16
#: Benchmark words in one pass over the documents.
ITEM_WORDS = 200_000
#: Bytes of text that are fingerprinted at once.
WINDOW_BYTES = 1 << 20
#: Words in at least this share of the items count less in a fingerprint.
COMMON_SHARE, COMMON_WEIGHT, WEIGHT = 0.2, 1, 3
#: Ratio of the largest to the smallest item size in a class.
CLASS_RATIO = 1.25


@dataclass
class WindowClass:
    """Items of similar size with their fingerprints, ready to be searched."""

    size: int
    stride: int
    prints: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    #: Per block: where the entries of each block value start, and the entries.
    starts: list[np.ndarray]
    entries: list[np.ndarray]


@dataclass
class Totals:
    """What depends on all items of the benchmark."""

    #: Shingles of more than one item, in order, and their weights; all others weigh 1.
    repeated: np.ndarray
    weight: np.ndarray
    common: np.ndarray
    #: Word counts of items from which the classes start, in order.
    smallest: np.ndarray


@dataclass
class ItemBlock:
    ids: list
    n_words: np.ndarray
    shingle_sets: list[np.ndarray]
    common: np.ndarray
    classes: list[WindowClass]
    totals: Totals


def core(n_words: int) -> int:
    """Words of the longest unbroken part that an item keeps at 0.75 when its ends are changed."""
    return n_words - max(0, (n_words - WIDTH + 1) // 7)


#: For each value of four bits: the bits as four 16-bit fields of one integer.
_FIELDS = np.array([sum(((v >> k) & 1) << (16 * k) for k in range(4)) for v in range(16)], np.uint64)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _weights(totals: Totals, values: np.ndarray) -> np.ndarray:
    """Weight of each shingle."""
    out = np.ones(len(values))
    many = _among(values, totals.repeated)
    out[many] = totals.weight[np.searchsorted(totals.repeated, values[many])]
    return out


_ONES = np.uint64(0x0001000100010001)
#: Times this, the lowest bits of four fields come together in the four bits from 48.
_GATHER = np.uint64(0x0001000200040008)


def prefix_sums(words: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of the weighted bits, four 16-bit fields to an integer, and of the weights.

    The difference of two running sums is exact as long as a window's own sums fit their fields,
    whatever has overflowed before.
    """
    weight = np.where(_among(words, common), COMMON_WEIGHT, WEIGHT).astype(np.uint64)
    bits = mix(words)
    total = np.zeros((16, len(words) + 1), np.uint64)
    for lane in range(16):
        four = _FIELDS[((bits >> np.uint64(4 * lane)) & np.uint64(15)).astype(np.uint8)]
        np.cumsum(four * weight, out=total[lane, 1:])
    return total, np.concatenate([[0], np.cumsum(weight, dtype=np.int64)])


def simhash(total: np.ndarray, weights: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of ``size`` words at ``start``: bits that hold more than half the weight."""
    half = ((weights[start + size] - weights[start]) // 2).astype(np.uint64)
    # Added to a field, this sets its highest bit where the field is larger than half.
    lift = (np.uint64(0x7FFF) - half) * _ONES
    out = np.zeros(len(start), np.uint64)
    for lane in range(16):
        ones = total[lane, start + size] - total[lane, start]
        top = ((ones + lift) >> np.uint64(15)) & _ONES
        out |= ((top * _GATHER) >> np.uint64(48)) << np.uint64(4 * lane)
    return out


def _neighbours(radius: int) -> np.ndarray:
    """All block values with at most ``radius`` bits set."""
    values = np.arange(1 << BLOCK_BITS, dtype=np.uint32)
    return values[np.bitwise_count(values) <= radius].astype(np.uint16)


def _search_tables(prints: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    flips = _neighbours(RADIUS // BLOCKS)
    blocks = prints.view(np.uint16).reshape(-1, BLOCKS)
    starts, entries = [], []
    for b in range(BLOCKS):
        near = (blocks[:, b][:, None] ^ flips[None, :]).ravel()
        order = np.argsort(near, kind="stable")
        entries.append((order // len(flips)).astype(np.int32))
        starts.append(np.searchsorted(near[order], np.arange((1 << BLOCK_BITS) + 1)).astype(np.int64))
    return starts, entries


def _totals(benchmark: DataFrame) -> Totals:
    """Counts over all items, in one aggregation. Only what two items share comes back, and the sizes of items."""
    shingle, word, size = 0, 1, 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, offsets = utf8(part.column("text"))
                starts, ends, first = word_bounds(data, offsets)
                words = word_hashes(data, starts, ends, lower=True)
                hashes, of_item = shingles(words, first, WIDTH)
                of_word = np.repeat(np.arange(len(part)), np.diff(first))
                for kind, values, item in ((shingle, hashes, of_item), (word, words, of_word)):
                    order = np.lexsort((item, values))
                    v, i = values[order], item[order]
                    new = np.ones(len(v), bool)
                    new[1:] = (v[1:] != v[:-1]) | (i[1:] != i[:-1])
                    yield counted(kind, v[new].view(np.int64))
                yield counted(size, np.diff(first).astype(np.int64))

    def counted(kind: int, values: np.ndarray) -> pa.RecordBatch:
        once, items = np.unique(values, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(once), kind, np.int32)), pa.array(once), pa.array(items.astype(np.int64))], ["kind", "value", "items"]
        )

    sums = (
        benchmark.select("text")
        .mapInArrow(tidied(run), "kind int, value long, items long")
        .groupBy("kind", "value")
        .agg(F.sum("items").alias("items"))
        .where((F.col("items") >= 2) | (F.col("kind") == size))
        .toArrow()
    )
    kind, value, items = (sums.column(c).to_numpy() for c in ("kind", "value", "items"))
    hashes = value.view(np.uint64)
    order = np.argsort(hashes, kind="stable")
    kind, value, items, hashes = kind[order], value[order], items[order], hashes[order]
    repeated = kind == shingle
    n_items = items[kind == size].sum()
    common = hashes[(kind == word) & (items >= max(2, COMMON_SHARE * n_items))]
    smallest, left = [], value[(kind == size) & (value > 0)]
    while len(left):
        smallest.append(int(left[0]))
        left = left[left >= max(smallest[-1] + 1, smallest[-1] * CLASS_RATIO)]
    return Totals(hashes[repeated], 1.0 / items[repeated], common, np.array(smallest, np.int64))


def index_items(ids: list, item_texts: list[str | None], totals: Totals) -> ItemBlock:
    """Search structures of some items. Items without a word are never found."""
    data, offsets = utf8(pa.array(item_texts, pa.string()))
    starts, ends, first = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends, lower=True)
    hashes, of_item = shingles(words, first, WIDTH)
    n_words = np.diff(first)
    sets = [np.unique(hashes[of_item == i]) for i in range(len(ids))]
    common = totals.common
    classes = []
    of_class = np.searchsorted(totals.smallest, n_words, "right") - 1
    for c in np.unique(of_class[n_words > 0]).tolist():
        smallest = int(totals.smallest[c])
        members = np.flatnonzero((of_class == c) & (n_words > 0))
        stride = max(1, core(smallest) // 3)
        size = min(core(smallest) - stride + 1, 10_000)
        prints, item, offset = [], [], []
        for i in members.tolist():
            total, weights = prefix_sums(words[first[i] : first[i + 1]], common)
            at = np.arange(n_words[i] - size + 1)
            prints.append(simhash(total, weights, at, size))
            item.append(np.full(len(at), i))
            offset.append(at)
        prints = np.concatenate(prints)
        classes.append(
            WindowClass(size, stride, prints, np.concatenate(item), np.concatenate(offset), *_search_tables(prints))
        )
    return ItemBlock(list(ids), n_words, sets, common, classes, totals)


def _hits(cls: WindowClass, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, entry) of all pairs within the radius."""
    blocks = prints.view(np.uint16).reshape(-1, BLOCKS)
    windows, found = [], []
    for b in range(BLOCKS):
        value = blocks[:, b]
        begin, stop = cls.starts[b][value], cls.starts[b][value.astype(np.int64) + 1]
        hit = np.flatnonzero(stop > begin)
        count = stop[hit] - begin[hit]
        window = np.repeat(hit, count)
        at = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin[hit], count)
        entry = cls.entries[b][at]
        near = np.bitwise_count(prints[window] ^ cls.prints[entry]) <= RADIUS
        windows.append(window[near])
        found.append(entry[near])
    return np.concatenate(windows), np.concatenate(found)


def similarity(block: ItemBlock, item: int, window: np.ndarray) -> float:
    """Weighted Jaccard similarity of an item's shingles and those of a document window."""
    own = block.shingle_sets[item]
    union = np.union1d(own, window)
    weights = _weights(block.totals, union)
    both = _among(union, own) & _among(union, window)
    return float(weights[both].sum() / weights.sum())


def _possible(block: ItemBlock, words: np.ndarray, first: np.ndarray, tried: np.ndarray, threshold: float) -> np.ndarray:
    """(row, item, from, to) of the candidates whose windows hold enough weight of any item's shingles.

    The weight that a window shares with one item is at most what it shares with all items, so a window below
    threshold times the item's own weight cannot reach the threshold.
    """
    row, item, begin = tried.T
    a, b = np.maximum(begin, 0), np.minimum(begin + block.n_words[item], np.diff(first)[row])
    if not len(row):
        return np.stack([row, item, a, b], axis=1)
    # A run that starts at each word, also across texts: those are cut off by the windows below.
    runs, _ = shingles(words, np.array([0, len(words)]), WIDTH)
    every = np.unique(np.concatenate(block.shingle_sets))
    of_items = _among(runs, every)
    weight = np.zeros(len(runs))
    weight[of_items] = _weights(block.totals, runs[of_items])
    held = np.concatenate([[0.0], np.cumsum(weight)])
    start = np.minimum(first[:-1][row] + a, len(runs))
    stop = np.clip(first[:-1][row] + b - WIDTH + 1, start, len(runs))
    own = np.array([_weights(block.totals, s).sum() for s in block.shingle_sets])
    short = (b - a) < WIDTH
    return np.stack([row, item, a, b], axis=1)[short | (held[stop] - held[start] >= threshold * own[item] - 1e-9)]


def search(block: ItemBlock, column: pa.Array, threshold: float) -> list[tuple[int, int, int, float]]:
    """(row, item, first word of the window, similarity): the best window of each row and item."""
    data, offsets = utf8(column)
    starts, ends, first = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends, lower=True)
    if not len(words):
        return []
    total, weights = prefix_sums(words, block.common)
    count = np.diff(first)
    tried = []
    for cls in block.classes:
        per_row = np.where(count >= cls.size, (count - cls.size) // cls.stride + 1, 0)
        row = np.repeat(np.arange(len(count)), per_row)
        at = (np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)) * cls.stride + first[:-1][row]
        if not len(at):
            continue
        # One more window ends with the text, for items that the text's end cuts off.
        last = np.flatnonzero((count >= cls.size) & ((count - cls.size) % cls.stride > 0))
        row = np.concatenate([row, last])
        at = np.concatenate([at, first[1:][last] - cls.size])
        window, entry = _hits(cls, simhash(total, weights, at, cls.size))
        begin = at[window] - first[:-1][row[window]] - cls.offset[entry]
        tried.append(np.stack([row[window], cls.item[entry], begin], axis=1))
    if not tried:
        return []
    tried = _possible(block, words, first, np.unique(np.concatenate(tried), axis=0), threshold)
    best: dict[tuple[int, int], tuple[int, float]] = {}
    for r, i, a, b in tried.tolist():
        own = words[first[r] + a : first[r] + b]
        window = np.unique(shingles(own, np.array([0, len(own)]), WIDTH)[0])
        score = similarity(block, i, window)
        if score >= threshold and score > best.get((r, i), (0, 0.0))[1]:
            best[r, i] = (a, score)
    return [(r, i, a, s) for (r, i), (a, s) in best.items()]


def _item_blocks(benchmark: DataFrame) -> Iterator[tuple[list, list]]:
    """Items in order of item_id, ITEM_WORDS words at a time; one block at a time is on the driver."""
    ids, item_texts, size = [], [], 0
    rows = benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator()
    for row in rows:
        words = len((row["text"] or "").split())
        if ids and size + words > ITEM_WORDS:
            yield ids, item_texts
            ids, item_texts, size = [], [], 0
        ids.append(row["item_id"])
        item_texts.append(row["text"])
        size += words
    if ids:
        yield ids, item_texts


def _shared(spark: SparkSession, block: ItemBlock):
    """Plain data of a block, broadcast, so that executors can read it without this package installed."""
    return spark.sparkContext.broadcast(vars(block) | {"classes": [vars(c) for c in block.classes], "totals": None})


def _restored(plain: dict, totals: dict) -> ItemBlock:
    return ItemBlock(**plain | {"classes": [WindowClass(**c) for c in plain["classes"]], "totals": Totals(**totals)})


def _search_block(spark: SparkSession, docs: DataFrame, block: ItemBlock, totals, threshold: float) -> DataFrame:
    shared = _shared(spark, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _restored(shared.value, totals.value)
        for batch in batches:
            for part in slices(batch, limit=WINDOW_BYTES):
                found = search(known, part.column("text"), threshold)
                ids = part.column("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([f[0] for f in found], pa.int64())),
                        pa.array([known.ids[f[1]] for f in found], pa.int64()),
                        pa.array([f[2] for f in found], pa.int64()),
                        pa.array([int(known.n_words[f[1]]) for f in found], pa.int64()),
                        pa.array([f[3] for f in found], pa.float64()),
                    ],
                    ["doc_id", "item_id", "start_word", "n_words", "similarity"],
                )

    schema = "doc_id long, item_id long, start_word long, n_words long, similarity double"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(run), schema)


def find_passages(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity): the best window of each such pair.

    Words are runs of ``[^\\x20\\x09-\\x0d]``, A-Z in lower case; ``start_word`` counts from 0. One row per
    pair: rows with the same doc_id, and items with the same item_id, give their most similar window (the
    first one among equals). NULL and empty texts and items without words give no rows; an item of fewer than
    five words is one shingle. A NULL doc_id is kept as such. Other columns are ignored.
    """
    spark = docs.sparkSession
    found = None
    totals = _totals(benchmark)
    shared_totals = spark.sparkContext.broadcast(vars(totals))
    for ids, item_texts in _item_blocks(benchmark.select(F.col("item_id").cast("long"), "text")):
        part = _search_block(spark, docs, index_items(ids, item_texts, totals), shared_totals, threshold)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "doc_id long, item_id long, start_word long, n_words long, similarity double")
    best = F.max(F.struct(F.col("similarity"), (-F.col("start_word")).alias("back"), "n_words")).alias("b")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(best)
        .select("doc_id", "item_id", (-F.col("b.back")).alias("start_word"), "b.n_words", "b.similarity")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Rows of ``docs``, all columns, whose text holds no passage of an item. Nothing is shuffled."""
    spark = docs.sparkSession
    totals = _totals(benchmark)
    shared_totals = spark.sparkContext.broadcast(vars(totals))
    for ids, item_texts in _item_blocks(benchmark.select(F.col("item_id").cast("long"), "text")):
        shared = _shared(spark, index_items(ids, item_texts, totals))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = _restored(shared.value, shared_totals.value)
            for batch in batches:
                for part in slices(batch, limit=WINDOW_BYTES):
                    clean = np.ones(len(part), bool)
                    clean[[f[0] for f in search(known, part.column("text"), threshold)]] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(tidied(run), docs.schema)
    return docs
