"""Lines that many documents share stay in one of them.

Method: every long line is hashed to 128 bits; documents per hash are counted with map-side
combining. The distinct hashes are split over shards, and each shard becomes one row that holds a
minimal perfect hash of its keys and, in its order, small arrays: a 32-bit fingerprint, the count
(saturated) and, for frequent lines, the document that keeps them. Documents send (hash, doc_id)
to the shards and are answered from the arrays; no line text is shuffled and no lines are joined.

Skew: at most ``HEAVY`` lines can each make up 1/HEAVY of all occurrences. Those are answered
from a broadcast list of at most ``HEAVY`` entries and are never routed, so every routed line has
less than 1/HEAVY of the rows. A shard's rows are streamed past its arrays, never gathered.
Shards follow the session's number of shuffle partitions.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fogline.llm import mphf
from fogline.llm.batches import longs, slices, texts, tidied
from fogline.session import cut_lineage

#: No more than this many lines can each hold a HEAVY-th of all occurrences.
HEAVY = 10_000
#: A NULL doc_id counts as the smallest one.
NO_ID = -(2**63)

_STRIP = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of the stripped, A-Z lower-cased line; None when it is shorter than ``min_chars``."""
    key = line.strip(_STRIP).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def _long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(hi, lo, doc_id): each long line of each row once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids = longs(part, "doc_id", NO_ID)
                found, count = bytearray(), []
                for text in texts(part):
                    keys = {line_key(x, min_chars) for x in text.encode().split(b"\n")}
                    keys.discard(None)
                    found += b"".join(keys)
                    count.append(len(keys))
                pair = np.frombuffer(bytes(found), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy()), pa.array(np.repeat(ids, count))],
                    ["hi", "lo", "doc_id"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidied(run), "hi long, lo long, doc_id long")


def _shard_of(hi: np.ndarray, n_shards: int) -> np.ndarray:
    return (hi.view(np.uint64) % np.uint64(n_shards)).astype(np.int32)


def _build_shards(counts: DataFrame, n_shards: int, min_docs: int, heavy_share: int) -> DataFrame:
    """One row per shard: arrays in the order of its perfect hash, and its heaviest lines."""

    def row(shard: int, cols: list[np.ndarray]) -> pa.RecordBatch:
        hi, lo, n, keeper = cols
        levels = mphf.build(hi.view(np.uint64), lo.view(np.uint64))
        order = mphf.Index(levels).of(hi.view(np.uint64), lo.view(np.uint64))
        prints, seen = np.empty(len(hi), np.uint32), np.empty(len(hi), np.uint8)
        prints[order] = (lo.view(np.uint64) >> np.uint64(32)).astype(np.uint32)
        seen[order] = np.minimum(n, 255)
        keep = np.empty(len(hi), np.int64)
        keep[order] = keeper
        total = int(n.sum())
        top = np.flatnonzero((n >= min_docs) & (n * heavy_share >= total))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()),
                pa.array([mphf.dump(levels)], pa.binary()),
                pa.array([prints.tobytes()], pa.binary()),
                pa.array([seen.tobytes()], pa.binary()),
                pa.array([keep[seen >= min_docs].tobytes()], pa.binary()),
                pa.array([total], pa.int64()),
                pa.array([[{"hi": int(hi[i]), "lo": int(lo[i]), "n": int(n[i]), "keeper": int(keeper[i])} for i in top]], heavy),
            ],
            ["shard", "levels", "prints", "seen", "keepers", "total", "heavy"],
        )

    heavy = pa.list_(pa.struct([(c, pa.int64()) for c in ("hi", "lo", "n", "keeper")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            cols = [batch.column(c).to_numpy() for c in ("hi", "lo", "n", "keeper")]
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if shard[a] != now and held:
                    yield row(now, [np.concatenate(c) for c in zip(*held)])
                    held = []
                now = int(shard[a])
                held.append([c[a:b] for c in cols])
        if held:
            yield row(now, [np.concatenate(c) for c in zip(*held)])

    return (
        counts.withColumn("shard", F.pmod(F.col("hi"), F.lit(n_shards)).cast("int"))
        .repartition("shard")
        .sortWithinPartitions("shard")
        .select("shard", "hi", "lo", "n", "keeper")
        .mapInArrow(
            tidied(run),
            "shard int, levels binary, prints binary, seen binary, keepers binary, total long, "
            "heavy array<struct<hi:long,lo:long,n:long,keeper:long>>",
        )
    )


def _probe(lines: DataFrame, shards: DataFrame, n_shards: int, min_docs: int) -> DataFrame:
    """(doc_id, hi, lo) of the lines that their document loses, answered from the shards' arrays."""
    none = F.lit(None)
    asked = lines.select(
        F.pmod(F.col("hi"), F.lit(n_shards)).cast("int").alias("shard"),
        F.lit(1).alias("kind"),
        "hi",
        "lo",
        "doc_id",
        *(none.cast("binary").alias(c) for c in ("levels", "prints", "seen", "keepers")),
    )
    arrays = shards.select(
        "shard", F.lit(0).alias("kind"), *(none.cast("long").alias(c) for c in ("hi", "lo", "doc_id")), "levels", "prints", "seen", "keepers"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = prints = seen = keeper = None
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            cuts = sorted({0, len(kind), *(x for i in np.flatnonzero(kind == 0).tolist() for x in (i, i + 1))})
            for a, b in zip(cuts[:-1], cuts[1:]):
                if kind[a] == 0:
                    data = {c: batch.column(c)[a].as_py() for c in ("levels", "prints", "seen", "keepers")}
                    index = mphf.Index(mphf.load(data["levels"]))
                    prints, seen = np.frombuffer(data["prints"], np.uint32), np.frombuffer(data["seen"], np.uint8)
                    keeper = np.zeros(len(seen), np.int64)
                    keeper[seen >= min_docs] = np.frombuffer(data["keepers"], np.int64)
                    continue
                part = batch.slice(a, b - a)
                hi, lo, ids = (part.column(c).to_numpy() for c in ("hi", "lo", "doc_id"))
                at = index.of(hi.view(np.uint64), lo.view(np.uint64))
                known = at >= 0
                known[known] = prints[at[known]] == (lo.view(np.uint64) >> np.uint64(32)).astype(np.uint32)[known]
                lost = np.zeros(len(at), bool)
                lost[known] = (seen[at[known]] >= min_docs) & (keeper[at[known]] != ids[known])
                yield pa.RecordBatch.from_arrays([pa.array(x[lost]) for x in (ids, hi, lo)], ["doc_id", "hi", "lo"])

    return (
        asked.unionByName(arrays)
        .repartition("shard")
        .sortWithinPartitions("shard", "kind")
        .mapInArrow(tidied(run), "doc_id long, hi long, lo long")
    )


def _apply(docs: DataFrame, lost: DataFrame, heavy: dict[bytes, int], min_chars: int, carry: list[str]) -> DataFrame:
    """Documents without their lost lines."""
    per_doc = lost.groupBy(F.col("doc_id").alias("__id")).agg(
        F.collect_list(F.struct("hi", "lo")).alias("__lost")
    )
    both = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", *(F.col(c) for c in carry),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("__key"),
    ).join(per_doc, F.col("__key") == F.col("__id"), "left").drop("__id")
    kept_schema = both.drop("__key", "__lost").schema
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept_schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids = part.column("__key").to_pylist()
                drops = part.column("__lost").to_pylist()
                new, n_lines, n_dropped = [], [], []
                for doc, text, lost_here in zip(ids, texts(part), drops):
                    lines = text.encode().split(b"\n")
                    gone = {struct.pack("<qq", x["hi"], x["lo"]) for x in lost_here or ()}
                    if gone or heavy:
                        keys = [line_key(x, min_chars) for x in lines]
                        kept = [x for x, k in zip(lines, keys) if k is None or k not in gone and heavy.get(k, doc) == doc]
                    else:
                        kept = lines
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(kept))
                    new.append(b"\n".join(kept).decode() if len(kept) < len(lines) else text)
                columns = {c: part.column(c) for c in kept_schema.names}
                columns["text"] = pa.array(new, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*columns.values(), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                    [*columns, "n_lines", "n_dropped"],
                )

    return both.mapInArrow(tidied(run), f"{out}, n_lines long, n_dropped long")


def dedup_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, carry: tuple[str, ...] = (), heavy_share: int = HEAVY
) -> DataFrame:
    """Every row of ``docs`` as doc_id, text (kept lines), the ``carry`` columns, n_lines, n_dropped.

    A line's key is the line without ``[\\x20\\x09-\\x0d]`` at its ends, A-Z in lower case. Keys of at
    least ``min_chars`` code points in at least ``min_docs`` rows lose all their lines except in the
    largest doc_id that has them; a document that keeps a line keeps all its repeats. NULL text is
    one empty line and comes back empty. A NULL doc_id counts as the smallest. Rows with the same doc_id are
    counted one by one and share their fate. Other columns are ignored unless carried.
    """
    if not 2 <= min_docs <= 255:
        raise ValueError("min_docs must lie between 2 and 255")
    spark = docs.sparkSession
    n_shards = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = _long_lines(docs, min_chars)
    counts = lines.groupBy("hi", "lo").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    shards = cut_lineage(_build_shards(counts, n_shards, min_docs, heavy_share))
    total = shards.agg(F.sum("total")).first()[0] or 0
    top = shards.select(F.explode("heavy").alias("h")).select("h.*").where(F.col("n") * heavy_share >= total)
    # At most heavy_share rows: each holds that part of all occurrences.
    heavy = {struct.pack("<qq", r["hi"], r["lo"]): r["keeper"] for r in top.collect()}
    known = spark.sparkContext.broadcast(heavy)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answered = np.array([struct.unpack("<qq", k) for k in known.value], np.int64).reshape(-1, 2)
        for batch in batches:
            hi, lo = batch.column("hi").to_numpy(), batch.column("lo").to_numpy()
            mask = np.isin(hi, answered[:, 0])
            # The first word says which rows to look at, both words say which are answered.
            near = np.flatnonzero(mask)
            mask[near] = [struct.pack("<qq", a, b) in known.value for a, b in zip(hi[near].tolist(), lo[near].tolist())]
            yield batch.filter(pa.array(~mask)) if mask.any() else batch

    rest = lines.mapInArrow(tidied(routed), "hi long, lo long, doc_id long") if heavy else lines
    return _apply(docs, _probe(rest, shards, n_shards, min_docs), heavy, min_chars, list(carry))
