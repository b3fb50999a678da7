import random
from collections import defaultdict

import numpy as np
import pytest

from fogline.llm import mphf
from fogline.llm.line_dedup import dedup_lines
from tests.llm.conftest import odd_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LOW = -(2**63)


def brute(docs, min_chars, min_docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    count, keeper = defaultdict(int), defaultdict(lambda: LOW)
    for doc, text in docs:
        for k in {key(x) for x in (text or "").split("\n")}:
            count[k] += 1
            keeper[k] = max(keeper[k], LOW if doc is None else doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        lost = lambda k, doc=doc: len(k) >= min_chars and count[k] >= min_docs and keeper[k] != (LOW if doc is None else doc)
        kept = [x for x in lines if not lost(key(x))]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("heavy_share", [10_000, 4])
def test_equals_brute_force(spark, heavy_share):
    """With all frequent lines in the broadcast list, and with nearly all of them routed to the shards."""
    rnd = random.Random(3)
    pool = [f"shared line number {i} é {'x' * rnd.randrange(8)}" for i in range(60)]
    docs = []
    for i in range(300):
        lines = [rnd.choice([str.upper, str, lambda x: f" \t{x}\r"])(rnd.choice(pool[: rnd.choice([3, 60])])) for _ in range(rnd.randrange(6))]
        docs.append((i if i % 50 else None, "\n".join([*lines, f"own line of the document number {i}"])))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert result(dedup_lines(df, 20, 5, heavy_share=heavy_share)) == brute(docs, 20, 5)


def test_odd_rows(odd, empty):
    docs = [r[:2] for r in odd_rows()]
    kept = dedup_lines(odd, 40, 5, carry=("lang", "toxic"))
    assert kept.columns == ["doc_id", "text", "lang", "toxic", "n_lines", "n_dropped"]
    assert result(kept) == brute(docs, 40, 5)
    assert dedup_lines(empty).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    hi, lo = np.random.default_rng(n).integers(0, 1 << 63, (2, n)).astype(np.uint64)
    index = mphf.Index(mphf.load(mphf.dump(mphf.build(hi, lo))))
    assert sorted(index.of(hi, lo).tolist()) == list(range(n)) and index.size == n
    if n > 1000:
        assert len(mphf.dump(index.levels)) * 8 < 4 * n


def test_perfect_hash_of_keys_that_share_much():
    a, b = np.arange(3000, dtype=np.uint64), np.arange(3000, dtype=np.uint64) ^ np.uint64(12345)
    for hi, lo in ((a, b), (a, a), (np.zeros(3000, np.uint64), a), (a, np.zeros(3000, np.uint64))):
        index = mphf.Index(mphf.build(hi, lo))
        assert sorted(index.of(hi, lo).tolist()) == list(range(3000))
    with pytest.raises(ValueError, match="not distinct"):
        mphf.build(np.array([7, 7, 8], np.uint64), np.array([1, 1, 1], np.uint64))
