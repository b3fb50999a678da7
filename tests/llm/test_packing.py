import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fogline.llm import queries
from fogline.llm.packing import Places, WordEncoder, pack_documents, plan_sequences, sequences
from tests.llm.conftest import DOCS

VOCABULARY = queries.vocabulary_file("word_bpe_49k.json")


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def ids_of(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8") | st.sampled_from(" \n\t\x0b  'sΣ<|>́"), max_size=60), max_size=5))
def test_words_give_the_ids_of_the_whole_text(texts):
    global _encoder, _whole
    encoder = _encoder if "_encoder" in globals() else (_encoder := WordEncoder(open(VOCABULARY, encoding="utf-8").read()))
    whole = _whole if "_whole" in globals() else (_whole := tokenizer())
    texts = [*texts, "<|endoftext|> a<|startoftext|>b", None, "it's  we'll\n\n x"]
    ids, sizes = encoder.encode(pa.array(texts, pa.string()))
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def one_by_one(counts, capacity):
    """Best-two-fit on single pieces."""
    left = sorted((n for n, c in counts.items() for _ in range(c)), reverse=True)
    bins = []
    while left:
        now, gap = [], capacity
        for n in list(left):
            if n <= gap:
                now.append(n)
                left.remove(n)
                gap -= n
        small = min(now)
        pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1 :] if a + b <= gap + small]
        if gap and len(now) > 1 and pairs and max(pairs)[0] > small:
            _, a, b = max(pairs)
            now.remove(small)
            left += [small]
            for n in (a, b):
                left.remove(n)
                now.append(n)
            left.sort(reverse=True)
        bins.append(sorted(now, reverse=True))
    return bins


def test_plan_holds_every_piece_once():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.choice([7, 40, 100])
        counts = {n: rng.randrange(1, 30) for n in rng.sample(range(1, capacity + 1), min(capacity, rng.randrange(1, 20)))}
        plans = plan_sequences(counts, capacity)
        held = {}
        for repeats, used in plans:
            assert repeats > 0 and sum(n * k for n, k in used) <= capacity
            for n, k in used:
                held[n] = held.get(n, 0) + repeats * k
        assert held == counts
        n_plain = len(one_by_one(counts, capacity))
        assert abs(sum(r for r, _ in plans) - n_plain) <= max(1, n_plain // 50)


def test_pair_replaces_the_smallest():
    # Greedy 6 + 3 leaves 1; 2 + 2 instead of 3 leaves nothing.
    assert plan_sequences({6: 1, 3: 1, 2: 2}, 10) == [(1, [(6, 1), (2, 2)]), (1, [(3, 1)])]


def test_single_pieces_agree_with_the_plan():
    rng = random.Random(9)
    for _ in range(40):
        counts = {n: 1 for n in rng.sample(range(1, 60), 25)}
        plans = plan_sequences(counts, 60)
        assert [sorted((n for n, k in used for _ in range(k)), reverse=True) for _, used in plans] == one_by_one(counts, 60)


def test_places_are_gapless():
    counts = {5: 7, 3: 11, 2: 4, 1: 3}
    places = Places(plan_sequences(counts, 11))
    spans = {}
    for n, c in counts.items():
        seq, off = places.find(np.full(c, n), np.arange(c))
        for s, o in zip(seq.tolist(), off.tolist()):
            spans.setdefault(s, []).append((o, n))
    assert sorted(spans) == list(range(places.sequences))
    for listed in spans.values():
        at = 0
        for o, n in sorted(listed):
            assert o == at
            at += n
        assert at <= 11


@pytest.mark.parametrize("capacity", [4096, 50])
def test_round_trip_of_odd_rows(spark, odd, capacity):
    got = pack_documents(odd, VOCABULARY, capacity).collect()
    pieces = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids"]) for r in got]
    want = []
    for r in odd.select("doc_id", "text").collect():
        ids = ids_of(r["text"])
        for piece in range(-(-len(ids) // capacity)):
            part = ids[piece * capacity : (piece + 1) * capacity]
            want.append((r["doc_id"], piece, piece * capacity, len(part), np.array(part, "<u4").tobytes()))
    assert sorted(pieces, key=repr) == sorted(((d, p, s, n, bytearray(i)) for d, p, s, n, i in want), key=repr)
    spans = {}
    for r in got:
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for listed in spans.values():
        at = 0
        for offset, length in sorted(listed):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in got)
    assert len(spans) <= -(-total // capacity) * 1.02 + 1


def test_empty(spark, empty):
    assert pack_documents(empty, VOCABULARY).count() == 0


def test_sequences_are_the_pieces_end_to_end(spark):
    docs = spark.createDataFrame([(i, "some words " * i, None, None, None) for i in range(40)], DOCS)
    packed = pack_documents(docs, VOCABULARY, 64).cache()
    by = {}
    for r in packed.collect():
        by.setdefault(r["sequence_id"], []).append((r["offset"], bytes(r["ids"])))
    got = {r["sequence_id"]: bytes(r["ids"]) for r in sequences(packed).collect()}
    assert got == {s: b"".join(i for _, i in sorted(listed)) for s, listed in by.items()}


def test_query(spark):
    from tests.conftest import SF

    df = queries.QUERIES["op12_pack_documents"](spark, SF)
    assert df.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = df.collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows[::7]:
        part = ids_of(texts[r["doc_id"]])[r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
    assert len({r["sequence_id"] for r in rows}) <= -(-sum(r["length"] for r in rows) // 4096) + 1
