import random
import re

import numpy as np

from fogline.llm import decontaminate as dc

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def runs(w):
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs, items, threshold=0.75):
    """Best similarity of every pair over all windows of the item's size, also those cut off by the text's ends."""
    share = {}
    for _, t in items:
        for s in runs(words(t)):
            share[s] = share.get(s, 0) + 1
    weight = lambda s: 1 / share.get(s, 1)
    out = {}
    for d, text in docs:
        w = words(text)
        for i, t in items:
            own, n = runs(words(t)), len(words(t))
            for a in range(len(w)) if n else ():
                window = runs(w[a : a + n])
                total = sum(weight(s) for s in own | window)
                score = sum(weight(s) for s in own & window) / total
                if score >= threshold - 1e-12:
                    out[d, i] = max(out.get((d, i), 0), score)
    return out


def fixture():
    rnd = random.Random(8)
    stop = ["the", "of", "and", "a", "in"]
    word = lambda: rnd.choice(stop) if rnd.random() < 0.3 else f"w{rnd.randrange(3000)}"
    items = [(k, " ".join(word() for _ in range(rnd.randrange(12, 60)))) for k in range(25)]
    items += [(100, "two words"), (101, None), (102, "")]
    docs = []
    for d in range(150):
        body = [word() for _ in range(rnd.randrange(5, 200))]
        if d % 2:
            passage = rnd.choice(items[:25])[1].split()
            if d % 3 == 0:
                passage[0] = "changed"
            if d % 3 == 1 and len(passage) >= 45:
                passage[len(passage) // 2] = "changed"
            if d % 5 == 0:
                passage = [p.upper() for p in passage]
            at = rnd.randrange(len(body))
            body[at:at] = passage
        docs.append((d, "\n ".join(body)))
    return docs, items


def test_finds_what_brute_force_finds(spark):
    docs, items = fixture()
    want = brute(docs, items)
    found = dc.find_passages(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}
    assert set(got) <= set(want) and len(set(want) - set(got)) <= 0.02 * len(want)
    assert len(want) > 60
    # The best window is found, or one next to it.
    assert sum(abs(got[k] - want[k]) < 1e-9 for k in got) >= 0.9 * len(got)
    assert all(got[k] <= want[k] + 1e-9 for k in got)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = fixture()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    key = lambda rows: {(r["doc_id"], r["item_id"]) for r in rows}
    whole = key(dc.find_passages(df, bench).collect())
    clean = {r["doc_id"] for r in dc.drop_contaminated(df, bench).select("doc_id").collect()}
    assert clean == {d for d, _ in docs} - {d for d, _ in whole}
    monkeypatch.setattr(dc, "ITEM_WORDS", 300)
    assert key(dc.find_passages(df, bench).collect()) >= {k for k in whole if k[1] == 100}
    assert {r["doc_id"] for r in dc.drop_contaminated(df, bench).select("doc_id").collect()} == clean


def test_index_finds_all_within_the_radius():
    rnd = np.random.default_rng(4)
    prints = rnd.integers(0, 1 << 63, 200).astype(np.uint64)
    asked = prints[rnd.integers(0, 200, 3000)].copy()
    for b in range(dc.RADIUS + 2):
        asked[b * 200 : b * 200 + 200] ^= np.bitwise_or.reduce(
            np.uint64(1) << rnd.permuted(np.tile(np.arange(64, dtype=np.uint64), (200, 1)), axis=1)[:, : b + 1], axis=1
        )
    cls = dc.WindowClass(1, 1, prints, np.arange(200), np.zeros(200, int), *dc._search_tables(prints))
    window, entry = dc._hits(cls, asked)
    want = np.argwhere(np.bitwise_count(asked[:, None] ^ prints[None, :]) <= dc.RADIUS)
    assert {*zip(window.tolist(), entry.tolist())} == {tuple(x) for x in want.tolist()}


def test_odd_rows(spark, odd, empty):
    words_4 = " ".join(f"word{i}" for i in range(30))
    bench = spark.createDataFrame([(1, words_4), (None, "ein Wort"), (2, None), (3, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.find_passages(odd, bench).collect()}
    assert got == {(None, 1), (4, 1), (5, 1), (6, 1), (7, None), (8, None)}
    clean = dc.drop_contaminated(odd, bench)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 7
    assert dc.find_passages(empty, bench).count() == 0
    assert dc.find_passages(odd, bench.limit(0)).count() == 0
    assert dc.drop_contaminated(odd, bench.limit(0)).count() == odd.count()


def test_block_size_changes_no_pair_and_no_similarity(spark, monkeypatch):
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(5000)}"
    boilerplate = [word() for _ in range(30)]
    items = [(k, " ".join(boilerplate + [word() for _ in range(rnd.randrange(45, 60))])) for k in range(12)]
    docs = [(0, " ".join(boilerplate + [word() for _ in range(20)]))]
    for d in range(1, 40):
        # Every other document holds the item's own part without the boilerplate that all items share.
        part = items[d % 12][1].split()[0 if d % 2 else 30 :]
        docs.append((d, " ".join(part)))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = lambda: {(r["doc_id"], r["item_id"]): r["similarity"] for r in dc.find_passages(df, bench).collect()}
    whole, want = found(), brute(docs, items)
    assert len(whole) == 39 and all(whole[k] <= want[k] + 1e-9 for k in whole)
    for size in (1, 200):
        monkeypatch.setattr(dc, "ITEM_WORDS", size)
        assert found() == whole


def test_finds_items_cut_off_by_the_end_of_the_text():
    rnd = random.Random(3)
    word = lambda: rnd.choice(["the", "of", "and", "a", "in"]) if rnd.random() < 0.35 else f"w{rnd.randrange(9000)}"
    none = np.zeros(0, np.uint64)
    for n in (40, 60, 100):
        item = [word() for _ in range(n)]
        least = min(m for m in range(n) if len(runs(item[:m])) >= 0.75 * len(runs(item)))
        block = dc.index_items([1], [" ".join(item)], dc.Totals(none, np.zeros(0), none, np.array([n])))
        docs = [" ".join([word() for _ in range(rnd.randrange(80))] + item[: least + k % 3]) for k in range(300)]
        found = dc.search(block, dc.pa.array(docs), 0.75)
        assert {f[0] for f in found} == set(range(300))
