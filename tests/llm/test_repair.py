import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from fogline.llm import repair

DDL = "conv_id long, turn long, role string, text string, n long, piece string, at string, symbol string"
NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def brute(rows):
    """Summary of one conversation's rows (turn, role, text) in order, by trying every edit in every state."""
    seen, faults = set(), []
    for _, role, text in rows:
        said = text.strip("\t\n\x0b\x0c\r ")
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None)
        seen.add((role, text))
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    word = {"u": "user", "a": "assistant"}

    def with_inserts(ways):
        for _ in range(3):
            for state, (cost, audit, said) in list(ways.items()):
                new = (cost + 2, audit + "I", said + [word[after[state]] + ":"])
                ways[after[state]] = min(ways.get(after[state], new), new)
        return ways

    ways = with_inserts({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        new = {}

        def offer(state, way):
            new[state] = min(new.get(state, way), way)

        for state, (cost, audit, said) in ways.items():
            offer(state, (cost + 3, audit + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            if role[:1] and role[:1] in {"": "su", "s": "u", "u": "a", "a": "u"}[state]:
                offer(role[:1], (cost + more, audit + "K", [*said, f"{role}:{text}"]))
            offer(after[state], (cost + 2 + more, audit + "R", [*said, f"{word[after[state]]}:{text}"]))
        ways = with_inserts(new)
    cost, audit, said = min(w for s, w in ways.items() if s in ("", "a"))
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(said).encode()).hexdigest(),
    )


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {conv: brute(sorted(found, key=order)) for conv, found in by.items()}


def found(spark, rows, conversations=None):
    turns = spark.createDataFrame([(*r, 0, "", "", "") for r in rows], DDL)
    done = repair.summarise(repair.repair_conversations(turns), turns if conversations is None else conversations)
    return {r["conv_id"]: tuple(r[n] for n in NAMES) for r in done.collect()}


def some_rows(conv, n, seed):
    rng = random.Random(seed)
    said = ["Yes.", "No!", "", " \t\n", "unended", "Why? ", *(f"text {i}." for i in range(n))]
    roles = ["user", "assistant"] * 6 + ["system", "tool", "", None, "User", "s"]
    return [(conv, rng.choice([None, rng.randrange(2 * n + 1)]) if rng.random() < 0.2 else i, rng.choice(roles), rng.choice([*said, None])) for i in range(n)]


def test_matches_brute_force(spark):
    rows = [r for c in range(60) for r in some_rows(c if c else None, c % 13, c)]
    assert found(spark, rows) == expected(rows)


def test_hot_conversation_over_many_pieces(spark):
    rows = some_rows(1, 3, 1) + some_rows(2, 2500, 2) + some_rows(3, 4, 3) + [(4, None, "user", "same.")] * 900
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        pieces = repair.number_rows(turns).groupBy("conv_id").agg(F.countDistinct("piece").alias("n")).collect()
        assert {r["conv_id"]: r["n"] for r in pieces}[2] > 2
        assert found(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_tables_and_conversations_without_rows(spark):
    assert found(spark, []) == {}
    ids = spark.createDataFrame([(1,), (None,), (9,), (9,)], "conv_id long")
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found(spark, [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho.")], ids) == {
        1: (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:Hi.\nassistant:Ho.").hexdigest()),
        None: none,
        9: none,
    }


def test_edits_keep_texts_and_long_ones_are_whole(spark):
    long = "word " * 200_000 + "end."
    rows = [(1, 0, "user", long), (1, 2, "user", "b"), (1, 3, "user", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = repair.repair_conversations(turns).orderBy("piece", "at", "sub").collect()
    assert [(r["edit"], r["cost"], r["fault"], r["role"]) for r in got] == [
        ("K", 0, None, "user"), ("R", 3, "truncated", "assistant"), ("D", 3, "blank", "user"),
    ]
    assert got[0]["text"] == long


@pytest.mark.parametrize("size", [1, 2, 5, 64])
def test_blocks_change_nothing(monkeypatch, size):
    rng = random.Random(size)
    for _ in range(60):
        symbols = "".join(rng.choice("suaoSUAOxy") for _ in range(rng.randrange(1, 40)))
        monkeypatch.setattr(repair, "BLOCK", 1 << 20)
        whole = repair.Solver().run(symbols, repair.ENDS, True)
        monkeypatch.setattr(repair, "BLOCK", size)
        assert repair.Solver().run(symbols, repair.ENDS, True) == whole


def test_prices_bound_every_arc():
    symbols = "uusaoXUyAau"
    arcs = repair.arcs_of(symbols, True)
    end = 4 * (len(symbols) + 1)
    for q in (0, 3):
        arcs[4 * len(symbols) + q].append(("", 0, end))
    prices = [0] * (end + 1)
    repair.auction(arcs, prices, 0, end)
    assert all(prices[v] <= cost + prices[to] for v, out in enumerate(arcs) for _, cost, to in out)
    assert prices[0] == repair.solve_block(symbols, repair.ENDS, True)[0].cost


def test_damage(spark):
    rows = [(c, t, "system", f"One. {t}!") for c in range(20) for t in range(8)] + [(None, None, None, None), (None, 3, "system", "x?")]
    want = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            want += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, repair.damage_turns(turns).collect()), key=repr) == sorted(want, key=repr)
