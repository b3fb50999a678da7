from collections import defaultdict

from fogline.llm.mixing import apportion, mix_sources
from pyspark.sql import functions as F


def rows(df):
    return [r.asDict() for r in df.collect()]


def brute_targets(sizes, weights, share, most):
    """Reshare the excess by weight until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            open_.discard(s)
        left = share * sum(sizes.values()) - sum(out.values())
    return out


def test_targets_and_taken_words(spark):
    docs = [(i, " ".join("w" * (1 + i % 50)), f"s{i % 7}" if i % 11 else None) for i in range(3000)]
    docs += [(10_000 + i, "w " * 40, "hot") for i in range(2000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(7)
    got = rows(mix_sources(df, (5, 2, 1), shard=2000))
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = brute_targets(sizes, (5, 2, 1), 1.5, 2)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 64), (s, taken[s], target[s])
    again = rows(mix_sources(df.coalesce(1), (5, 2, 1), shard=2000))
    key = lambda r: (r["doc_id"], r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_highest_quotients_win(spark):
    votes = {"a": 53, "b": 24, "c": 23, "d": 0, "e": 7}
    df = spark.createDataFrame(list(votes.items()), "k string, v long")
    for seats in (0, 1, 3, 10, 101):
        got = {r["k"]: r["quota"] for r in rows(apportion(df, [], F.lit(seats), F.col("v"), F.lit(1000), [F.col("k")]))}
        won = sorted(((v / (2 * i + 1), k) for k, v in votes.items() for i in range(200) if v), key=lambda x: (-x[0], x[1]))[:seats]
        assert got == {k: sum(1 for _, x in won if x == k) for k in votes}


def test_odd_rows(odd, empty):
    got = rows(mix_sources(odd, (5, 2, 1)))
    assert len(got) == odd.count()
    assert all(r["size"] == 0 and r["taken"] == 0 for r in got if r["doc_id"] in (1, 2, 3))
    assert {r["source"] for r in got} >= {None, "a", "\U0001f600"}
    assert mix_sources(empty, (5, 2, 1)).count() == 0


def test_no_python_in_the_plan(spark):
    df = mix_sources(spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string"), (1,))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
