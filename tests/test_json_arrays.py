import json
import random

import pytest
from pyspark.sql import functions as F

from fogline.schemas import RAW_311
from fogline.sources.files import read_json_snapshot
from fogline.sources.json_arrays import Cutter, Summary, UnreadableDocument, read_json_records


def nasty(n, seed):
    rng = random.Random(seed)
    texts = ["", "}", "{", '"', "\\", '\\"', "}\\\\", "[{]}", ",", "é😀", "a}b{c", 'say "hi}"', "\\\\\"}", "x" * 300]
    value = lambda depth: (
        rng.choice([1, None, True, -2.5, rng.choice(texts)])
        if depth == 0 or rng.random() < 0.5
        else {rng.choice(texts): value(depth - 1) for _ in range(rng.randrange(4))} if rng.random() < 0.5 else [value(depth - 1) for _ in range(rng.randrange(4))]
    )
    return [{"id": i, rng.choice(texts): value(3), "e": {}, "l": []} for i in range(n)]


def spelled(records, style):
    return json.dumps(records, ensure_ascii=style % 2 == 0, indent=[None, None, 1, None][style], separators=[None, (",", ":"), None, (" ,\n", " : ")][style])


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("style", range(4))
def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits, style):
    wanted = {}
    for name, n in (("a", 150), ("b", 1), ("c", 0), ("d", 60)):
        records = nasty(n, n + style)
        text = spelled(records, style)
        (tmp_path / f"{name}.json").write_text(("\ufeff" if name == "d" else "") + text + "\n", encoding="utf-8")
        wanted |= {(f"{name}.json", i): r for i, r in enumerate(records)}
    got = read_json_records(spark, str(tmp_path))
    rows = got.select(F.element_at(F.split("source_file", "/"), -1), "ordinal", "record").collect()
    assert len(rows) == len(wanted)
    assert {(f, o): json.loads(r) for f, o, r in rows} == wanted
    parts = spark.read.option("lineSep", "}").text(str(tmp_path / "a.json")).rdd.getNumPartitions()
    assert parts > 5


def test_records_longer_than_splits(spark, tmp_path, small_splits):
    records = [{"id": i, "t": ("}" * 5000 if i % 2 else "{\"" * 3000), "n": [{"x": "y" * 4000}]} for i in range(5)]
    (tmp_path / "a.json").write_text(json.dumps(records))
    got = {r["ordinal"]: json.loads(r["record"]) for r in read_json_records(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(records))


def test_typed_snapshot_over_splits(spark, tmp_path, small_splits):
    records = [{"service_request_id": str(i), "status_description": "Open}" * (i % 7), "lat": "1"} for i in range(400)]
    (tmp_path / "s.json").write_text(json.dumps(records))
    got = read_json_snapshot(spark, str(tmp_path / "s.json"), RAW_311).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["service_request_id"], r["status_description"]) for r in got] == [
        (i, r["service_request_id"], r["status_description"]) for i, r in enumerate(records)
    ]


@pytest.mark.parametrize(
    "text",
    ["", "  \n", "{}", '{"a": 1}', "5", '"x"', "[1, 2]", '[{"a": 1}', '[{"a": 1}]]', '[{"a": 1}] []', '[{"a": "x]', '[{"a": 1} {"a": 2}]', '[{"a": 1},,{"a": 2}]', '["}"]', "[{]}", "[{a}]"],
)
def test_what_is_no_array_of_records_stops_the_job(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception):
        read_json_snapshot(spark, str(tmp_path / "bad.json"), "a string").collect()


def test_summaries_give_the_beginning_of_every_part():
    records = nasty(40, 3)
    text = spelled(records, 1).encode()
    for seed in range(20):
        rng = random.Random(seed)
        ends = [i + 1 for i, c in enumerate(text) if c == ord("}")]
        cuts = sorted(rng.sample(ends[:-1], 6))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        inside = depth = ordinal = 0
        held, got = b"", []
        for part in parts:
            summary, cutter = Summary(), Cutter(inside, depth, ordinal)
            half = len(part) // 2
            while half < len(part) and part[half - 1 : half] != b"}":
                half += 1
            found = []
            for piece in (part[:half], part[half:]):
                summary.feed(piece)
                found += cutter.feed(piece)
            for o, begins, record in found:
                got.append((o, json.loads(record if begins else held + record)))
                held = b"" if not begins else held
            held = cutter.held if cutter.begins_whole else held + cutter.held
            ordinal += summary.closings[inside].get(1 - depth, 0)
            depth += summary.deeper[inside]
            inside ^= summary.odd
            assert (cutter.ordinal, cutter.depth, cutter.inside) == (ordinal, depth, inside)
        assert got == list(enumerate(records))


def test_cutter_refuses_text_between_records():
    with pytest.raises(UnreadableDocument):
        Cutter(0, 0, 0).feed(b'[{"a": 1}, x, {"b": 2}]')
