import random

import numpy as np
import pyarrow as pa
import pytest

from fogline.sources import gtfs, wire

KINDS = {
    "trips": (gtfs._TRIP_UPDATE_SCHEMA, gtfs._trip_update_columns, gtfs._trip_update_rows),
    "vehicles": (gtfs._VEHICLE_SCHEMA, gtfs._vehicle_columns, gtfs._vehicle_rows),
}


def message(rng, sound=False):
    feed = gtfs.feed_message_class()()
    text = lambda: rng.choice(["", "a", "é😀", "x" * 200, "Route 5"])
    maybe = lambda p=0.7: rng.random() < p
    if maybe():
        feed.header.gtfs_realtime_version = "2.0"
        if maybe():
            feed.header.timestamp = rng.choice([0, 1, 1_782_172_800, gtfs.MAX_EPOCH, gtfs.MAX_EPOCH + 1, 2**64 - 1])

    def trip(t):
        for name in ("trip_id", "start_time", "start_date", "route_id"):
            if maybe():
                setattr(t, name, text())
        if maybe():
            t.direction_id = rng.choice([0, 1, 2**32 - 1])

    for _ in range(rng.choice([0, 1, 3, 40])):
        entity = feed.entity.add(id=text())
        if maybe():
            trip(entity.trip_update.trip)
            if maybe(0.2):
                entity.trip_update.vehicle.label = text()
            for _ in range(rng.choice([0, 1, 2, 30])):
                stop = entity.trip_update.stop_time_update.add()
                if maybe(0.9):
                    stop.stop_sequence = rng.choice([0, 7, 300, 2**32 - 1])
                if maybe(0.9):
                    stop.stop_id = text()
                for event in (stop.arrival, stop.departure):
                    if maybe():
                        event.SetInParent()
                    if maybe():
                        event.delay = rng.choice([0, -1, 5, -(2**31), 2**31 - 1])
                    if maybe():
                        event.time = rng.choice([0, -5, 1_782_172_860, gtfs.MAX_EPOCH if sound or rng.random() < 0.95 else gtfs.MAX_EPOCH + 1])
        if maybe():
            v = entity.vehicle
            if maybe():
                trip(v.trip)
            if maybe():
                v.position.latitude, v.position.longitude = rng.uniform(-90, 90), rng.uniform(-180, 180)
            if maybe(0.3):
                v.position.speed = 3.25
            if maybe():
                v.current_stop_sequence, v.stop_id = 4, text()
            if maybe():
                v.current_status = rng.randrange(3)
            if maybe():
                v.timestamp = rng.choice([5, 1_782_172_800, 2**63, 2**64 - 1])
            if maybe():
                v.vehicle.id, v.vehicle.label = text(), text()
    return feed.SerializePartialToString()


def damaged(rng, content):
    if not content:
        return content
    kind = rng.randrange(6)
    at = rng.randrange(len(content))
    if kind == 0:
        return content[:at]
    if kind == 1:
        return content[:at] + bytes([rng.randrange(256)]) + content[at + 1 :]
    if kind == 2:
        return content + bytes(rng.randrange(256) for _ in range(3))
    if kind == 3:
        return content + content  # submessages that may occur once, twice
    if kind == 4:
        return content + b"\x9a\x06\x03abc" + b"\xa0\x06\x96\x01" + b"\xad\x06abcd" + b"\xa9\x06abcdefgh"  # fields nobody knows
    return b"\xff" * rng.randrange(1, 12)


def files(contents):
    n = len(contents)
    return pa.RecordBatch.from_arrays(
        [pa.array(["muni"] * n), pa.array([None] * n, pa.date32()), pa.array(range(n), pa.int64()), pa.array([f"f{i}" for i in range(n)]), pa.array(contents, pa.binary())],
        ["agency_id", "source_date", "blob_order", "blob_name", "content"],
    )


def by_column(batch, kind):
    schema, columns_of, rows_of = KINDS[kind]
    return [r for part in gtfs._by_column(batch, schema, columns_of, rows_of) for r in part.to_pylist()]


def by_message(batch, kind):
    schema, _, rows_of = KINDS[kind]
    out = []
    for source in batch.to_pylist():
        head, rows = gtfs._by_message(source, rows_of)
        out += [{f.name: r.get(f.name) for f in schema} for r in [head, *rows]]
    return out


@pytest.mark.parametrize("kind", sorted(KINDS))
@pytest.mark.parametrize("seed", range(12))
def test_columns_equal_the_full_parser(kind, seed):
    rng = random.Random(seed)
    contents = [message(rng) for _ in range(rng.choice([1, 5, 60]))]
    if seed % 2:
        contents = [damaged(rng, c) if rng.random() < 0.4 else c for c in contents] + [None, b""]
    batch = files(contents)
    order = lambda rows: sorted(rows, key=lambda r: (r["blob_order"], r["kind"] == "row"))
    assert order(by_column(batch, kind)) == order(by_message(batch, kind))


def test_sound_files_never_reach_the_full_parser(monkeypatch):
    rng = random.Random(3)
    sound = [message(rng, sound=True) for _ in range(30)]
    want = by_message(files(sound), "trips")
    monkeypatch.setattr(gtfs, "_by_message", lambda *a: pytest.fail("full parser"))
    batch = files(sound)
    got = by_column(batch.slice(3, 20), "trips")
    assert sorted(r["blob_order"] for r in got if r["kind"] == "file") == list(range(3, 23))
    assert [r for r in got if r["kind"] == "row" and r["blob_order"] == 7] == [r for r in want if r["kind"] == "row" and r["blob_order"] == 7]


def test_text_that_is_no_utf8_is_an_error_of_its_file_only():
    feed = gtfs.feed_message_class()()
    feed.entity.add(id="1").trip_update.trip.trip_id = "abc"
    good = feed.SerializePartialToString()
    batch = files([good, good.replace(b"abc", b"\xff\xfeb"), good])
    assert by_column(batch, "trips") == by_message(batch, "trips")


def test_numbers_of_all_lengths():
    rng = random.Random(1)
    values = [rng.getrandbits(rng.randrange(1, 65)) for _ in range(200)] + [0, 127, 128, 2**64 - 1]

    def varint(v):
        out = b""
        while True:
            v, low = v >> 7, v & 127
            out += bytes([low | (128 if v else 0)])
            if not v:
                return out

    parts = [b"\x08" + varint(v) for v in values]
    data = np.frombuffer(b"".join(parts) + bytes(wire.PADDING), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    fields, bad = wire.scan(data, ends - [len(p) for p in parts], ends)
    assert not bad.any() and fields.value.tolist() == values and set(fields.number.tolist()) == {1}


def test_times_out_of_range_are_counted():
    feed = gtfs.feed_message_class()()
    feed.header.gtfs_realtime_version, feed.header.timestamp = "2.0", gtfs.MAX_EPOCH + 1
    for stamp in (5, gtfs.MAX_EPOCH + 1, 2**64 - 1):
        feed.entity.add(id="1").vehicle.timestamp = stamp
    batch = files([feed.SerializeToString(), b""])
    got = by_column(batch, "vehicles")
    assert [(r["epochs_out_of_range"], r["header_epoch"]) for r in got if r["kind"] == "file"] == [(3, None), (0, None)]
    assert got == by_message(batch, "vehicles") or sorted(map(str, got)) == sorted(map(str, by_message(batch, "vehicles")))
