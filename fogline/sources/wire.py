"""Protobuf messages as columns: the wire format of many messages is scanned at once, field by field.

All messages of one kind in a batch move on together: a step reads one field of each of them, with array operations on the bytes
of the whole batch. The fields found are arrays of (message, number, value); the submessages among them are the messages of the
next scan. What a scan cannot vouch for is marked, message by message, and left to a full parser.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VARINT, FIXED64, BYTES, FIXED32 = 0, 1, 2, 5
#: Wire types of the kinds of fields; any other name is a message.
KINDS = {"string": BYTES, "uint32": VARINT, "uint64": VARINT, "int32": VARINT, "int64": VARINT, "enum": VARINT, "float": FIXED32}
_KNOWN = np.isin(np.arange(8), (VARINT, FIXED64, BYTES, FIXED32))
#: With fewer messages left than this, their fields are read one by one.
NARROW = 24
#: Bytes that a read may go beyond the end of the messages.
PADDING = 16


@dataclass
class Fields:
    """Field occurrences: message, field number, wire type; the value, or where the bytes begin, and where they end."""

    message: np.ndarray
    number: np.ndarray
    wire: np.ndarray
    value: np.ndarray
    stop: np.ndarray


def _varints(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, places after them) of varints that begin at these places; one of more than ten bytes ends nowhere."""
    byte = data[at]
    value = (byte & 0x7F).astype(np.uint64)
    after = at + 1
    more = np.flatnonzero(byte >= 0x80)
    for shift in range(7, 70, 7):
        if not len(more):
            break
        byte = data[after[more]]
        value[more] |= (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
        after[more] += 1
        more = more[byte >= 0x80]
        # A varint over the end is found by its place; reading goes on inside the padding only.
        more = more[after[more] < len(data)]
    after[more] = len(data) + 1
    return value, after


def _one_by_one(data: memoryview, at: int, end: int) -> tuple[list[tuple[int, int, int, int]], bool]:
    """Fields of one message and whether all of it could be read."""
    found = []

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 0x7F) << shift
            at += 1
            if byte < 0x80:
                return value & 0xFFFFFFFFFFFFFFFF, at
            shift += 7
            if shift > 63 or at >= end:
                return 0, end + 1

    while at < end:
        tag, at = varint(at)
        number, wire = tag >> 3, tag & 7
        if at > end or not 0 < number < 1 << 29:
            return found, False
        if wire == VARINT:
            if at >= end:
                return found, False
            value, at = varint(at)
            stop = at
        elif wire == BYTES:
            if at >= end:
                return found, False
            size, value = varint(at)
            stop = at = value + size
        elif wire in (FIXED32, FIXED64):
            value, at = at, at + (4 if wire == FIXED32 else 8)
            stop = at
        else:
            return found, False
        if at > end:
            return found, False
        found.append((number, wire, value, stop))
    return found, True


def scan(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[Fields, np.ndarray]:
    """All fields of the messages at data[start:end], in order within a message, and which messages could not be read.

    ``data`` has PADDING bytes more than the messages. A message that could not be read may have given some fields.
    """
    bad = np.zeros(len(start), bool)
    parts: list[tuple] = []
    live = np.flatnonzero(start < end)
    at = start.astype(np.int64).copy()
    view = memoryview(data)
    while len(live):
        if len(live) < NARROW:
            for m in live.tolist():
                found, whole = _one_by_one(view, int(at[m]), int(end[m]))
                bad[m] |= not whole
                if found:
                    kinds = (np.int64, np.int64, np.uint64, np.int64)
                    parts.append((np.full(len(found), m), *(np.array(c, k) for c, k in zip(zip(*found), kinds))))
            break
        tag, place = _varints(data, at[live])
        number, wire = (tag >> np.uint64(3)).astype(np.int64), (tag & np.uint64(7)).astype(np.int64)
        # A value needs a byte to begin with.
        fine = (place < end[live]) & (number > 0) & (number < 1 << 29) & _KNOWN[wire]
        place = np.minimum(place, len(data) - PADDING)
        value, after = _varints(data, np.where(fine, place, 0))
        stop = after
        sized = np.flatnonzero(wire == BYTES)
        if len(sized):
            room = end[live[sized]] - after[sized]
            size = value[sized]
            fits = (room >= 0) & (size <= np.maximum(room, 0).astype(np.uint64))
            fine[sized[~fits]] = False
            value[sized] = after[sized].astype(np.uint64)
            stop = after.copy()
            stop[sized] += np.where(fits, size, 0).astype(np.int64)
        fixed = np.flatnonzero((wire == FIXED32) | (wire == FIXED64))
        if len(fixed):
            stop = stop.copy()
            stop[fixed] = place[fixed] + np.where(wire[fixed] == FIXED32, 4, 8)
            value[fixed] = place[fixed].astype(np.uint64)
        fine &= stop <= end[live]
        found = (live, number, wire, value, stop)
        if not fine.all():
            bad[live[~fine]] = True
            found = tuple(c[fine] for c in found)
        parts.append(found)
        live = found[0]
        at[live] = found[4]
        live = live[found[4] < end[live]]
    columns = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(5)]
    # Messages do not overlap and come in the order of their bytes, so fields do in the order of theirs.
    order = np.argsort(columns[4], kind="stable")
    return Fields(*(c[order] for c in columns)), bad


@dataclass
class Messages:
    """Messages of one kind: the file each is in, its parent message, its fields by name."""

    file: np.ndarray
    parent: np.ndarray
    scalars: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]
    children: dict[str, "Messages"]

    def __len__(self) -> int:
        return len(self.file)

    def value(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        """(values as unsigned longs, which messages have the field)."""
        message, value, _ = self.scalars[name]
        out, has = np.zeros(len(self), np.uint64), np.zeros(len(self), bool)
        out[message], has[message] = value, True
        return out, has

    def only(self, name: str) -> np.ndarray:
        """For each message the place of its one submessage among ``children[name]``, -1 where it has none."""
        out = np.full(len(self), -1)
        child = self.children[name]
        out[child.parent] = np.arange(len(child))
        return out

    def strings(self, data: np.ndarray, name: str) -> pa.Array:
        """The text of each message, NULL where it has none or an empty one. Bytes that are no UTF-8 raise ArrowInvalid."""
        message, start, stop = self.scalars[name]
        first, last = np.zeros(len(self), np.int64), np.zeros(len(self), np.int64)
        first[message], last[message] = start.astype(np.int64), stop
        size = last - first
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(first - (ends - size), size) + np.arange(total)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        flat = pa.Array.from_buffers(pa.binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[places]))])
        text = flat.cast(pa.string())
        return pc.if_else(pa.array(size > 0), text, pa.scalar(None, pa.string()))


def read_messages(
    spec: dict[str, list[tuple[str, int, str, str]]],
    kind: str,
    data: np.ndarray,
    start: np.ndarray,
    end: np.ndarray,
    file: np.ndarray,
    doubtful: np.ndarray,
    parent: np.ndarray | None = None,
) -> Messages:
    """Messages of a kind with all their submessages. ``doubtful`` (per file) is set for files a full parser must read.

    ``spec`` lists (name, number, label, type) of the fields of each kind. Fields that it does not name are skipped. Doubtful are
    files with bytes that do not parse, groups, fields of another wire type than theirs, and repeats of a field that may occur once.
    """
    fields, bad = scan(data, start, end)
    doubtful[file[bad]] = True
    scalars, children = {}, {}
    for name, number, label, type_ in spec[kind]:
        hit = fields.number == number
        odd = hit & (fields.wire != KINDS.get(type_, BYTES))
        if odd.any():
            doubtful[file[fields.message[odd]]] = True
            hit &= ~odd
        hit = np.flatnonzero(hit)
        message, value, stop = fields.message[hit], fields.value[hit], fields.stop[hit]
        if label != "repeated" and len(message) > 1:
            doubtful[file[message[1:][message[1:] == message[:-1]]]] = True
        if type_ in KINDS:
            scalars[name] = message, value, stop
        else:
            children[name] = read_messages(spec, type_, data, value.astype(np.int64), stop, file[message], doubtful, message)
    return Messages(file, np.zeros(len(start), np.int64) if parent is None else parent, scalars, children)


def padded(contents: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with padding, starts, ends) of a binary column; NULL is empty."""
    contents = contents.fill_null(b"")
    offsets = np.frombuffer(contents.buffers()[1], np.int32)[contents.offset : contents.offset + len(contents) + 1].astype(np.int64)
    values = contents.buffers()[2]
    data = np.zeros(int(offsets[-1] - offsets[0]) + PADDING, np.uint8)
    if values is not None:
        data[: len(data) - PADDING] = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
