"""Repair of conversations: the cheapest edits that make the roles follow one another, by auction shortest paths.

The roles of a repaired conversation are ``(system? (user assistant)+)?``. Edits walk a lattice: rows that are done times
what came last. Keep, rerole and delete go on by a row, insert stays; each arc has an integer cost. In the state of a
node only one role may be inserted or given, so the edits' letters name a path.

Auction: a path grows from its origin; every node has a price. The end of the path takes the arc with the least cost plus price of
its head. If that is more than the end's own price, the price rises to it and the path gives up the node, else it goes on to the head. When
it reaches the end, the price of the origin is the cost of the cheapest edits. Prices never pass cost plus price of an arc, so
all arcs of all cheapest paths are tight (price = cost + price of the head); following the least letter among the tight arcs from which
tight arcs lead to the end gives the least of the cheapest strings of edits. Prices start from what each row costs at least.

Scale: rows are spread by ranges of (conversation, turn, role, text), so a conversation with a third of all rows lies in many pieces.
A piece's part of a conversation is a run, cut into blocks of ``BLOCK`` rows, each a lattice of its own whose end has four
exits with prices: those of the next block's entries. Only conversations that cross a border of pieces (at most one per
border) exchange more: the four by four costs of their runs, chained from the last to the first, then the chosen entries, chained back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fogline.session import cut_lineage

#: Rows of a block, lattices whose solution a task remembers.
BLOCK, REMEMBERED = 64, 1 << 16
#: What came last: nothing, system, user, assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The only role that may be inserted or given after each of them.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
STEPS = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: More than any cost; the exits of the last run: a conversation may end with nothing or an assistant.
NEVER = 1 << 60
ENDS = (0, NEVER, NEVER, 0)
SPACES = "\t\n\x0b\x0c\r "
LEGAL = ("su", "ua", "au")
#: Rows as letters: the role's initial, a capital where truncated; what must go.
BLANK, DUPLICATE, OTHER = "x", "y", "o"


def damage_turns(turns: DataFrame) -> DataFrame:
    """Rows with faults put in by a hash of conversation and turn: dropped, emptied, unended, repeated or said by the user.

    NULLs become one space, in the hash, the role and the text.
    """
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn"))) % 20
    rows = turns.select("conv_id", "turn", as_text("role").alias("role"), as_text("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")
    ).drop("copy")


class Found(NamedTuple):
    """The cheapest way from one entry: its cost, its letters, the state it leaves in."""

    cost: int
    audit: str
    leaves: int


def arcs_of(symbols: str, last: bool) -> list[list[tuple[str, int, int]]]:
    """(letter, cost, head) of every node, letters in order; node 4 i + q: i rows done, q came last."""
    arcs: list[list[tuple[str, int, int]]] = []
    for i in range(len(symbols) + 1):
        for q in range(4):
            out = []
            if i < len(symbols):
                out.append(("D", 3, 4 * (i + 1) + q))
            # What is inserted between two blocks belongs to the later one.
            if i < len(symbols) or last:
                out.append(("I", 2, 4 * i + NEXT[q]))
            if i < len(symbols) and symbols[i] not in (BLANK, DUPLICATE):
                truncated = int(symbols[i].isupper())
                kept = STEPS.get((q, symbols[i].lower()))
                if kept is not None:
                    out.append(("K", truncated, 4 * (i + 1) + kept))
                out.append(("R", 2 + truncated, 4 * (i + 1) + NEXT[q]))
            arcs.append(out)
    return arcs


def auction(arcs: list[list[tuple[str, int, int]]], prices: list[int], origin: int, end: int) -> None:
    """Raise ``prices`` until a path of tight arcs leads from ``origin`` to ``end``, which must be in reach."""
    path = [origin]
    while path[-1] != end:
        node = path[-1]
        best, head = min((cost + prices[to], to) for _, cost, to in arcs[node])
        if best > prices[node]:
            prices[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(head)


def leading(arcs: list[list[tuple[str, int, int]]], end: int) -> set[int]:
    """The nodes from which ``arcs`` lead to ``end``; within a row at most three insertions follow one another."""
    found = {end}
    for row in reversed(range(0, end, 4)):
        for _ in range(4):
            found.update(v for v in range(row, row + 4) if any(to in found for _, _, to in arcs[v]))
    return found


def solve_block(symbols: str, exits: tuple[int, ...], last: bool) -> tuple[Found, ...]:
    """For each of the four entries the cheapest, then least, edits of a block whose exits have these prices."""
    n = len(symbols)
    arcs = arcs_of(symbols, last)
    end = 4 * (n + 1)
    for q in range(4):
        if exits[q] < NEVER:
            arcs[4 * n + q].append(("", exits[q], end))
    least = [min(exits)]
    for s in reversed(symbols):
        least.append(least[-1] + (3 if s in (BLANK, DUPLICATE) else int(s.isupper())))
    # Prices of nodes without a way to the end would rise for ever.
    open_ = leading(arcs, end)
    prices = [least[n - v // 4] if v in open_ else NEVER for v in range(end)] + [0]
    for q in range(4):
        if q in open_:
            auction(arcs, prices, q, end)
    alive = leading(tight := [[(a, c, to) for a, c, to in out if prices[v] == c + prices[to]] for v, out in enumerate(arcs)], end)
    found = []
    for q in range(4):
        if q not in alive:
            found.append(Found(NEVER, "", NOTHING))
            continue
        node, letters = q, []
        while True:
            letter, to = next((a, t) for a, _, t in tight[node] if t in alive)
            if to == end:
                found.append(Found(prices[q], "".join(letters), node % 4))
                break
            letters.append(letter)
            node = to
    return tuple(found)


class Solver:
    """Solves runs block by block; lattices that were met before are looked up."""

    def __init__(self) -> None:
        self.known: dict[tuple, tuple[Found, ...]] = {}

    def block(self, symbols: str, exits: tuple[int, ...], last: bool) -> tuple[Found, ...]:
        base = min(exits)
        if base >= NEVER:
            return (Found(NEVER, "", NOTHING),) * 4
        key = symbols, tuple(e - base if e < NEVER else NEVER for e in exits), last
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[key] = solve_block(*key)
        return tuple(f._replace(cost=f.cost + base) if f.cost < NEVER else f for f in found)

    def run(self, symbols: str, exits: tuple[int, ...], last: bool) -> tuple[Found, ...]:
        """For each entry of a run the cheapest, then least, edits to exits with these prices."""
        starts = range(0, len(symbols), BLOCK)
        solved = []
        for at in reversed(starts):
            solved.append(self.block(symbols[at : at + BLOCK], exits, last and at == starts[-1]))
            exits = tuple(f.cost for f in solved[-1])
        out = []
        for q in range(4):
            state, audit = q, []
            for found in reversed(solved):
                if found[state].cost >= NEVER:
                    break
                audit.append(found[state].audit)
                state = found[state].leaves
            out.append(Found(exits[q], "".join(audit), state) if exits[q] < NEVER else Found(NEVER, "", NOTHING))
        return tuple(out)

    def costs(self, symbols: str) -> list[int]:
        """Cost of a run that is not the last from each entry (rows) to each exit (columns)."""
        columns = [[f.cost for f in self.run(symbols, tuple(0 if e == x else NEVER for e in range(4)), False)] for x in range(4)]
        return [columns[x][q] for q in range(4) for x in range(4)]


def trace(audit: str, symbols: str, state: int) -> Iterator[tuple[int, str, str | None]]:
    """(row, letter, role given or inserted) of each edit; insertions carry the row they come before."""
    i = 0
    for letter in audit:
        if letter == "I" or letter == "R":
            state = NEXT[state]
        elif letter == "K":
            state = STEPS[state, symbols[i].lower()]
        yield i, letter, NAMES[state] if letter in "IR" else None
        i += letter != "I"


def symbol(role: str, text: str, seen: bool) -> str:
    """A row as one letter."""
    said = text.strip(SPACES)
    if not said:
        return BLANK
    if seen:
        return DUPLICATE
    initial = role[:1] if role[:1] in ("s", "u", "a") else OTHER
    return initial if said[-1] in ".!?" else initial.upper()


_ORDER = ("conv_id", "turn", "role", "text", "arrival")
_ROWS = "conv_id long, piece int, at long, turn long, role string, text string, symbol string"


def number_rows(turns: DataFrame) -> DataFrame:
    """The rows in order, numbered in pieces, each with the letter that its piece alone gives it; pinned."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        as_text("role"),
        as_text("text"),
        # Only there to let borders fall between equal rows.
        F.monotonically_increasing_id().alias("arrival"),
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, at, now, seen = TaskContext.get().partitionId(), 0, object(), set()
        for batch in batches:
            letters = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != now:
                    now, seen = conv, set()
                letters.append(symbol(role, text, (role, text) in seen))
                seen.add((role, text))
            n = len(letters)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array([piece] * n, pa.int32()),
                    pa.array(range(at, at + n), pa.int64()),
                    *(batch.column(c) for c in ("turn", "role", "text")),
                    pa.array(letters, pa.string()),
                ],
                ["conv_id", "piece", "at", "turn", "role", "text", "symbol"],
            )
            at += n

    return cut_lineage(rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).mapInArrow(number, _ROWS))


def _attach(left: DataFrame, right: DataFrame, *keys: str, how: str = "left", small: bool = False) -> DataFrame:
    """``left`` with the other columns of ``right``, joined on conv_id (NULLs equal) and ``keys``."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in ("conv_id", *keys)})
    condition = F.col("conv_id").eqNullSafe(F.col("__conv_id"))
    for key in keys:
        condition &= F.col(key) == F.col(f"__{key}")
    return left.join(F.broadcast(renamed) if small else renamed, condition, how).drop(*(f"__{k}" for k in ("conv_id", *keys)))


def repair_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, piece, at, sub, turn, given_role, fault, edit, cost, role, text), one row per edit.

    ``turns``: rows of conv_id, turn, role, text. Within a conversation they are in order of turn (NULL first), then role,
    then text; repeated rows follow one another. A NULL role or text is one space; rows with a NULL conv_id form one conversation. Other
    columns are ignored. A conversation without rows is not there; an empty table gives an empty result.

    ``fault``: blank (nothing but white space), duplicate (role and text seen earlier in the conversation), truncated
    (does not end with one of .!?), or NULL; the first that holds counts. ``edit``: K keep, R another role, D delete, I insert
    an empty text. Blank rows and duplicates are deleted. Costs: K 0, R and I 2, D 3, and 1 more for a truncated row that stays. The edits
    cost least in all; of equally cheap ones, their letters are least. Their order is (piece, at, sub). ``role`` and ``text`` are
    those after the edit, for D the given ones. Roles count by their first letter: s, u, a, any other is none of the three.
    """
    rows = number_rows(turns)
    # At most one conversation lies across each border of two pieces, so these are fewer than the pieces.
    across = rows.groupBy("conv_id").agg(F.min("piece").alias("p0"), F.max("piece").alias("p9")).where("p0 < p9").select("conv_id")
    across = cut_lineage(across.withColumn("across", F.lit(True)))
    tagged = _attach(rows, across, small=True).withColumn("across", F.coalesce("across", F.lit(False)))
    marks = ("conv_id", "piece", "at", "symbol", "across")
    certain = F.col("symbol").isin(BLANK, DUPLICATE)
    settled = tagged.where(~F.col("across") | certain).select(*marks)
    # First in its piece, but an earlier piece may hold the same; each key has one row per piece at most.
    open_ = tagged.where(F.col("across") & ~certain).select(*marks, "role", "text")
    firsts = open_.groupBy("conv_id", "role", "text").agg(F.min("piece").alias("p0"))
    met = F.when(F.col("piece") > F.col("p0"), DUPLICATE).otherwise(F.col("symbol"))
    again = _attach(open_, firsts, "role", "text").withColumn("symbol", met).select(*marks)
    listed = F.sort_array(F.collect_list(F.struct("at", "symbol")))
    runs = cut_lineage(
        settled.unionByName(again)
        .groupBy("conv_id", "piece", "across")
        .agg(F.min("at").alias("first"), F.array_join(F.transform(listed, lambda r: r["symbol"]), "").alias("symbols"))
    )
    # One row per piece and conversation that crosses its border: two per piece at most.
    priced = _attach(runs, _chain_costs(runs.where("across")), "piece", small=True)
    ways = cut_lineage(_solve(priced))
    single = ways.where(~F.col("across"))
    entries = _chain_entries(ways.where("across"))
    crossing = _attach(ways.where("across"), entries, "piece", "entry", how="left_semi", small=True)
    edits = _expand(single.unionByName(crossing))
    inserted = edits.where("edit = 'I'").select(*edits.columns, F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("given_role"), F.lit("").alias("text"))
    given = rows.select("piece", "at", "turn", F.col("role").alias("given_role"), "text")
    others = edits.where("edit <> 'I'").join(given, ["piece", "at"]).select(*edits.columns, "turn", "given_role", "text")
    stays = F.when(F.col("edit").isin("K", "R") & (F.col("symbol") == F.upper("symbol")), 1).otherwise(0)
    cost = F.when(F.col("edit") == "K", 0).when(F.col("edit") == "D", 3).otherwise(2) + stays
    fault = (
        F.when(F.col("edit") == "I", F.lit(None)).when(F.col("symbol") == BLANK, "blank").when(F.col("symbol") == DUPLICATE, "duplicate").when(F.col("symbol") == F.upper("symbol"), "truncated")
    )
    return others.unionByName(inserted).select(
        "conv_id", "piece", "at", "sub", "turn", "given_role", fault.alias("fault"), "edit", cost.cast("long").alias("cost"), F.coalesce("role", "given_role").alias("role"), "text"
    )


def _chain_costs(runs: DataFrame) -> DataFrame:
    """(conv_id, piece, exits, opens, closes): prices of the exits of each run of the conversations that have several."""

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver()
        for batch in batches:
            found = [solver.costs(s) for s in batch.column("symbols").to_pylist()]
            ends = [[f.cost for f in solver.run(s, ENDS, True)] for s in batch.column("symbols").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("piece"), pa.array(found, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))],
                ["conv_id", "piece", "costs", "ends"],
            )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, listed in zip(batch.column("conv_id").to_pylist(), batch.column("runs").to_pylist()):
                exits = ENDS
                for k in reversed(range(len(listed))):
                    out.append((conv, listed[k]["piece"], exits, k == 0, k == len(listed) - 1))
                    if k == len(listed) - 1:
                        exits = tuple(listed[k]["ends"])
                    else:
                        between = listed[k]["costs"]
                        exits = tuple(min(NEVER, *(between[4 * q + x] + exits[x] for x in range(4))) for q in range(4))
            conv, piece, prices, opens, closes = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(conv, pa.int64()),
                    pa.array(piece, pa.int32()),
                    pa.array([list(p) for p in prices], pa.list_(pa.int64())),
                    pa.array(opens, pa.bool_()),
                    pa.array(closes, pa.bool_()),
                ],
                ["conv_id", "piece", "exits", "opens", "closes"],
            )

    each = runs.select("conv_id", "piece", "symbols").mapInArrow(costs, "conv_id long, piece int, costs array<long>, ends array<long>")
    # One row of 20 numbers per piece that the conversation touches.
    together = each.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("piece", "costs", "ends"))).alias("runs"))
    return together.mapInArrow(chain, "conv_id long, piece int, exits array<long>, opens boolean, closes boolean")


def _solve(priced: DataFrame) -> DataFrame:
    """(conv_id, piece, across, first, symbols, entry, leaves, audit): the edits of each run for each entry it may have."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver()
        for batch in batches:
            at, entry, leaves, audit = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("symbols", "exits", "opens", "closes"))
            for row, (symbols, exits, opens, closes) in enumerate(zip(*columns)):
                whole = exits is None
                found = solver.run(symbols, ENDS if whole else tuple(exits), whole or closes)
                for q in (NOTHING,) if whole or opens else range(4):
                    at.append(row)
                    entry.append(q)
                    leaves.append(found[q].leaves)
                    audit.append(found[q].audit)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(rows) for c in ("conv_id", "piece", "across", "first", "symbols")),
                    pa.array(entry, pa.int32()),
                    pa.array(leaves, pa.int32()),
                    pa.array(audit, pa.string()),
                ],
                ["conv_id", "piece", "across", "first", "symbols", "entry", "leaves", "audit"],
            )

    return priced.mapInArrow(
        solve, "conv_id long, piece int, across boolean, first long, symbols string, entry int, leaves int, audit string"
    )


def _chain_entries(ways: DataFrame) -> DataFrame:
    """(conv_id, piece, entry): the entry each run is come into by, from the conversation's first run on."""

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, listed in zip(batch.column("conv_id").to_pylist(), batch.column("ways").to_pylist()):
                leaves = {(w["piece"], w["entry"]): w["leaves"] for w in listed}
                state = NOTHING
                for piece in sorted({w["piece"] for w in listed}):
                    out.append((conv, piece, state))
                    state = leaves[piece, state]
            conv, piece, entry = zip(*out) if out else ((),) * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv, pa.int64()), pa.array(piece, pa.int32()), pa.array(entry, pa.int32())], ["conv_id", "piece", "entry"]
            )

    together = ways.groupBy("conv_id").agg(F.collect_list(F.struct("piece", "entry", "leaves")).alias("ways"))
    return together.mapInArrow(chain, "conv_id long, piece int, entry int")


def _expand(ways: DataFrame) -> DataFrame:
    """(conv_id, piece, at, sub, edit, role, symbol): every edit of the chosen ways."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                sub, row = 0, -1
                for i, letter, role in trace(r["audit"], r["symbols"], r["entry"]):
                    sub, row = (sub + 1, row) if i == row else (0, i)
                    out.append((r["conv_id"], r["piece"], r["first"] + i, sub, letter, role, None if letter == "I" else r["symbols"][i]))
            columns = zip(*out) if out else ((),) * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "piece", "at", "sub", "edit", "role", "symbol"]
            )

    return ways.mapInArrow(expand, "conv_id long, piece int, at long, sub int, edit string, role string, symbol string")


def summarise(edits: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for every conv_id of ``conversations``: gaps, counts of faults, cost, the edits' letters, digest of the repaired text.

    ``edits`` are those of ``repair_conversations``. Rows of a conversation stream past a digest in their order; nothing of
    them is held but the letters, which are part of the result.
    """
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    marks = ids.withColumn("piece", F.lit(-1))
    rows = edits.unionByName(marks, allowMissingColumns=True)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "piece", "at", "sub")
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Summary | None = None
        for batch in batches:
            done = []
            for r in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "piece", "turn", "given_role", "fault", "edit", "cost", "role", "text"))):
                if now is None or r[0] != now.conv_id:
                    done += [now.row()] if now else []
                    now = _Summary(r[0])
                if r[1] >= 0:
                    now.add(*r[2:])
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(now.row(), kinds)], names)

    return ordered.mapInArrow(
        summaries,
        "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string",
    )


class _Summary:
    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.least = self.turn = self.before = None
        self.distinct = self.illegal = self.cost = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.audit: list[str] = []
        self.digest, self.begun = hashlib.sha256(), False

    def add(self, turn, given_role, fault, edit, cost, role, text) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit != "I":
            if turn is not None and turn != self.turn:
                self.least = turn if self.least is None else self.least
                self.turn, self.distinct = turn, self.distinct + 1
            if fault:
                self.faults[fault] += 1
            initial = given_role[:1]
            self.illegal += self.before is not None and self.before + initial not in LEGAL
            self.before = initial
        if edit != "D":
            self.digest.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
            self.begun = True

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.turn - self.least + 1 - self.distinct
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())
