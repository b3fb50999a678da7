"""Secret scans with an incremental ledger of blobs.

Method: a text is a blob with the SHA-256 of its bytes as its address. The ledger says which (blob, rules version) pairs
have been scanned and what was found. Only blobs missing there are read again; findings are joined back to every row
(path, version) that holds the blob. Rows with the same text are one blob however many there are: the copies are
reduced to one address before anything is joined, so a hot blob costs one scan and one row per task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fogline.llm.batches import slices, texts

#: Changes whenever a pattern changes.
RULES_VERSION = 1

#: Kinds in the order in which equal starts are listed, their patterns, and the least length of a group.
_KINDS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
    ("pem", re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"), 0, 1),
    ("jwt", None, 0, 1),
    ("forge", re.compile(r"(?:gh[pousr]_|glpat-|xox[abprs]-)[A-Za-z0-9_-]{20,}"), 0, 1),
)
#: Runs of a token's characters, parted by single dots; each run is looked at once.
_DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]++){2,}")
BASE_KINDS = ("assign", "access", "hex")
#: A text without any of these has no span of the kind. Lower case ones are looked for in the lower-cased text.
_NEEDED = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("AKIA",),
    "pem": ("PRIVATE KEY-----",),
    "jwt": ("eyJ",),
    "forge": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "glpat-", "xox"),
}


def _web_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Spans of eyJ and 8 characters or more, a dot, 8 or more, a dot, 8 or more, leftmost first; linear in the text."""
    for m in _DOTTED.finditer(text):
        parts, start, i = m.group().split("."), m.start(), 0
        starts = [start]
        for part in parts:
            starts.append(starts[-1] + len(part) + 1)
        while i + 2 < len(parts):
            at = parts[i].find("eyJ")
            if at >= 0 and len(parts[i]) - at >= 11 and len(parts[i + 1]) >= 8 and len(parts[i + 2]) >= 8:
                yield starts[i] + at, starts[i + 3] - 1
                i += 3
            else:
                i += 1


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans by start, then kind; code points, end exclusive."""
    found = []
    low = text.lower()
    for place, (kind, pattern, group, least) in enumerate(_KINDS):
        needed = _NEEDED.get(kind)
        if needed and not any(x in (low if kind == "assign" else text) for x in needed):
            continue
        if pattern is None:
            found += [(start, place, kind, end) for start, end in _web_tokens(text)]
            continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), place, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def blobs_of(docs: DataFrame) -> DataFrame:
    """(doc_id, blob): the address of each row's text; NULL is the empty text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"))


_SPANS = "array<struct<kind:string,start:long,end:long>>"
LEDGER = f"blob string, rules_version int, spans {_SPANS}"


def scan_unseen(docs: DataFrame, ledger: DataFrame | None = None, rules_version: int = RULES_VERSION) -> DataFrame:
    """Rows to append to the ledger (blob, rules_version, spans): each blob of ``docs`` not scanned with these rules.

    One row of ``docs`` per unseen blob is read: the one with the smallest doc_id (blobs of rows without doc_id too). Empty
    ``docs`` or nothing unseen: no rows.
    """
    todo = blobs_of(docs).groupBy("blob").agg(F.min("doc_id").alias("__from"))
    if ledger is not None:
        seen = ledger.where(F.col("rules_version") == rules_version).select("blob")
        todo = todo.join(seen, "blob", "left_anti")
    read = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(todo.select("__from", F.col("blob").alias("__blob")), F.col("doc_id").eqNullSafe(F.col("__from")))
        .where(F.sha2("text", 256) == F.col("__blob"))
        .select(F.col("__blob").alias("blob"), "text")
    )
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t)] for t in texts(part)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("blob"), pa.array([rules_version] * len(part), pa.int32()), pa.array(spans, kind)],
                    ["blob", "rules_version", "spans"],
                )

    return read.mapInArrow(run, LEDGER).dropDuplicates(["blob"])


def findings(docs: DataFrame, ledger: DataFrame, rules_version: int = RULES_VERSION) -> DataFrame:
    """(doc_id, blob, spans) for every row of ``docs``; NULL spans where the ledger lacks its blob.

    Only blobs with findings and their addresses are moved, never a text. Other columns are ignored.
    """
    known = ledger.where(F.col("rules_version") == rules_version).select(F.col("blob").alias("__blob"), "spans")
    return blobs_of(docs).join(known, F.col("blob") == F.col("__blob"), "left").select("doc_id", "blob", "spans")
