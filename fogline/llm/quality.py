"""Quality rules kept as a ledger of failure bits.

Method: every rule is evaluated once per document; the ledger holds the measurements and one bit per rule that failed.
A policy is a versioned mask of the rules that count. Verdicts, and the effect of leaving a rule out, follow from the
bits alone: documents are counted per bit pattern, and a pattern fails a policy without rule r if pattern & mask & ~r is
not 0. The number of patterns is at most 2 to the number of rules, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fogline.llm.batches import slices, texts
from fogline.llm.words import shingles, utf8, word_bounds, word_hashes

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_SPACES = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    failed: Callable[[], Column]


#: The bits never change their meaning; new rules get new bits.
RULES = (
    Rule("too_few_words", 0, lambda: F.col("n_words") < 50),
    Rule("repeated_windows", 1, lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    Rule("too_many_symbols", 2, lambda: 5 * F.col("n_symbols") > F.col("n_words")),
    Rule("repeated_lines", 3, lambda: F.col("n_dup_lines") >= 5),
    Rule("word_length", 4, lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words"))),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        known = {r.name: 1 << r.bit for r in RULES}
        return sum(known[name] for name in self.rules)


BASE = Policy("base", ("too_few_words", "repeated_windows"))
POLICY_1 = Policy("1", (*BASE.rules, "too_many_symbols", "word_length"))
POLICY_2 = Policy("2", (*POLICY_1.rules, "repeated_lines"))


def _measure(column: pa.Array, listed: list[str]) -> dict[str, np.ndarray]:
    data, offsets = utf8(column)
    starts, ends, first = word_bounds(data, offsets)
    n = len(column)
    n_words = np.diff(first)
    # Code points: bytes that do not continue one.
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOLS[data])])
    of = np.repeat(np.arange(n), n_words)
    chars = np.bincount(of, weights=points[ends] - points[starts], minlength=n).astype(np.int64)
    # Windows of three words found twice in a text mark all their words.
    words = word_hashes(data, starts, ends, lower=False)
    windows, text = shingles(words, first, 3)
    full = n_words[text] >= 3
    windows, text = windows[full], text[full]
    start = np.arange(len(text)) - np.searchsorted(text, text) + first[:-1][text]
    order = np.lexsort((windows, text))
    w, t = windows[order], text[order]
    same = (w[1:] == w[:-1]) & (t[1:] == t[:-1]) if len(w) else np.zeros(0, bool)
    twice = np.zeros(len(w), bool)
    twice[1:] |= same
    twice[:-1] |= same
    marked = np.zeros(len(words), bool)
    for k in range(3):
        marked[start[order[twice]] + k] = True
    repeated = np.bincount(of, weights=marked, minlength=n).astype(np.int64)
    dup = []
    for text in listed:
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")] if "\n" in text else ()
        dup.append(len(lines) - len(set(lines)))
    return {
        "n_words": n_words.astype(np.int64),
        "word_chars": chars,
        "n_symbols": (symbols[offsets[1:]] - symbols[offsets[:-1]]).astype(np.int64),
        "n_dup_lines": np.array(dup, np.int64),
        "n_repeat_words": repeated,
    }


def rule_ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, the measurements, failed): one row per row of ``docs``; bit r of ``failed`` is set if rule r failed.

    Measurements of the whole text (NULL: of an empty one): words ``[^\\x20\\x09-\\x0d]+``, their code points, characters of
    ``[#*$%&|<>]``, lines with a word that equal an earlier line, and words in windows of three words that occur twice or more.
    Equal rows and rows without doc_id are rows like any other; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = _measure(part.column("text"), texts(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(found[m]) for m in MEASURES)], ["doc_id", *MEASURES]
                )

    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
    measured = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
    bits = sum((F.when(r.failed(), 1 << r.bit).otherwise(0) for r in RULES[1:]), F.when(RULES[0].failed(), 1 << RULES[0].bit).otherwise(0))
    return measured.withColumn("failed", bits.cast("long"))


def fails(policy: Policy, failed: Column | str = "failed") -> Column:
    """True where a ledger row fails the policy."""
    return (F.col(failed) if isinstance(failed, str) else failed).bitwiseAND(F.lit(policy.mask)) != 0


def ablations(ledger: DataFrame, policy: Policy) -> DataFrame:
    """(version, rule, n_docs, n_failed, n_failed_without, n_failed_alone): a row per rule of the policy.

    ``n_failed``: documents that fail the policy; ``n_failed_without``: those that still fail when the rule is left out;
    ``n_failed_alone``: those that would fail under this rule alone. The ledger shrinks to one row per bit pattern first.
    """
    patterns = ledger.groupBy("failed").agg(F.count("*").alias("n"))
    rules = F.explode(
        F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in RULES if r.name in policy.rules))
    )
    mask = F.lit(policy.mask).cast("long")
    hit = lambda m: F.sum(F.when(F.col("failed").bitwiseAND(m) != 0, F.col("n")).otherwise(0))
    return (
        patterns.select("failed", "n", rules.alias("r"))
        .groupBy(F.lit(policy.version).alias("version"), F.col("r.rule").alias("rule"))
        .agg(
            F.sum("n").alias("n_docs"),
            hit(mask).alias("n_failed"),
            hit(mask.bitwiseAND(F.bitwise_not(F.col("r.bit")))).alias("n_failed_without"),
            hit(F.col("r.bit")).alias("n_failed_alone"),
        )
    )


def with_ablations(ledger: DataFrame, policy: Policy) -> DataFrame:
    """``ledger`` with ``only_rule`` and ``freed_without``: the rule without which the document would pass, and how many would with it.

    Both NULL for documents that pass, or that several rules of the policy reject. The report is one row per rule.
    """
    rules = [r for r in RULES if r.name in policy.rules]
    hit = F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long"))
    only = F.coalesce(*(F.when(hit == (1 << r.bit), r.name) for r in rules))
    report = ablations(ledger, policy).select(
        F.col("rule").alias("__rule"), (F.col("n_failed") - F.col("n_failed_without")).alias("freed_without")
    )
    named = ledger.withColumn("only_rule", only)
    return named.join(F.broadcast(report), F.col("only_rule") == F.col("__rule"), "left").drop("__rule")
