"""Conversations as one formatted text with token ids and a loss mask.

Method: a conversation is rendered whole, with the span of every turn's text in the rendering. It is encoded
once; tokens carry character offsets. Both lists of spans are sorted, so the turn of each token is found
by binary search, and a token counts for the loss when it lies in a span of a trained role.

Template: ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>`` per turn. The three markers are tokens of
their own (ids after the vocabulary's), so no token crosses the border of a text. Texts and roles cannot hold a
marker: in ``<``, any number of backslashes, ``|`` one backslash is added, and taken away when reading.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
MARKERS = (START, SEP, END)

_OPEN = re.compile(r"<(\\*)\|")
_CLOSED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>", re.S)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _CLOSED.sub(r"<\1|", text)


def render(turns: Iterable[tuple[str | None, str | None]]) -> tuple[str, list[tuple[str, int, int]]]:
    """The formatted text, and (role, start, end) of each turn's text in it, in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role or "") + SEP, escape(text or "")
        spans.append((role or "", at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


@dataclass(frozen=True)
class Encoded:
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def load_tokenizer(vocabulary: str):
    """The tokenizer of ``vocabulary`` (its JSON text) with the three markers added; offsets cover all characters."""
    from tokenizers import AddedToken, Tokenizer, processors

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in MARKERS])
    return tokenizer


def encode(tokenizer, formatted: str) -> Encoded:
    """Tokens of a whole text with their offsets, from one call."""
    got = tokenizer.encode(formatted, add_special_tokens=False)
    offsets = np.array(got.offsets, np.int64).reshape(-1, 2)
    return Encoded(np.array(got.ids, np.int32), offsets[:, 0], offsets[:, 1])


def token_lengths(tokenizer) -> np.ndarray:
    """Bytes of each token: a byte-level vocabulary writes one character per byte, and the markers are plain ASCII."""
    return np.array([len(tokenizer.id_to_token(i) or "") for i in range(tokenizer.get_vocab_size(with_added_tokens=True))], np.int64)


def encode_batch(tokenizer, lengths: np.ndarray, texts: list[str]) -> list[Encoded]:
    """As ``encode`` for many texts, with offsets from the tokens' bytes; a text whose bytes do not add up is encoded by itself."""
    found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    out = []
    for text, listed in zip(texts, found):
        ids = np.fromiter(listed, np.int32, len(listed))
        ends = np.cumsum(lengths[ids])
        data = np.frombuffer(text.encode(), np.uint8)
        if len(data) != (ends[-1] if len(ends) else 0):
            out.append(encode(tokenizer, text))
        elif len(data) == len(text):
            out.append(Encoded(ids, ends - lengths[ids], ends))
        else:
            # The character of each byte; a token that holds part of one covers all of it.
            character = np.cumsum((data & 0xC0) != 0x80) - 1
            out.append(Encoded(ids, character[ends - lengths[ids]], character[ends - 1] + 1))
    return out


def loss_mask(tokens: Encoded, spans: list[tuple[str, int, int]], trained: frozenset[str]) -> np.ndarray:
    """True for tokens inside the text of a trained role."""
    starts = np.array([s for _, s, _ in spans], np.int64)
    ends = np.array([e for _, _, e in spans], np.int64)
    wanted = np.array([r in trained for r, _, _ in spans], bool)
    if not len(spans):
        return np.zeros(len(tokens.ids), bool)
    turn = np.searchsorted(starts, tokens.starts, "right") - 1
    near = np.maximum(turn, 0)
    return (turn >= 0) & wanted[near] & (tokens.ends <= ends[near]) & (tokens.starts < ends[near])


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """The text under the mask, unescaped, read back from the tokens' offsets.

    Tokens that are parts of one character share it; runs of touching tokens are unescaped as one.
    """
    s, e = starts[mask], ends[mask]
    if not len(s):
        return ""
    # A run ends where the next token begins beyond all that came before.
    reach = np.maximum.accumulate(e)
    first = np.flatnonzero(np.concatenate([[True], s[1:] > reach[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(s) - 1]])
    return "".join(unescape(formatted[a:b]) for a, b in zip(s[first].tolist(), reach[last].tolist()))


def _turns_of(column: pa.ListArray) -> Iterator[list[tuple[str | None, str | None]]]:
    """(role, text) of the turns of each row."""
    flat = column.flatten()
    pairs = list(zip(flat.field("role").to_pylist(), flat.field("text").to_pylist()))
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)).tolist()
    for start, end in zip([0, *ends], ends):
        yield pairs[start:end]


def _lists(parts: list[np.ndarray], kind) -> pa.ListArray:
    """Arrays as one list column, without a Python object per entry."""
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(kind)))


def _arrays_of(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column as numpy arrays."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)).tolist()
    return [flat[start:end] for start, end in zip([0, *ends], ends)]


def format_conversations(
    turns: DataFrame, vocabulary_file: str, trained: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """(conv_id, formatted, token_ids, token_starts, token_ends, loss_mask), one row per conversation.

    ``turns``: rows of conv_id, turn, role, text; ``vocabulary_file`` is a byte-level vocabulary that the driver reads once. Turns are in order of
    turn, then role, then text (NULL first); repeated rows are repeated turns. NULL text and role are empty. Rows with a NULL
    conv_id form one conversation. Other columns are ignored. A conversation is one value of the result, so its rows
    meet in one task; conversations are spread by id.
    """
    vocabulary = turns.sparkSession.sparkContext.broadcast(open(vocabulary_file, encoding="utf-8").read())
    roles = frozenset(trained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(vocabulary.value)
        lengths = token_lengths(tokenizer)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                rendered = [render(t) for t in _turns_of(part.column("turns"))]
                texts = [formatted for formatted, _ in rendered]
                tokens = encode_batch(tokenizer, lengths, texts)
                masks = [loss_mask(t, spans, roles) for t, (_, spans) in zip(tokens, rendered)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("conv_id"),
                        pa.array(texts, pa.string()),
                        *(_lists([getattr(t, c) for t in tokens], np.int32) for c in ("ids", "starts", "ends")),
                        _lists(masks, bool),
                    ],
                    ["conv_id", "formatted", "token_ids", "token_starts", "token_ends", "loss_mask"],
                )

    whole = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    return whole.mapInArrow(
        run,
        "conv_id long, formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, loss_mask array<boolean>",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_text, loss_text, formatted_chars) from the output alone.

    ``turns_text`` is role, line feed, text, line feed of each turn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("formatted").to_pylist()
            turns = [parse(t) for t in texts]
            columns = (_arrays_of(batch.column(c)) for c in ("token_starts", "token_ends", "loss_mask"))
            loss = [masked_text(text, starts, ends, mask) for text, starts, ends, mask in zip(texts, *columns)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array([len(t) for t in turns], pa.int64()),
                    pa.array(["".join(f"{r}\n{x}\n" for r, x in t) for t in turns], pa.string()),
                    pa.array(loss, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["conv_id", "n_turns", "turns_text", "loss_text", "formatted_chars"],
            )

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_text string, loss_text string, formatted_chars long")
