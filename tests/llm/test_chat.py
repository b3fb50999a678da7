import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from fogline.llm import chat
from fogline.llm.queries import vocabulary_file

TOKENIZER = chat.load_tokenizer(open(vocabulary_file(), encoding="utf-8").read())
PIECES = st.sampled_from(
    ["<", "|", "\\", "im_end", "<|im_end|>", "<|im_start|>", "<|im_sep|>", "<\\|", "<|endoftext|>", "é", "日本", "😀", " ", "\n", "\r\n", "word", "|>"]
)
TEXT = st.lists(PIECES, max_size=10).map("".join)
TURNS = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["user", "assistant", "system"]), TEXT), st.one_of(st.none(), TEXT)), max_size=5)


@given(TURNS)
@settings(max_examples=300, deadline=None)
def test_round_trip_and_mask(turns):
    formatted, spans = chat.render(turns)
    want = [(r or "", t or "") for r, t in turns]
    assert chat.parse(formatted) == want
    tokens = chat.encode(TOKENIZER, formatted)
    mask = chat.loss_mask(tokens, spans, frozenset({"assistant"}))
    assert chat.masked_text(formatted, tokens.starts, tokens.ends, mask) == "".join(t for r, t in want if r == "assistant")
    for role in ("user", "assistant", "system"):
        for start, end in [(s, e) for r, s, e in spans if r == role]:
            assert "<|" not in formatted[start:end]


LENGTHS = chat.token_lengths(TOKENIZER)


@given(st.lists(st.one_of(TEXT, st.text(max_size=40)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_offsets_from_bytes_are_the_tokenizers(texts):
    rendered = [chat.render([("user", t)])[0] for t in texts] + texts
    for text, got in zip(rendered, chat.encode_batch(TOKENIZER, LENGTHS, rendered)):
        want = chat.encode(TOKENIZER, text)
        assert got.ids.tolist() == want.ids.tolist()
        assert got.starts.tolist() == want.starts.tolist() and got.ends.tolist() == want.ends.tolist()


def test_odd_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string, turns string, loss_mask string"
    rows = [
        (1, 2, "assistant", "second"), (1, 1, "user", None), (1, 1, "user", None), (1, None, None, "first"),
        (2, 1, "assistant", None), (None, 1, "assistant", "nobody's"), (None, 2, "user", "x"),
        (3, 1, "assistant", "w " * 50_000),
    ]
    df = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], schema)
    made = chat.format_conversations(df, vocabulary_file())
    back = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    assert back[1]["turns_text"] == "\nfirst\nuser\n\nuser\n\nassistant\nsecond\n" and back[1]["n_turns"] == 4
    assert back[1]["loss_text"] == "second" and back[2]["loss_text"] == "" and back[None]["loss_text"] == "nobody's"
    assert hashlib.sha256(back[3]["loss_text"].encode()).digest() == hashlib.sha256(("w " * 50_000).encode()).digest()
    for r in made.where("conv_id = 1").collect():
        assert len(r["token_ids"]) == len(r["loss_mask"]) == len(r["token_starts"])
        assert "".join(r["formatted"][s:e] for s, e in zip(r["token_starts"], r["token_ends"])) == r["formatted"]
    assert chat.format_conversations(df.limit(0), vocabulary_file()).count() == 0
