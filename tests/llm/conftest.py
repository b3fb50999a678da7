"""Tables with every odd case, for all operators of the subpackage."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use in their results or on the way.
CLASHING = (
    "n_lines n_dropped size source_size target taken score predicted lang_pred held_out shared label region n set failed blob spans "
    "hi lo shard drawn place toxic x y"
).split()

LINE = "This line is long enough to count as one that documents share."


def odd_rows():
    words = " ".join(f"word{i}" for i in range(30))
    return [
        (None, words + " alone", "en", "a", 1),
        (None, None, None, None, None),
        (1, None, "en", None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b\x0c\r ", "en", "a", 7),
        (4, words, "en", "b", None),
        (4, words, "en", "b", None),
        (5, words + " more", "en", "b", 3),
        (6, words.upper(), None, "a", 3),
        (7, "ein Wort", "de", "é", 8),
        (8, "ein Wort", "de", "\U0001f600", 8),
        (9, "日本語 éàü ∑ 😀\n" + LINE, "fr", "￿", 5),
        *((10 + i, f"{LINE}\nown {i}\n  {LINE.upper()}\t\n{LINE}", "en", "c", 5) for i in range(6)),
        (20, " ".join(f"long{i % 5000}" for i in range(60_000)), "es", "c", 9),
        (21, "x" * 300_000, "es", "c", 9),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with NULLs, empty and very long texts, repeated rows and clashing extra columns."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(odd_rows(), DOCS)
    return docs.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def held_out(doc_id) -> bool:
    import zlib

    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1
