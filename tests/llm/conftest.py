import pytest

BASE = "the quick brown fox jumps over a lazy dog while seven old judges box in the dark of every cold night near lake two"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size int, key string, node string, h long, tag string, "
          "words int, pre string, slot int, start int, target string, pattern string, bucket string, component string")


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), 1, "k", "n", 2, "t", 3, "p", 4, 5, "x", "y", "z", "c")


ROWS = [
    row(1, BASE), row(2, BASE), row(3, BASE.replace("lazy", "idle") + " and more of it"), row(4, None), row(5, ""), row(6, " \t\n"),
    row(None, BASE), row(7, BASE, lang=None, source=None), row(7, BASE, lang=None, source=None), row(8, "one two"), row(9, "one two"),
    row(10, "word " * 30_000, source="b"), row(11, "x" * 100_000, source="b"), row(12, "ünïcode ß 日本語 😀 " * 20, lang="de", source=None),
    row(13, None, lang=None, source=None), row(14, "a\x85b\x1cc\xa0d e", source=""), row(15, "12 34 !! ??", source="b"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and very long texts, repeated rows, and extra columns."""
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
