import pytest

LONG = "alpha beta gamma delta " * 20_000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog.\nA second line stands here, quite alone.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog.\nA second line stands here, quite alone.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog.\nA second line stands here, quite alone.", "en", "a"),
    (3, None, None, None),
    (4, "", "en", None),
    (5, " \n\t \n", "en", "b"),
    (6, LONG, "de", "a"),
    (None, "a row without an id, but with some words in it", "fr", "a"),
    (None, None, None, "b"),
    (7, "é日本 <|endoftext|>  x  y\n\nΣΑΣ 12 it's", "fr", "b"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like results."""
    from pyspark.sql import functions as F
    rows = [(*r, 0 if r[1] is None else len(r[1])) for r in ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit(1) for c in ("score", "kept", "length", "rank", "n", "cid", "line", "h1", "key", "size", "a", "component",
                                                   "stats", "line_no", "first", "label", "counts", "own", "tile", "piece", "start", "my col")})


@pytest.fixture(scope="session")
def marks(spark):
    rows = [(1, 1, 0), (2, 0, 1), (3, None, None), (4, 1, 0), (6, 0, 1), (7, 1, 0), (None, 1, 1), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)
