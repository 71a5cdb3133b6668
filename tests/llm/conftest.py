"""Small documents with everything that may go wrong in a column."""

import pytest

DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, row int, rank int, "
    "hash string, part string, spans string"
)
PROSE = (
    "the quick brown fox jumps over the lazy dog and runs through a wide green field while birds sing above "
    "old trees near the quiet river where children play until evening comes and lights go on in all houses "
    "of this small town by the sea whose people know each other well"
)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, an empty and a long text, copies, a repeated row, signs only, columns with names used inside."""
    extra = ("x", 1, 2, "h", "p", "s")
    long_text = " ".join(f"word{i % 5000}" for i in range(60_000)) + " " + "z" * 100_000
    rows = [
        (1, PROSE, "en", "a", len(PROSE)),
        (2, PROSE, "en", "a", len(PROSE)),
        (3, PROSE.upper(), "en", "b", len(PROSE)),
        (4, None, None, None, None),
        (5, "", "en", "a", 0),
        (6, " \n\t ", "fr", "", 4),
        (7, "!!! ... 123 $$", None, "b", None),
        (8, long_text, "en", "b", len(long_text)),
        (9, "ein kurzer Satz über grüne Wiesen und stille Wälder im Norden des Landes", "de", None, 70),
        (9, "ein kurzer Satz über grüne Wiesen und stille Wälder im Norden des Landes", "de", None, 70),
        (None, "a text without an id but with some words in it", "en", "a", 40),
        (12, "\U0001f600 naïve \U0001f600", "fr", "c", 9),
    ]
    return spark.createDataFrame([(*r, *extra) for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 1), (None, 1, 1), (9, None, None)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
