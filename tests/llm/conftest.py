import pytest

ODD = [
    (1, "Plain words make a first document that says something about nothing at all, and ends here.", "en", "a", 1),
    (2, "Plain words make a first document that says something about nothing at all, and ends here.", "en", "b", 2),
    (2, "Plain words make a first document that says something about nothing at all, and ends here.", "en", "b", 2),
    (3, "", "en", None, 0),
    (4, None, None, None, None),
    (None, "A text whose id is missing, but which has words enough to make some shingles of its own.", "en", "c", 5),
    (5, " \t\n\r ", "en", "d", 5),
    (6, "Ü", "de", "e", 1),
    (7, "long " * 20_000 + "end", "en", "f", 100_003),
    (8, "x" * 30_000, "en", "g", 30_000),
    (9, 'token = "0123456789abcdef0123456789abcdef01234567" and more words follow it.', "en", "h", 9),
]


@pytest.fixture
def odd(spark):
    """Rows with nulls, empty and very long texts, ties, repeats, and extra columns whose names operators use too."""
    rows = [(*r, "s", 7, "x", True, 3.5, "k", "n", 7, "q", 1) for r in ODD]
    return spark.createDataFrame(
        rows,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, slot int, found string, good boolean, score double, key string, name string, _key int, _quality string, number int",
    )


@pytest.fixture
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
