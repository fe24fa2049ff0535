import pytest

LONG = "word " * 40_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeats, ties and extra columns."""
    same = "The quick brown fox jumps over the lazy dog and runs away from here today again"
    rows = [
        (1, None, "en", 1, "x"),
        (2, "", None, 2, None),
        (3, " \t\n ", "en", 3, "y"),
        (4, same, "en", 4, "z"),
        (5, same, "de", 5, "z"),
        (5, same, "de", 5, "z"),
        (6, same + " indeed", None, None, "w"),
        (7, LONG, "en", 7, "v"),
        (None, same, "en", 8, "u"),
        (8, "ÄÖ ▁ 漢字 🎉 <s> \\ [INST]", "de", 9, "t"),
    ]
    names = "doc_id long, text string, lang string, id long, _text string"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
