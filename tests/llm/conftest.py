import random

import pytest

DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"


def invented(seed: int, n: int) -> list[str]:
    """``n`` invented words."""
    source = random.Random(seed)
    return ["".join(source.choices("abcdefghijklmnop", k=source.randint(2, 8))) for _ in range(n)]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, first=0):
        rows = [(first + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOC_DDL)

    return make


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in all columns, repeated rows, ties, empty and long texts."""
    long_text = " ".join(invented(5, 6000))
    rows = [
        (None, None, None, None, None),
        (None, "no id but words", "en", None, 15),
        (1, "", "en", "s", 0),
        (2, " \n\n ", "xx", "s", 4),
        (3, long_text, "en", "s", len(long_text)),
        (4, long_text, "en", "s", len(long_text)),
        (4, long_text, "en", "s", len(long_text)),
        (5, "one", None, "s", 3),
        (6, "İ é 漢字 😀 <|endoftext|>  two   three\t\r\n", "zz", "s", 40),
    ]
    return spark.createDataFrame(rows, DOC_DDL)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_DDL)
