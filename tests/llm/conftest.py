from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, gone int, score int, a int"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from texts or (id, text) pairs, with extra columns that operators use too."""

    def build(texts, lang="en"):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, lang, "s", len(t or ""), 1, 2, 3) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return build


LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))

#: Null id, null text, empty, blank, one sign, long, repeated rows, ties in text, any script.
ODD = [
    (None, "an orphan text without any id at all"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \n\t \n"),
    (4, "."),
    (5, LONG),
    (6, "the same text stands here twice over"),
    (6, "the same text stands here twice over"),
    (7, "the same text stands here twice over"),
    (8, "日本語 ▁ ß ﷐ é\r\n\x00 <|endoftext|> 😀"),
    (9, "x" * 5000),
]


@pytest.fixture(scope="session")
def odd(docs):
    return docs(ODD)


@pytest.fixture(scope="session")
def none(docs):
    return docs([])


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
