import pytest

from tickloom.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    prepare(spark)


@pytest.fixture(scope="session")
def table(spark):
    """Documents from (id, text) pairs, with columns whose names clash with those of the operators."""

    def make(pairs, lang="en"):
        rows = [(i, t, lang, "src0", None if t is None else len(t)) for i, t in pairs]
        clash = "doc long, fp long, node long, id string, n_tokens string, score string, label string, words int, kept boolean, component_id int, length string, row long, held_out string"
        frame = spark.createDataFrame(rows, DOCS)
        return frame.selectExpr("*", *[f"cast(null AS {c.split()[1]}) AS {c.split()[0]}" for c in clash.split(", ")])

    return make


@pytest.fixture(scope="session")
def odd(table):
    """Nulls, empty and very long texts, ties, repeated rows and keys."""
    return table(
        [
            (1, None),
            (2, ""),
            (3, " \t\n"),
            (4, "The same words in two rows."),
            (4, "The same words in two rows."),
            (5, "The same words in two rows."),
            (6, "one key, two texts"),
            (6, "another text of key six"),
            (None, "no key at all"),
            (None, None),
            (7, "x" * 70_000),
            (8, "long and longer " * 20_000),
            (9, "Grüße, çà et là — 漢字 😀 <|endoftext|> it's 12,345"),
        ]
    )


@pytest.fixture(scope="session")
def nothing(table):
    return table([])
