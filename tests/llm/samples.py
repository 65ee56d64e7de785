"""Inputs for the tests of the data preparation operators."""

import pytest

SF = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long, code long, bucket string"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text, lang, source) with two columns whose names operators use inside."""

    def make(rows, partitions=3):
        full = [(i, t, lang, source, None if t is None else len(t), 7, "x") for i, t, lang, source in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make


#: Null text and source, empty and blank texts, repeated rows, a null id, signs beyond 16 bits, one very long text.
ODD = [
    (1, None, "en", "a"),
    (2, "", None, "b"),
    (3, " \n\t ", "en", None),
    (4, "the cat sat on the mat", "en", "a"),
    (4, "the cat sat on the mat", "en", "a"),
    (5, "the cat sat on the mat", "en", "b"),
    (None, "no id here", "de", "b"),
    (6, "😀 Ünïcode ﬁ ǅ 12,5 <|endoftext|>  two  spaces\r\n", "de", None),
    (7, "wörter und Wörter " * 9000, "de", "c"),
]


@pytest.fixture
def odd(docs_of):
    return docs_of(ODD)


@pytest.fixture
def none(docs_of):
    return docs_of([])
