from __future__ import annotations

import pytest

DOCUMENTS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # Names that operators use for their own columns.
    "key int, id string, score string, spans int, label string, blob int, n int, block string, stats int, licence int, path string, rules int"
)
EXTRA = (7, "x", "y", 8, "z", 9, 10, "b", 11, 12, "p", 13)
LONG = "the long ünïcode text goes on and on without an end 😀 " * 6000
NORMAL = "A normal text with several words in it.\nAnd a second line, too."


def document(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), *EXTRA)


ODD = [
    document(1, NORMAL),
    document(1, NORMAL),
    document(2, None),
    document(3, ""),
    document(4, LONG, None, None),
    document(5, NORMAL, "de"),
    document(6, " \n\t "),
    document(7, "short"),
    document(8, "123 !?", None),
    document(None, NORMAL),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows and ids, extra columns with clashing names."""
    return spark.createDataFrame(ODD, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def make(spark):
    def build(rows):
        return spark.createDataFrame([document(*row) for row in rows], DOCUMENTS)

    return build
