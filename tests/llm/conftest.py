import public_tokenizers
import pytest

from ratebook.llm.common import prepare

#: Extra columns, some named as the operators name their own.
COLUMNS = "doc_id long, text string, did long, sig string, spans string, row int, key int, n int"


@pytest.fixture(scope="session")
def words():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def pieces():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def documents(spark):
    """A table of (id, text) rows with clashing extra columns."""
    prepare(spark)

    def make(rows):
        filled = [(i, t, 1, "s", None, 2, 3, None) for i, t in rows]
        return spark.createDataFrame(filled, COLUMNS).repartition(3)

    return make


@pytest.fixture(scope="session")
def corpus(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    return [(r.doc_id, r.text) for r in rows]


ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (None, "a row without an id"),
    (4, "Don't SHOUT: <|endoftext|> x<|startoftext|>y 12 ³ éÉ ﬁ 東京 á İ \x01 \x1c!\x1c! \xa0z\x00"),
    (5, "x" * 3000),
    (5, "x" * 3000),
    (6, "double  spaces \n\n and\ttabs  at the end  "),
    (7, "東京" * 400),
]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
