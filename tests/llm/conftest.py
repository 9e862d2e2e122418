import pytest
from pyspark.sql import functions as F

from lakemill.llm import queries
from tests.conftest import SF

LONG = " ".join(f"w{k % 7919} lorem" for k in range(60_000))
#: doc_id, text: nulls, empty and white texts, short and very long ones, ties, repeated rows, odd characters.
EDGE = [
    (1, None), (2, ""), (3, " \n\t"), (4, "word"), (5, "one two three"), (6, LONG), (7, LONG + " end"), (8, "a b c d e f"),
    (8, "a b c d e f"), (9, "A B C D E F"), (None, "a b c d e f"), (10, "naïve café — 中文   x\x00y <|endoftext|> 'll"),
    (11, "12 34 !!"), (-5, " "), (2**40, "x" * 50_000),
]


@pytest.fixture(autouse=True)
def library_path(spark):
    """Tells Python workers where the library lies, as the queries do."""
    queries.table(spark, SF, "documents")


@pytest.fixture
def edge(spark):
    """The edge rows with further columns whose names operators use themselves."""
    rows = spark.createDataFrame(EDGE, "doc_id long, text string")
    names = ("n", "node", "score", "length", "ids", "token", "lang_pred", "start", "piece", "row")
    return rows.withColumns({name: F.lit(None).cast("string") for name in names})


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def documents(spark):
    return queries.table(spark, SF, "documents")
