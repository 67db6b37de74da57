import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHING = (
    "score", "lang_pred", "copy", "mix_key", "key", "n", "node", "bucket", "label", "class_id", "links", "range", "guest", "sketch",
    "part", "rank", "sequence_id", "offset", "email", "ip", "spans", "d", "g", "row", "_salt", "sentence_ids", "licences", "kept",
    "shard", "slot", "row_number", "term", "docs", "item", "value", "number", "phrase", "words", "total", "near",
)
LONG = " ".join(f"wort{i % 977} the of" for i in range(40_000))
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "   \n\t ", "en", "a", 6),
    (4, "!!! 123 --", None, "b", 10),
    (5, LONG, "en", "a", len(LONG)),
    (6, "the same text stands here more than once, word for word", "en", "a", 55),
    (6, "the same text stands here more than once, word for word", "en", "a", 55),
    (7, "the same text stands here more than once, word for word", "en", None, 55),
    (7, "another text under an id that is taken", "en", "b", 38),
    (None, "a text without an id, but with a@b.org", "en", "b", 38),
    (None, None, None, "b", None),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and clashing extra columns."""
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.select("*", *(F.lit("theirs").alias(c) for c in CLASHING))


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
