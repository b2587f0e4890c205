import pytest
from llm_helpers import prose
from pyspark.sql import functions as F

CLASHING = (
    "same bands key rep root shard size row run node u v ids n_tokens score value taken "
    "component_id kept n_shingles words block label_ spans "
    "_node _row _id _source _size _copies _time n id least"
).split()


@pytest.fixture(scope="session")
def messy_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    long = prose(1, 20000)
    rows = [
        (1, "one two three four five six seven", "en", "a"),
        (2, "One two three FOUR five six seven", "en", "a"),
        (3, None, "en", "b"),
        (4, "", None, "b"),
        (5, " \t\n ", "en", None),
        (None, "one two three four five six seven", "en", "a"),
        (None, None, None, None),
        (6, long, "en", "a"),
        (7, long, "de", "b"),
        (7, long, "de", "b"),
        (8, "two words", "en", "c"),
        (9, "the mit license <|endoftext|> applies. idiot!", "en", "c"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame = frame.withColumn("n_chars", F.length("text").cast("long"))
    for name in CLASHING:
        frame = frame.withColumn(name, F.lit("x"))
    return frame


@pytest.fixture(scope="session")
def no_documents(messy_documents):
    return messy_documents.limit(0)
