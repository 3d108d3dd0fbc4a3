import pytest
from pyspark.sql import functions as F

WORD = "wort"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd_documents(spark):
    """Nulls, empty and very long texts, repeated rows, and other columns with names that operators use."""
    long = " ".join(f"{WORD}{i % 977}" for i in range(30_000))
    rows = [
        (1, "one two three four five", "en", "a", 23),
        (1, "one two three four five", "en", "a", 23),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t ", "en", "a", 4),
        (None, "no id at all", "en", "a", 12),
        (5, long, "en", "a", len(long)),
        (6, long + " end", "en", "a", len(long) + 4),
        (7, "x" * 50_000, "en", "a", 50_000),
        (8, "naïve ☃ \x00 \U0001f642 text", "en", "a", 20),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("id", "score", "predicted", "fp", "ids", "seq", "component_id", "quality", "toxic", "positive", "doc"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs
