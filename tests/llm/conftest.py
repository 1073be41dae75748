import pytest
from pyspark.sql import functions as F

CLASHING = ("row", "id", "node", "class_id", "score", "host", "of", "bad", "line", "words", "starts", "n_words", "item_ids", "keep", "verdict", "rank", "word", "_id", "count")


@pytest.fixture
def messy(spark):
    """Documents with nulls in every column, empty and very long texts, repeated rows and ids,
    and extra columns whose names operators use themselves."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
    rows = [
        (1, "The same text of more than five words here.", "en", "s0", 43), (1, "The same text of more than five words here.", "en", "s0", 43), (2, "the same TEXT of more than five words here", None, "s0", None),
        (3, None, "en", "s0", 0), (4, "", None, None, 0), (5, " \n\t ", "de", "s1", 4), (6, long, "en", "s1", len(long)), (None, "A row without an id but with words in it.", "en", "s1", 10),
        (7, "é ñ 中文 😀 \x00 odd", "fr", None, 9), (8, "x", "en", "s2", 1), (8, "another text under the id of one letter x", "en", "s2", 5), (9, "!!! ??? ...", None, None, None),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHING])


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
