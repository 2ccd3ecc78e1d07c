import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} and" for i in range(40_000)) + "."


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in all columns, empty and very long texts, repeated rows and ids, extra columns with the names operators use."""
    rows = [
        (None, None, None, None), (1, "", "en", "a"), (2, "   \n\t", "en", "a"), (3, "One two three.", "en", None), (3, "One two three.", "en", None),
        (4, "One two three.", None, "b"), (5, "123 456 !!! ###", "en", "a"), (6, LONG, "en", "a"), (7, "x" * 50_000, "de", "a"), (None, "Ein kurzer Satz ohne Nummer.", "de", "b"),
        (8, "  ümlaut \x1c\x85 日本語 🙂 <|endoftext|>", "de", "b"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({"n_chars": F.length("text").cast("long"), "score": F.lit("s"), "rid": F.lit(0), "rep": F.lit(None).cast("string"), "th": F.lit(1.5), "path": F.lit("p"), "shard": F.lit("q"), "size": F.lit("z")})


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
