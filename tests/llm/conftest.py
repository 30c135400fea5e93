import pytest

ROWS = [
    (1, "Hello World again", "en", "a"),
    (2, "HelloWorld again", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, " \n\t", "de", "b"),
    (6, "wort " * 30_000, "de", "b"),
    (7, "Hello World again", "en", "a"),
    (7, "Hello World again", "en", "a"),
    (None, "no id", "en", None),
    (8, "x", None, "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns with names used inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    extra = ["h", "n", "rid", "size", "key", "fp", "t", "id", "kept", "row", "score", "start", "step", "norm", "component_id", "path"]
    return df.withColumns({n: F.lit(n) for n in extra})


@pytest.fixture(scope="session")
def empty(spark, odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
