import pytest
from pyspark.sql import types as T

#: Names that the operators use inside, in documents here.
CLASHING = ("id", "text_", "w", "n", "row", "size", "score", "quality", "secrets", "h", "component")

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
PROSE = "The old river ran past the mill. Nobody had seen it so low. " + " ".join(f"Then came line {i} of the tale." for i in range(20))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, a very long one, equal rows and ties."""
    rows = [
        (1, PROSE, "en", "a", 10),
        (2, PROSE, "en", "a", 10),
        (2, PROSE, "en", "a", 10),
        (3, "", "de", "b", 0),
        (4, None, None, None, None),
        (None, "a few words", "en", "b", 11),
        (None, None, None, None, None),
        (5, " \t\n ", "en", "", 4),
        (6, LONG, "en", "b", len(LONG)),
        (7, LONG + " more", "en", None, 5),
        (8, "one", "fr", "c", 3),
        (9, "one", "fr", "c", 3),
    ]
    return [r + tuple(f"{k}{r[0]}" if k % 2 else None for k in range(len(CLASHING))) for r in rows]


@pytest.fixture(scope="session")
def odd_schema():
    docs = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            *[T.StructField(c, T.StringType()) for c in ("text", "lang", "source")],
            T.StructField("n_chars", T.LongType()),
        ]
    )
    return T.StructType(docs.fields + [T.StructField(c, T.StringType()) for c in CLASHING])


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows, odd_schema):
    return spark.createDataFrame(odd_rows, odd_schema)


@pytest.fixture(scope="session")
def no_docs(spark, odd_schema):
    return spark.createDataFrame([], odd_schema)


@pytest.fixture(scope="session")
def real(spark, sf_dir):
    """The rows of ``documents`` as plain Python."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
