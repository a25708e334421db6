import pytest


@pytest.fixture
def frame(spark):
    """A frame from rows and a schema, with columns whose names operators use themselves."""

    def build(rows, schema, clash=True):
        df = spark.createDataFrame(rows, schema)
        if clash:
            from pyspark.sql import functions as F

            for name in ("kept", "fp", "size", "digest", "_row", "rank", "n", "score", "block", "node"):
                if name not in df.columns:
                    df = df.withColumn(name, F.lit("theirs"))
        return df

    return build


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(frame):
    """Documents from ``(doc_id, text)`` or whole rows; missing fields are null."""

    def build(rows, clash=True):
        full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        return frame(full, DOCS, clash)

    return build


@pytest.fixture
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, "word " * 30_000, "en", None),
        (4, "same text here", None, "a"),
        (5, "same text here", "en", "b"),
        (5, "same text here", "en", "b"),
        (None, "an id that is null", "en", "b"),
        (7, "x" * 200_000, "de", "c"),
        (8, " \t\n ", "de", "c"),
        (9, "Ünïcode tëxt 日本語 \x00\x1c😀", "fr", "ä"),
    ]
