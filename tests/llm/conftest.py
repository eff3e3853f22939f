import pytest

from stockweave.llm.common import prepare

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs or longer rows."""
    prepare(spark)

    def make(rows, schema=DOCUMENTS):
        full = [tuple(r) + (("en", "web", len(r[1] or ""))[len(r) - 2 :] if len(r) < 5 else ()) for r in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def awkward(docs):
    """Null ids and texts, empty and blank texts, repeated rows, one very long text."""
    return docs(
        [
            (1, None), (2, ""), (3, "  \n\t "), (None, "One two three four."), (None, None),
            (4, "One two three four."), (4, "One two three four."), (5, "word " * 60_000), (6, "Ünïcödé é 日本 \U0001f600"),
            (7, None, None, None, None),
        ]
    )


def with_clashes(df, *names):
    """``df`` with further columns of these names."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"kept {n}").alias(n) for n in names if n not in df.columns])
