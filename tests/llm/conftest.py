import pytest
from pyspark.sql import types as T

from lakezones.llm.shipping import prepared

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, source) rows."""
    prepared(spark)

    def make(rows, partitions=3):
        full = [(row[0], row[1], "en", row[2] if len(row) > 2 else "s", len(row[1] or "")) for row in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make


@pytest.fixture
def by_id():
    """Rows of a frame by doc_id, for ids that occur once."""

    def collect(df, key="doc_id"):
        rows = df.collect()
        found = {row[key]: row for row in rows}
        assert len(found) == len(rows)
        return found

    return collect


@pytest.fixture(scope="session")
def prose():
    """Different texts of invented words, from a seed."""
    import random

    def text(seed, words=120):
        rnd = random.Random(seed)
        made = ["".join(rnd.choice(("th", "er", "on", "an", "re", "ha")) for _ in range(rnd.randint(1, 4))) for _ in range(words)]
        return ". ".join(" ".join(made[i : i + 9]).capitalize() for i in range(0, words, 9)) + "."

    return text
