import pytest


@pytest.fixture
def docs(spark):
    """A documents table from ``(doc_id, text)`` pairs, with columns whose names operators use themselves."""
    def build(pairs, partitions=2):
        rows = [(i, t, "en", "s", None if t is None else len(t), "x", 1) for i, t in pairs]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, score string, fp int",
        ).repartition(partitions)
    return build
