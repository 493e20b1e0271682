import pytest

from tests.llm import brute


@pytest.fixture(scope="session")
def rows():
    return brute.awkward()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The awkward documents in several partitions, with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    made = spark.createDataFrame(rows, brute.SCHEMA).repartition(4)
    names = ("fp", "row", "out", "spans", "key", "id", "mask", "h", "part", "piece", "cluster", "node", "kept", "host", "own", "body", "n_words", "items", "apart", "a.b")
    return made.withColumns({n: F.lit(n) for n in names}).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], brute.SCHEMA)


def _key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


@pytest.fixture(scope="session")
def same():
    """Equal as bags of rows."""

    def check(df, expected):
        assert sorted(map(tuple, df.collect()), key=_key) == sorted(map(tuple, expected), key=_key)

    return check
