import pytest
from pyspark.sql import Row

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "id string, row int, n int, spans string, part int, `_copy` int, host string, score string, copies int")


def documents(spark, rows):
    """documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(i, t, "en", s, None if t is None else len(t), "x", 1, 2, "y", 3, 4, "h", "z", 5) for i, t, s in rows], DOC_SCHEMA)


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"word{i % 977} of{i % 31}" for i in range(40_000))
    rows = [(1, "alpha beta gamma delta epsilon zeta eta theta", "a"), (1, "alpha beta gamma delta epsilon zeta eta theta", "a"),
            (2, None, "a"), (3, "", None), (None, "no id here, but words all the same", "b"), (4, long, None),
            (5, long + " tail", "b"), (6, "  \n\t ", "c"), (7, "alpha", "c"), (8, "ALPHA", "a"),
            (9, "é😀 ß\u0000x   y", "c"), (10, "x" * 70_000, "b")]
    return documents(spark, rows)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])


def by_id(df, key="doc_id"):
    out: dict = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r)
    return out


def plain(rows: list[Row]):
    return sorted(tuple(r) for r in rows)
