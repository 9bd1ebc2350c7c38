import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score double, key string, size int, words string"


def prose(n, start=0):
    """n words, no five of which come twice."""
    return " ".join(f"the w{start + i} of" if i % 3 else f"house{start + i}," for i in range(n))


EDGES = [
    (1, None, "en", "a", None, "r", 1.0, "k", 1, "w"),
    (2, "", None, None, 0, None, None, None, None, None),
    (3, " \n\t ", "en", "a", 4, "r", 1.0, "k", 1, "w"),
    (4, prose(300), "en", "a", 1, "r", 1.0, "k", 1, "w"),
    (4, prose(300), "en", "a", 1, "r", 1.0, "k", 1, "w"),  # a repeated row
    (5, prose(300), "en", "b", 1, "r", 1.0, "k", 1, "w"),  # a copy
    (6, prose(298) + " other words", "en", "b", 1, "r", 1.0, "k", 1, "w"),  # a near copy
    (None, prose(60, 5000), "en", "b", 1, "r", 1.0, "k", 1, "w"),
    (None, None, None, None, None, None, None, None, None, None),
    (7, "one two", "en", "ä", 1, "r", 1.0, "k", 1, "w"),
    (8, "café 日本語 \U0001d54f’s naïve gap line", "fr", "b", 1, "r", 1.0, "k", 1, "w"),
    (9, prose(12_000, 10_000), "en", "b", 1, "r", 1.0, "k", 1, "w"),  # a long text
    (10, "z" * 3000 + " " + "ab" * 2000, "en", "b", 1, "r", 1.0, "k", 1, "w"),  # long words
]


@pytest.fixture(scope="session")
def edges(spark, tmp_path_factory):
    """Documents with nulls, blanks, copies, long texts and columns whose names the operators use themselves."""
    path = str(tmp_path_factory.mktemp("edges") / "documents.parquet")
    spark.createDataFrame(EDGES, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
