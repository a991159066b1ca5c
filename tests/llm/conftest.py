import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """Tests have one machine, so a temporary folder may stand for the shared one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, a clashing extra column."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    same = " ".join(f"same{i}" for i in range(80))
    rows = [(1, same, "en", "a", 9), (1, same, "en", "a", 9), (2, same, "en", "a", 9), (3, None, "en", "a", None),
            (4, "", "de", "b", 0), (5, " \n\t ", "de", None, 1), (6, long, None, "b", 2), (7, long + " end", "fr", "b", 2),
            (None, same, "en", None, 3), (8, "Straße ÄÖÜ été |%$  x", "de", None, 3), (9, "one", "en", "c", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long")
