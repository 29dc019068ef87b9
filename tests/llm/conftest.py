import pytest

from tokenloom.llm.tables import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def docs(spark):
    """Documents with nulls, empty and long texts, repeats, and columns named like internal ones."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(6000))
    base = " ".join(f"tok{i}" for i in range(60))
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail", "en", "a"), (4, None, "en", "a"), (5, "", None, None), (6, " \n\t ", "fr", "b"),
        (None, "one two three", None, "b"), (8, "one two three", "fr", "b"), (9, "One Two three", "fr", "b"), (10, long, "de", "c"), (11, "intro words here " + " ".join(base.split()[5:50]) + " and more", "de", "c"),
        (12, "Cimenteci " * 300, "es", "c"), (13, "a b\nc d\nc d\n#$%\nc d", "es", "c"), (14, "日本 語 é x  y\r\n", "es", "c"),
    ]
    rows = [(*r, 0, "x", "y", [1]) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long, cls string, anchor string, spans array<int>")
