import pytest


@pytest.fixture
def documents(spark):
    """Documents with the awkward rows: nulls, empty, long, repeated, clashing columns."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(20000))
    rows = [(1, "a b c d e f g h i j", 0), (2, "a b c d e f g h i j", 1), (3, "A  B c\td e f g h i j", 2),
            (4, None, 3), (5, "", 4), (6, "   \n", 5), (7, "one two", 6), (8, "one TWO", 7), (9, long, 8),
            (10, long + " tail", 9), (None, "a b c d e f g h i j", 10), (7, "one two", 11), (11, "x" * 50000, 12)]
    return spark.createDataFrame(rows, "doc_id long, text string, n long").selectExpr(
        "doc_id", "text", "n as key", "n as v", "n as cid", "n as ids", "n as rules", "n as score")
