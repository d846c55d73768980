import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing column names."""
    long_text = " ".join(f"word{i % 977} and{i}." + ("\n" if i % 50 == 0 else "") for i in range(30_000))
    rows = [
        (0, "Alpha beta gamma delta.\n  alpha BETA gamma delta. \nshort\nshort", "a", 1, "x", 0),
        (1, "\tALPHA beta Gamma delta.\nNothing else here at all", "b", 2, "y", 0),
        (1, "\tALPHA beta Gamma delta.\nNothing else here at all", "b", 2, "y", 0),
        (2, None, None, None, None, None), (3, "", "a", 0, "", 1), (4, " \n\t \x0b\n", "b", 1, "z", 1),
        (5, long_text, "c", 3, "w", 2), (6, long_text + " tail", "c", 3, "w", 2),
        (None, "Nothing else here at all\nnull id one", "a", 4, None, 3), (None, None, None, None, None, None),
        (7, "Éa ÉA\u00a0x\u2028y \U0001f600 ### | ### nothing else here at all", "ü", 5, "v", 4),
    ]
    names = "doc_id long, text string, source string, pos int, key string, `row` int"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
