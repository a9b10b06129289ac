import pytest

#: an extra column named like results of several operators
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score string, ids string, "
          "secrets string, component_id string, n_dropped string, key string, verdict string")


def doc(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", len(text or ""), "x", "x", "x", "x", "x", "x", "x")


LONG = " ".join(f"word{i % 977}" for i in range(60_000)) + "\n" + "same line again\n" * 500
ODD = [doc(1, "the cat sat on the mat and ran"), doc(1, "the cat sat on the mat and ran"), doc(None, "no id here at all"),
       doc(None, None, None), doc(2, None), doc(3, ""), doc(4, " \t\n\x0b "), doc(5, LONG), doc(6, LONG), doc(7, "x", None),
       doc(8, "a  b   c \n\n  d "), doc(9, "🙂 ▁   é ﬁ <|endoftext|> AKIA")]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (5, 0, 0), (6, 1, 0), (None, 1, 0), (7, None, 0), (8, 0, 1), (8, 1, 0), (77, 0, 0)],
        "doc_id long, quality int, toxic int")
