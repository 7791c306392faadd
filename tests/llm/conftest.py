"""Small tables with the awkward rows every operator has to bear."""

import pytest

AWKWARD = [
    (0, "One fine day the cat sat on the mat and slept.\nNobody minded it.", "en", "a"),
    (1, "One fine day the cat sat on the mat and slept.\nNobody minded it.", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \n\t ", "de", None),
    (5, "word " * 6000 + "end", None, "b"),
    (6, "ein kurzer Satz, ä ö ü ß 漢字 \U0001f600 é", "de", "b"),
    (6, "ein kurzer Satz, ä ö ü ß 漢字 \U0001f600 é", "de", "b"),
    (9, "12 34 !!", "xx", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def clashing(awkward):
    """The awkward rows with columns named like those the operators make."""
    from pyspark.sql import functions as F

    names = "n start length ids spans quality language id node key bucket row cells licenses n_tokens part lang_pred"
    return awkward.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names.split())])
