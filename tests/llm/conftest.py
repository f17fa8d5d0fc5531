"""Small inputs with every awkward case: nulls, empty and long texts, ties, repeated rows,
extra columns with clashing names."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_rows():
    lines = "\n".join(f"line {k} of a passage that others share with it too" for k in range(6))
    prose = " ".join(f"w{k % 97}x{k % 89}" for k in range(400))
    rows = [
        (1, prose, "en", "a"),
        (2, prose, "en", "a"),
        (3, prose + " and one more word", "en", "b"),
        (4, lines, "fr", "b"),
        (5, "own start\n" + lines + "\nown end", "fr", None),
        (6, None, None, "a"),
        (7, "", "de", "c"),
        (8, " \n\t \n", "de", "c"),
        (9, "12345 678 !!! ...", "es", "c"),
        (10, "x", "es", "é"),
        (11, "same\nsame\nsame\nsame", "es", "é"),
        (12, " ".join(["again and again"] * 60), "en", "é"),
        (13, "\n".join(f"sentence {k} stands. It goes on for a while here. " * 3 for k in range(400)), "de", "a"),
        (14, "lead\n\n\nline 0 of a passage that others share with it too\n \nline 1 of a passage that others share with it too", "de", "b"),
        (15, "Ünïcödé 😀 ﬁ ▁▁ a b \x00 ÀÉ", None, "b"),
        (15, "another text of the same id", "en", "b"),
        (16, prose, "en", "a"),
        (16, prose, "en", "a"),
        (None, lines, None, None),
        (None, None, None, None),
    ]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(awkward):
    """Extra columns named like the operators' own results and working columns."""
    from pyspark.sql import functions as F

    names = ["id", "key", "h", "w", "f", "n", "size", "copies", "kept", "host", "base_failed", "fp", "first", "range", "ids", "value", "node", "component", "n_words", "starts", "order", "target", "rank", "row", "nth", "_n", "_m", "_t", "_w", "_s", "_keep", "_row", "_chars", "_sh_h", "_sh_id", "_sh_n", "_mx_h", "_mx_n", "_mx_key", "_ld_h", "_ld_key", "_ld_row"]
    return awkward.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
