import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    """Python workers import the package whatever their working directory."""
    from lakesmith.session import ship_package

    ship_package(spark)


ODD = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, cls string, seg long, digest string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and columns named like the operators' own."""
    long_text = " ".join(f"word{i % 977} x{i % 13}" for i in range(30_000))
    texts = [
        (1, "the quick brown fox jumps over the lazy dog and then runs away from the other big dog again"),
        (2, "the quick brown fox jumps over the lazy dog and then runs away from the other big dog again"),
        (3, "THE quick brown fox jumps over the lazy dog and then runs away from the other big dog again"),
        (4, ""), (5, None), (6, " \t\n "), (7, "..."), (8, "one two"), (9, "One Two"), (10, long_text), (11, long_text + " tail"),
        (None, "a text without an id that nobody else has in this table at all, of some fifteen words"),
        (None, "the quick brown fox jumps over the lazy dog and then runs away from the other big dog again"),
        (12, "a b a b a b a b a b a b a b a b a b a b"), (12, "a b a b a b a b a b a b a b a b a b a b"),
        (13, "Größe ▁ \U0001f600 naïve space ￿ end"), (14, "x" * 5000),
    ]
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else f"s{k % 3}", None if t is None else len(t), k, "r", "c", 1, "d") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, ODD)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD)
