import pytest

#: Columns that clash with names the operators use themselves.
SHAPE = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "row bigint, size bigint, kept boolean, fp bigint, mark bigint, record bigint, named string, rate double, words string, place int"
)


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    texts = [
        (1, "Alpha beta gamma delta."),
        (1, "Alpha beta gamma delta."),
        (1, "Alpha beta gamma delta."),
        (2, None),
        (3, ""),
        (4, " \t\r\n"),
        (None, "Alpha  beta gamma delta."),
        (None, None),
        (5, "long words " * 40_000),
        (6, "x" * 200_000),
        (7, "ÄÖ ß \u2028 İ K é"),
        (7, "another text under the same id"),
        (-8, "Alphabeta gammadelta."),
    ]
    rows = []
    for i, (doc_id, text) in enumerate(texts):
        full = (doc_id, text, "en", "s1", 5, 1, 2, True, 3, 4, 5, "n", 0.5, "w", 7)
        rows.append(full if i % 2 else (doc_id, text) + (None,) * 13)
    return spark.createDataFrame(rows, SHAPE)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 0, 0), (1, 0, 0), (2, None, None), (None, 1, 1), (5, 1, 1), (7, 0, 0), (999, 0, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark):
    rows = [(1, "alpha BETA gamma delta"), (2, "alpha beta gamma delta"), (3, None), (4, ""), (None, "long words long")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
