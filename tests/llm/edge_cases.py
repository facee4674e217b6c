import pytest

EDGE_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, slot int, part int"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(40_000))
    texts = [None, "", "", "a", "a b c", "The same text.", "The same text.", "The same text.", long, long, "Ünï çödé 中文 ١٢ ́x", " \n ", "x" * 5000]
    rows = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", None, "r", i, 1) for i, t in enumerate(texts)]
    rows += [(3, "a", None, "s0", 1, None, None, None), (3, "a", None, "s0", 1, None, None, None), (None, "The same text.", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, EDGE_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)
