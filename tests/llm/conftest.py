import pytest
from llm_samples import ODD


@pytest.fixture(scope="session")
def odd(spark):
    """ODD as documents with a source, a language and a column whose name clashes with what operators add."""
    rows = [(i, t, "en", None if k % 3 == 0 else f"s{k % 3}", k, f"kept {k}") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score_ string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("doc_id = -1")
