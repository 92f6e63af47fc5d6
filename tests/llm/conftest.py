import pytest

from topicstream.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def docs_of(llm):
    """A function from (doc_id, text, lang) rows to a documents table with clashing extra columns."""

    def build(rows):
        wide = [(*r, "en", "s", 1)[:3] + ("x", "y", "z", 1.0) if len(r) == 2 else (*r, "x", "y", "z", 1.0) for r in rows]
        kinds = "doc_id long, text string, lang string, component_id string, digest string, id string, score double"
        return llm.createDataFrame(wide, kinds)

    return build
