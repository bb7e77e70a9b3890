"""The text operators' tests are skipped where the subpackage is absent."""

import importlib.util

import pytest

collect_ignore_glob = [] if importlib.util.find_spec("tallyspark.llm") else ["test_*.py"]
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, digest string, score double, ids string, rank int"


@pytest.fixture
def documents(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``, with extra columns whose names operators use too."""
    def of(*rows):
        return spark.createDataFrame(
            [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, "d", 0.5, "i", 3) for r in rows], DOCUMENT)

    return of


@pytest.fixture
def scratch(spark):
    from tallyspark.session import Scratch

    return Scratch(spark)
