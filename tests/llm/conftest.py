import pytest

from orderflow.llm.base import ship

SF = "/root/testdata/sf0.001"


@pytest.fixture
def sp(spark):
    ship(spark)
    return spark


@pytest.fixture
def frame(sp):
    """rows -> documents table with clashing extra columns."""
    def make(rows, extra=("score", "fp", "n_words", "kept")):
        cols = "doc_id long, text string, lang string, source string" + "".join(f", `{c}` string" for c in extra)
        full = [tuple(r) + (None,) * (4 - len(r)) + ("x",) * len(extra) for r in rows]
        return sp.createDataFrame(full, cols).repartition(3)
    return make


@pytest.fixture
def table(sp):
    return lambda name: sp.read.parquet(f"{SF}/{name}.parquet")
