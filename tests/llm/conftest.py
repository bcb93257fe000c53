import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Makes a documents table, with a column whose name clashes with names that operators use."""

    def make(texts, langs=None, ids=None, extra=True):
        rows = [(ids[i] if ids else i, t, langs[i] if langs else "en", f"src{i % 2}", len(t or "")) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, DOCUMENTS)
        return df.selectExpr("*", "'x' as fp", "1 as n_words", "2 as block") if extra else df

    return make
