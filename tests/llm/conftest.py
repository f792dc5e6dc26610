import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
for path in (HERE, HERE.parents[1], HERE.parent):
    if str(path) not in sys.path:
        sys.path.insert(0, str(path))


@pytest.fixture(scope="session")
def texts(spark):
    from plain import SF

    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in any column, ties, repeated rows, long and empty
    texts, and columns whose names clash with the operators' own."""
    from plain import ODD_TEXTS

    rows = [(i, t, "en", "src1", 1, 7, 0.5, 3) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id", "en", None, None, None, None, None), (None, None, None, None, None, None, None, None),
             (3, "one", None, "src2", 1, 7, 0.5, 3), (3, "one", "en", "src1", 1, 7, 0.5, 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rep long, score double, label int")
