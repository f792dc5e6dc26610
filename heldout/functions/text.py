"""Per-document numeric features, as JVM-side column expressions.

They read the whole text of every row; none of them truncates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A "word" is a maximal run of characters other than space,
# tab, carriage return and newline.
WORD_PATTERN = "[^ \\t\\r\\n]+"


def word_count(text: str | Column) -> Column:
    """Number of words in the text (0 for an empty text)."""
    return F.regexp_count(F.col(text) if isinstance(text, str) else text,
                          F.lit(WORD_PATTERN))


def line_count(text: str | Column) -> Column:
    """Number of lines: newline characters plus one."""
    col = F.col(text) if isinstance(text, str) else text
    return F.length(col) - F.length(F.replace(col, F.lit("\n"), F.lit(""))) + 1


def log_length(n_chars: str | Column) -> Column:
    """Natural log of (characters + 1)."""
    col = F.col(n_chars) if isinstance(n_chars, str) else n_chars
    return F.log(col.cast("double") + F.lit(1.0))


def document_features(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``log_chars``, ``n_words`` for each document."""
    return docs.select(
        "doc_id",
        log_length("n_chars").alias("log_chars"),
        word_count("text").cast("double").alias("n_words"),
    )
