"""Words of text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame


def word_counts(lines: DataFrame) -> DataFrame:
    """Count per word of the ``value`` column, cut at every single space.

    Doubled spaces give empty words; case and other white space are kept.
    """
    return lines.selectExpr("explode(split(value, ' ')) as word").groupBy("word").count()
