"""Timestamps written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.schemas import TIME_FORMAT


def parse_time(text: Column | str) -> Column:
    """Timestamp from text, null where the text does not follow the pattern.

    The strict parser would fail the whole query on the first bad message.
    """
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT))


def format_time(moment: Column | str) -> Column:
    return F.date_format(moment, TIME_FORMAT)
