"""Time and duration expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# full_log keys holding the duration of a question sequence, in milliseconds
MTURK_DURATION_KEY = "totalDurationUntilMturkSubmit"
SEQUENCE_DURATION_KEY = "totalDurationQuestionSequence"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def total_time(full_log="full_log", mode="mode") -> Column:
    """Seconds spent on the question sequence; the key depends on the row's mode."""
    # one parse per row, only the two duration fields are materialised
    log = F.from_json(_c(full_log), f"struct<{MTURK_DURATION_KEY}:double,{SEQUENCE_DURATION_KEY}:double>")
    raw = F.when(_c(mode) == "mturk", log[MTURK_DURATION_KEY]).otherwise(log[SEQUENCE_DURATION_KEY])
    return raw / 1000.0


def twitter_timestamp(c="created_at") -> Column:
    """'Wed Aug 27 13:08:45 +0000 2008' -> timestamp (the weekday is dropped); null for anything else."""
    return F.try_to_timestamp(F.substring(_c(c), 5, 100), F.lit("MMM dd HH:mm:ss Z yyyy"))


PERIOD_FORMATS = {"years": "yyyy", "months": "yyyy-MM", "days": "yyyy-MM-dd"}


def period_key(c="created_at", period: str = "months") -> Column:
    """Bin key of a timestamp: 'years', 'months', 'days' or 'all' (one bin)."""
    if period == "all":
        return F.lit("")
    return F.date_format(_c(c), PERIOD_FORMATS[period])
