"""Event times, time texts and window texts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def event_time(time_text: Column, date_text: Column | None = None) -> Column:
    """Time stamp (no zone) of a date text and a time-of-day text; null for bad text.

    Dates may be ``MM/dd/yyyy`` or start with ``yyyy-MM-dd``. Without a date the time is placed
    on the current day, so a replay on another day gives other values. Text of another form never
    reaches the cast, which is slow where it fails.
    """
    if date_text is None:
        day = F.current_date().cast("string")
    else:
        american = F.concat_ws(
            "-", F.substring(date_text, 7, 4), F.substring(date_text, 1, 2), F.substring(date_text, 4, 2)
        )
        day = F.when(date_text.rlike(r"^\d\d/\d\d/\d{4}$"), american).otherwise(
            F.substring(date_text, 1, 10)
        )
    stamp = F.concat(day, F.lit(" "), time_text)
    is_stamp = stamp.rlike(r"^\d{4}-\d\d-\d\d \d\d?:\d\d?(?::\d\d?(?:\.\d+)?)?$")
    return F.when(is_stamp, stamp.try_cast("timestamp_ntz"))


def minute_of_day(time: Column) -> Column:
    """Minutes since midnight of a time stamp."""
    return F.hour(time) * 60 + F.minute(time)


def window_text(window: Column) -> Column:
    """``[start, end]`` of a window struct, the same in every Spark version."""
    return F.concat(
        F.lit("["),
        F.date_format(window["start"], "yyyy-MM-dd HH:mm:ss"),
        F.lit(", "),
        F.date_format(window["end"], "yyyy-MM-dd HH:mm:ss"),
        F.lit("]"),
    )


def iso_text(time: Column) -> Column:
    """ISO text of a date or time stamp, as sent on the wire."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
