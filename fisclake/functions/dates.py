"""Processing times: strings ``dd/MM/yyyy HH:mm:ss`` as the source writes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the format of DHPROC, DHEMI, DHRECBTO and DHEVENTO.
SOURCE_FORMAT = "dd/MM/yyyy HH:mm:ss"


def formatted_hour(stamp: str | Column = "DHPROC") -> Column:
    """``dd/MM/yyyy HH:…`` as ``yyyyMMddHH``."""
    parts = ((7, 4), (4, 2), (1, 2), (12, 2))
    return F.concat(*(F.substring(stamp, start, length) for start, length in parts))


def timestamp(stamp: str | Column = "DHPROC") -> Column:
    """The time itself, NULL where the string is not one."""
    return F.try_to_timestamp(F.col(stamp) if isinstance(stamp, str) else stamp, F.lit(SOURCE_FORMAT))


def day_parts(stamp: str | Column = "DHPROC") -> dict[str, Column]:
    """year, month and day by position, two digits each for month and day."""
    return {
        "year": F.substring(stamp, 7, 4),
        "month": F.substring(stamp, 4, 2),
        "day": F.substring(stamp, 1, 2),
    }


def parsed_day_parts(stamp: str | Column = "DHPROC") -> dict[str, Column]:
    """year, month and day of a real time; all NULL where the string does not parse."""
    time = timestamp(stamp)
    return {"year": F.date_format(time, "yyyy"), "month": F.date_format(time, "MM"), "day": F.date_format(time, "dd")}


def with_parsed_day(df: DataFrame, stamp: str = "DHPROC") -> DataFrame:
    """Add year, month and day; rows whose time does not parse are dropped."""
    return df.withColumns(parsed_day_parts(stamp)).filter(F.col("year").isNotNull())


def hour_parts(time: str | Column) -> dict[str, Column]:
    """Layout of the hourly landing folders."""
    return {
        "ano": F.date_format(time, "yyyy"),
        "mes": F.date_format(time, "MM"),
        "dia": F.date_format(time, "dd"),
        "hora": F.date_format(time, "HH"),
    }


def within_day(time: str | Column, day: str) -> Column:
    """Half-open day window, so that no fraction of the last second is lost and the filter reaches the scan."""
    time = F.col(time) if isinstance(time, str) else time
    start = F.lit(day).cast("date").cast("timestamp_ntz")
    return (time >= start) & (time < start + F.expr("INTERVAL 1 DAY"))


def within_hour(time: str | Column, hour: str) -> Column:
    """Half-open hour window; ``hour`` is ``yyyy-MM-dd HH:00:00``."""
    time = F.col(time) if isinstance(time, str) else time
    start = F.lit(hour).cast("timestamp_ntz")
    return (time >= start) & (time < start + F.expr("INTERVAL 1 HOUR"))
