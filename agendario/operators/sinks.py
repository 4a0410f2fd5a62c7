"""Publication: light and full JSON, CSV, calendars."""

from __future__ import annotations

import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def light(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, json) of each row without its null fields."""
    return rows.select(key, F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}).alias("json"))


def write_by_day(rows: DataFrame, day: str, path: str) -> None:
    """One folder of JSON per day, full rows; a day's rows are brought together first, so files are few."""
    rows.repartition(day).write.mode("overwrite").partitionBy(day).json(path)


def write_csv(rows: DataFrame, path: str, sep: str = ";") -> None:
    """``;``-separated text with a header; arrays are joined by commas."""
    flat = [F.array_join(c, ", ").alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes]
    rows.select(*flat).write.mode("overwrite").csv(path, sep=sep, header=True)


@F.arrow_udf(StringType())
def folded(lines: pa.Array) -> pa.Array:
    """iCalendar content lines folded at 75 octets without cutting a character."""
    out = []
    for line in lines.to_pylist():
        parts, now, size = [], "", 0
        for c in line or "":
            n = len(c.encode())
            if size + n > (75 if not parts else 74):
                parts.append(now)
                now, size = "", 0
            now, size = now + c, size + n
        out.append("\r\n ".join([*parts, now]))
    return pa.array(out, pa.string())


def _escaped(text: Column) -> Column:
    for plain, said in (("\\", "\\\\"), (";", "\\;"), (",", "\\,"), ("\n", "\\n")):
        text = F.replace(text, F.lit(plain), F.lit(said))
    return text


def calendar_events(rows: DataFrame, uid: Column, day: Column, title: Column, place: Column, stamp: datetime.datetime) -> DataFrame:
    """``rows`` with ``vevent``: an all-day iCalendar event of each."""
    lines = [
        F.lit("BEGIN:VEVENT"), F.concat(F.lit("UID:"), uid), F.lit(f"DTSTAMP:{stamp:%Y%m%dT%H%M%SZ}"),
        F.concat(F.lit("DTSTART;VALUE=DATE:"), F.date_format(day, "yyyyMMdd")),
        folded(F.concat(F.lit("SUMMARY:"), _escaped(title))), folded(F.concat(F.lit("LOCATION:"), _escaped(place))), F.lit("END:VEVENT"),
    ]
    return rows.withColumn("vevent", F.concat_ws("\r\n", *lines))
