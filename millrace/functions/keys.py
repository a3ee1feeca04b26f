"""Record keys: md5 keys, time keys and row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import col_of

FIELD_SEP = "\x01"


def record_md5(url: Column | str, html: Column | str) -> Column:
    """Checksum of a page record: md5 of url, separator, html."""
    return F.md5(F.concat(col_of(url), F.lit(FIELD_SEP), col_of(html)))


def minute_stamp(ts: Column | str) -> Column:
    return F.date_format(col_of(ts), "yyyy-MM-dd HH:mm")


def second_stamp(ts: Column | str) -> Column:
    return F.date_format(col_of(ts), "yyyy-MM-dd HH:mm:ss")


def put_stamp(ts: Column | str) -> Column:
    """Seconds followed by the milliseconds padded to four digits."""
    ts = col_of(ts)
    return F.concat(
        F.date_format(ts, "yyyyMMddHHmmss"), F.lpad(F.date_format(ts, "SSS"), 4, "0")
    )


def hour_stamp(ts: Column | str) -> Column:
    return F.date_format(col_of(ts), "yyyyMMddHH")


def scan_day(ts: Column | str) -> Column:
    return F.date_format(col_of(ts), "yyyyMMdd").cast("int")


def scan_hour(ts: Column | str) -> Column:
    return F.date_format(col_of(ts), "HH").cast("int")


def hour_md5(ts: Column | str) -> Column:
    return F.md5(hour_stamp(ts))


def page_rowkey(host: Column | str, ts: Column | str, url: Column | str) -> Column:
    return F.concat_ws("_", col_of(host), put_stamp(ts), F.md5(col_of(url)))


def prefixed_key(prefix: str, number: Column | str) -> Column:
    return F.concat(F.lit(prefix + "_"), col_of(number).cast("string"))
