"""Page records `md5 SEP url SEP html`: parsing, validation, host."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import FIELD_SEP, record_md5
from millrace.functions.text import java_split
from millrace.functions.urls import HOST_NULL, url_host

OK, FILTERED = "ok", "filtered"


def parse_records(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add `md5`, `url`, `html` and `n_fields`; every other column is kept."""
    fields = F.col("__fields")
    n = F.coalesce(F.size(fields), F.lit(0))
    return (
        lines.withColumn("__fields", java_split(value, FIELD_SEP))
        .withColumn("n_fields", n)
        .withColumn("md5", F.when(n.isin(2, 3), F.get(fields, F.lit(0))))
        .withColumn("url", F.when(n.isin(2, 3), F.get(fields, F.lit(1))))
        .withColumn("html", F.when(n == 3, F.get(fields, F.lit(2))))
        .drop("__fields", value)
    )


def validate(records: DataFrame) -> DataFrame:
    """Add `host` and `status`.

    Three fields with a matching checksum are ok. Two fields, or a wrong checksum, are
    filtered under the URL's host; any other field count or an unusable URL is filtered
    under HOST_NULL.
    """
    host = F.when(F.col("n_fields").isin(2, 3), url_host("url"))
    good = (
        (F.col("n_fields") == 3)
        & host.isNotNull()
        & (record_md5("url", "html") == F.col("md5"))
    )
    return records.withColumns(
        {
            "host": F.coalesce(host, F.lit(HOST_NULL)),
            "status": F.when(good, OK).otherwise(FILTERED),
        }
    )
