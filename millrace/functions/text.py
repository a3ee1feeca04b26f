"""String expressions with the JVM's string rules, built from Spark functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTROL_OR_SPACE = r"^[\x00-\x20]+|[\x00-\x20]+$"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_pattern(sep: str) -> str:
    """A regular expression for a literal; one character stays on the JVM's fast split path."""
    if len(sep) == 1:
        return f"\\{sep}" if sep in ".$|()[{^?*+\\" else sep
    return f"\\Q{sep}\\E"


def java_split(c: Column | str, sep: str = " ") -> Column:
    """Split on a literal separator the way Java does.

    Trailing empty tokens are dropped, leading and inner ones are kept, the empty
    string gives one empty token and a separator-only string gives none.
    """
    c = col_of(c)
    quoted = literal_pattern(sep)
    if len(sep) == 1:
        stripped = F.rtrim(c, F.lit(sep))
    else:
        stripped = F.regexp_replace(c, f"(?:{quoted})+$", "")
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, quoted))
    )


def java_trim(c: Column | str) -> Column:
    """Strip every leading and trailing character up to U+0020."""
    return F.regexp_replace(col_of(c), CONTROL_OR_SPACE, "")


def java_length(c: Column | str) -> Column:
    """Length in UTF-16 units: characters beyond the basic plane count twice."""
    c = col_of(c)
    return F.length(c) + F.length(F.regexp_replace(c, r"[^\x{10000}-\x{10FFFF}]", ""))


def norm_null(c: Column | str) -> Column:
    """Null, the empty string and the word null are all null."""
    c = col_of(c)
    return F.when(~c.isin("", "null"), c)


def is_blank(c: Column | str) -> Column:
    """Null or nothing but control characters and spaces."""
    c = col_of(c)
    return c.isNull() | (java_trim(c) == "")


def is_empty_collection(c: Column | str) -> Column:
    """Null or zero elements, for arrays and maps."""
    c = col_of(c)
    return c.isNull() | (F.size(c) == 0)


def suffix_route(c: Column | str, buckets: int = 2, sep: str = "_") -> Column:
    """Number after the first separator, modulo the bucket count."""
    number = F.split_part(col_of(c), F.lit(sep), F.lit(2)).try_cast("int")
    return number % F.lit(buckets)


def register_sql_functions(spark) -> None:
    """`name_length(text)` for SQL text: a SQL function, so plans stay in the JVM."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION name_length(s STRING) RETURNS INT "
        r"RETURN length(s) + length(regexp_replace(s, '[^\\x{10000}-\\x{10FFFF}]', ''))"
    )
