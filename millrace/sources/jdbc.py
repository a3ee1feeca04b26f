"""JDBC tables as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    """Connection of one table. With bounds, the scan is cut into parallel range queries."""

    url: str
    table: str
    driver: str | None = None
    user: str | None = None
    password: str | None = None
    partition_column: str | None = None
    lower: int | str | None = None
    upper: int | str | None = None
    partitions: int | None = None
    fetch_size: int = 10_000
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        given = {
            "url": self.url,
            "dbtable": self.table,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
            "fetchsize": self.fetch_size,
        }
        if self.partition_column is not None:
            if self.lower is None or self.upper is None or not self.partitions:
                raise ValueError("a partition column needs lower, upper and partitions")
            given |= {
                "partitionColumn": self.partition_column,
                "lowerBound": self.lower,
                "upperBound": self.upper,
                "numPartitions": self.partitions,
            }
        return {k: str(v) for k, v in given.items() if v is not None} | self.extra


def read_table(spark: SparkSession, table: JdbcTable) -> DataFrame:
    """Scan through `format("jdbc")`; filters and columns are pushed to the database."""
    return spark.read.format("jdbc").options(**table.options()).load()


def read_table_by_properties(spark: SparkSession, table: JdbcTable) -> DataFrame:
    """The same scan through `spark.read.jdbc`."""
    given = table.options()
    url, name = given.pop("url"), given.pop("dbtable")
    return spark.read.jdbc(url, name, properties=given)
