"""Managed catalog tables: create, overwrite, query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def use_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")


def drop_database(spark: SparkSession, name: str) -> None:
    """Remove a database with its tables."""
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def create_orc_table(spark: SparkSession, table: str, ddl: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING orc")


def load_overwrite(df: DataFrame, table: str) -> None:
    """Replace the table's rows; columns are matched by name to the table's order."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table, overwrite=True)
