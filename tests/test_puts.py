"""Puts with a commit: what no manifest names is not there."""

import os

import pytest
from pyspark.sql import functions as F

from millrace.sinks.puts import PutWriter, Written, committed_files, put_rows, read_puts


def test_puts_of_two_jobs_are_read_back(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = spark.range(2500).select(F.format_string("k%04d", "id").alias("rowkey"), F.col("id").alias("n"))
    put_rows(rows.repartition(3), folder, put_rows=100)
    put_rows(rows.limit(5), folder, partitions=1)
    assert len(committed_files(folder)) == 4
    got = read_puts(spark, folder, rows.schema)
    assert got.count() == 2505 and got.agg(F.sum("n")).first()[0] == sum(range(2500)) + 10
    assert read_puts(spark, str(tmp_path / "none"), rows.schema).count() == 0


def test_a_failed_job_leaves_nothing_to_read(spark, tmp_path):
    folder = str(tmp_path / "t")
    good = spark.range(10).select(F.col("id").cast("string").alias("rowkey"))
    put_rows(good, folder)
    bad = spark.range(0, 1000, 1, 4).select(
        F.when(F.col("id") == 900, F.raise_error(F.lit("broken row"))).otherwise(F.col("id").cast("string")).alias("rowkey")
    )
    with pytest.raises(Exception, match="broken row"):
        put_rows(bad, folder)
    assert read_puts(spark, folder, good.schema).count() == 10


def test_files_of_lost_attempts_are_not_read(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = spark.range(10).select(F.col("id").cast("string").alias("rowkey"))
    put_rows(rows, folder)
    (tmp_path / "t" / "data" / "half.json").write_text('{"rowkey": "lo')
    assert read_puts(spark, folder, rows.schema).count() == 10
    writer = PutWriter(folder, 10)
    lost = writer.write(iter(()))
    writer.abort([lost, None])
    assert lost == Written(lost.file, 0) and not os.path.exists(f"{folder}/data/{lost.file}")
