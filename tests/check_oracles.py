"""Run all or the named oracle comparisons: python tests/check_oracles.py [name ...]."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from tests.oracle import DATA, connect, differences  # noqa: E402


def main() -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect()
    known, oracles = queries(), oracle_sql()
    bad = 0
    for name in sys.argv[1:] or known:
        started = time.time()
        try:
            if name in oracles:
                found = differences(spark, name, known[name], oracles[name], con)
                note = found or "same"
            else:
                df = known[name](spark, DATA)
                note = f"rows {df.count()} (no SQL)"
                found = None
        except Exception as failure:  # noqa: BLE001
            found = note = f"{name}: {type(failure).__name__}: {str(failure)[:600]}"
        bad += found is not None
        print(f"{name:28s} {time.time() - started:6.2f}s {note[:900]}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
