"""millrace: text, table, keyed-table, stream and web-page jobs on PySpark DataFrames."""
