"""Analytics for tables that arrive as periodic snapshots, on PySpark.

Everything is a function from DataFrame to DataFrame, so the pieces chain with
``DataFrame.transform``. Streams, sinks and composite jobs are thin layers on
top of the same functions.
"""
