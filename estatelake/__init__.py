"""Listings analytics on Spark.

A medallion pipeline for property-listing messages, written as plain
DataFrame-to-DataFrame functions:

* ``sources``   – message stream / file / JDBC readers and the listings adapter
* ``operators`` – message parse/encode, silver refinement, gold marts, sampling
* ``functions`` – column expressions (exact averages, strict parsing, fences)
* ``streaming`` – bronze ingest and incremental silver with checkpoints
* ``sinks``     – partitioned Parquet append and JDBC overwrite
* ``plans``     – SQL surface over the marts and the batch pipeline driver
"""

__all__ = ["schemas", "session"]
