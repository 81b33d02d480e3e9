"""Batches of texts between Spark and its Python workers."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Spark's default of 10,000 rows a batch would be gigabytes of long texts in each worker
ROWS = 512


def small_batches(frame: DataFrame) -> DataFrame:
    """The frame itself, in a session that hands ``ROWS`` rows at a time to Python.

    The setting is read when a plan runs, so it stays set for the session.
    """
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    return frame
