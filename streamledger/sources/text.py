"""Text files as a table of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``textFile(path)``: one row per line, column ``value``.

    Lines end at ``\\n``, ``\\r`` or ``\\r\\n``; large files are split across
    tasks by the file source, so the read is parallel.
    """
    return spark.read.text(path)


def write_lines(df: DataFrame, col: str, path: str) -> None:
    """Write one text column as a text file (each value then a line break)."""
    df.select(col).write.mode("overwrite").text(path)
