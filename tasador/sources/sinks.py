"""Sinks (S7, S11): the run-metadata document and scored responses."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_metadata(doc: DataFrame, path: str) -> None:
    """The one-row metadata document (``metadata`` JSON string column)
    as a single text file. The frame has one row by construction, so
    ``coalesce(1)`` moves no data between tasks."""
    doc.select("metadata").coalesce(1).write.mode("overwrite").text(path)


def write_responses(responses: DataFrame, path: str, partition_by: str = "segment") -> None:
    """Scored responses as parquet partitioned by segment, so readers
    of one segment prune the others."""
    responses.write.mode("overwrite").partitionBy(partition_by).parquet(path)
