"""Table sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def write_table(
    rows: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    clustered: bool = False,
) -> None:
    """Full-refresh Parquet sink.

    With ``partition_by`` rows are rebalanced first: a folder gets files of the advisory size,
    written by as many tasks as its share of the data needs, instead of one file per input task.
    ``clustered`` rows, read from files that hold one folder's rows each, are written as they lie.
    """
    if partition_by and not clustered:
        rows = rows.hint("rebalance", *partition_by)
    rows.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    batch_rows: int = 1000,
    mode: str = "append",
) -> None:
    """Database sink; ``overwrite`` empties the table first but keeps its definition."""
    (
        rows.write.format("jdbc")
        .options(url=url, dbtable=table, truncate="true", batchsize=batch_rows, **properties)
        .mode(mode)
        .save()
    )


def write_report(rows: DataFrame, path: str) -> None:
    """Metrics as JSON lines in one file; for reports, whose rows are a fixed handful."""
    rows.coalesce(1).write.json(path)
