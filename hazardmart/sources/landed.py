"""Intermediates written once and read back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame

from hazardmart.session import shared_folder


def land(rows: DataFrame, label: str) -> DataFrame:
    """Write ``rows`` to the shared folder and return the written table.

    The copy survives lost executors, is computed once however often it is used, and has a
    file size from which Catalyst can decide whether to broadcast it.
    """
    path = f"{shared_folder(rows.sparkSession)}/{label}-{uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
