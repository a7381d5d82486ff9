"""Where loads keep their tables, and which load readers see.

All loads below one folder share it: the rows of a table that belong to a load lie in
``<folder>/<table>/load=at-<load>``. Publishing appends one row to the table ``publicaciones``, and every
published view shows the load which that table names last. So all views change together, by one
file that either is there or is not; a query over several views reads one load.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "publicaciones"
POINTER_SCHEMA = "numero bigint, load string, publicado timestamp"


def _parts(folder: str) -> tuple[str, str]:
    root, _, name = folder.rstrip("/").rpartition("/")
    if not root or not name:
        raise ValueError(f"{folder} is not a load folder inside another folder")
    return root, f"at-{name}"


def located(folder: str, table: str) -> str:
    """The path of a load's table."""
    root, load = _parts(folder)
    return f"{root}/{table}/load={load}"


def publications(spark: SparkSession, root: str) -> DataFrame:
    """``(numero, load, publicado)`` of all publications so far; the first row names no load."""
    pointer = f"{root}/{POINTER}"
    try:
        return spark.read.schema(POINTER_SCHEMA).parquet(pointer)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    _append(spark, pointer, 0, None)
    return spark.read.schema(POINTER_SCHEMA).parquet(pointer)


def _append(spark: SparkSession, pointer: str, number: int, load: str | None) -> None:
    row = spark.range(1).select(
        F.lit(number).cast("bigint").alias("numero"),
        F.lit(load).cast("string").alias("load"),
        F.current_timestamp().alias("publicado"),
    )
    row.write.mode("append").parquet(pointer)


def published(spark: SparkSession, root: str) -> str | None:
    """The folder of the load that readers see."""
    last = publications(spark, root).agg(F.max(F.struct("numero", "load"))).first()[0]
    return None if last["load"] is None else f"{root}/{last['load'].removeprefix('at-')}"


def publish(
    spark: SparkSession, folder: str, tables: Iterable[str], database: str | None = None
) -> None:
    """Make ``folder`` the load that the views called ``tables`` show.

    The views do not name a load, so creating them again changes nothing for readers; only the last
    step does. With a ``database`` they are kept in the catalog, otherwise in the session.
    """
    root, load = _parts(folder)
    number = publications(spark, root).agg(F.max("numero")).first()[0]
    last = f"(SELECT max(struct(numero, load)).load FROM parquet.`{root}/{POINTER}`)"
    for table in tables:
        kind, name = ("TEMPORARY VIEW", table) if database is None else ("VIEW", f"{database}.{table}")
        spark.sql(
            f"CREATE OR REPLACE {kind} {name} AS "
            f"SELECT * EXCEPT (load) FROM parquet.`{root}/{table}` WHERE load = {last}"
        )
    _append(spark, f"{root}/{POINTER}", number + 1, load)
