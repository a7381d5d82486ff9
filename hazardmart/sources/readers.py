"""Staging readers: Parquet, CSV and JDBC, always as text columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


RECORD, FILE = "_record", "_file"


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] | None = None
) -> DataFrame:
    """Parquet staging table; a column that the table lacks reads as NULL unless it is ``required``.

    By default all are, so a misspelt column fails the read instead of emptying a measure.
    """
    wanted = set(schema.fieldNames() if required is None else required)
    missing = sorted(wanted - set(spark.read.parquet(path).columns))
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return spark.read.schema(schema).parquet(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, quoted_newlines: bool = True
) -> DataFrame:
    """UTF-8 CSV with a header, quoted commas and, by default, quoted line breaks.

    The header is compared with the schema: reading fails where names differ or change places.
    Records with too few or too many fields are left out here and kept by :func:`csv_rejects`.

    A file whose records may span lines cannot be split, so its unit of parallelism is the
    file: deliver large data as many files, or set ``quoted_newlines=False`` where no field
    holds a line break and Spark may split each file.
    """
    records = _csv_records(spark, path, schema, quoted_newlines)
    return records.where(~_rejected(schema)).select(*schema.fieldNames())


def csv_rejects(
    spark: SparkSession, path: str, schema: T.StructType, quoted_newlines: bool = True
) -> DataFrame:
    """``(archivo, registro)``: the file name and the raw text of every record that does not fit the schema."""
    records = _csv_records(spark, path, schema, quoted_newlines)
    return records.where(_rejected(schema)).select(F.col(FILE).alias("archivo"), F.col(RECORD).alias("registro"))


def _rejected(schema: T.StructType) -> Column:
    """Whether a record does not fit; a field takes part, since Spark refuses to read raw records alone."""
    nothing = F.substring(F.col(schema.fieldNames()[0]), 1, 0)
    return F.concat_ws("", F.col(RECORD), nothing) != ""


def _csv_records(
    spark: SparkSession, path: str, schema: T.StructType, quoted_newlines: bool
) -> DataFrame:
    """All records with their file and, where they do not fit the schema, their raw text.

    Every field is parsed, whatever columns a query needs: which records are rejected would
    otherwise depend on the query.
    """
    return (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", quoted_newlines)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .option("columnPruning", False)
        .csv(path)
        .select("*", F.col("_metadata.file_name").alias(FILE))
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    schema: T.StructType,
    properties: Mapping[str, str],
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Database staging table, cast to text.

    ``split`` is ``(numeric column, lower, upper, tasks)``: Spark then reads that many slices in
    parallel (bounds only steer the slices, no row is left out). Without it one task reads all.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if split:
        column, lower, upper, tasks = split
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=tasks
        )
    rows = reader.load()
    return rows.select([F.col(field.name).cast("string") for field in schema])
