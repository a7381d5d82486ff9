"""Run one load from the command line: ``python -m hazardmart --help``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from hazardmart.catalogues import Catalogues
from hazardmart.periods import YearRange
from hazardmart.plans.cleanse import DISASTERS, EMERGENCIES, PREVENTION, SourceSpec
from hazardmart.plans.load import Staging, read_load, run_load
from hazardmart.schemas import DISASTER_STAGING, EMERGENCY_STAGING, PROJECT_STAGING
from hazardmart.session import build_session, shuffle_settings
from hazardmart.sources.publication import located
from hazardmart.sources.readers import csv_rejects, read_csv, read_parquet
from hazardmart.sources.writers import write_table

# Table of the CSV records that do not fit their schema, by declaration type.
CSV_REJECTS = "registros_rechazados"


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="hazardmart", description=__doc__)
    parser.add_argument("--disasters", required=True, help="path of the disaster declarations")
    parser.add_argument("--emergencies", required=True, help="path of the emergency declarations")
    parser.add_argument("--projects", required=True, help="path of the prevention projects")
    parser.add_argument("--folder", required=True, help="new folder for this load")
    parser.add_argument("--format", choices=["csv", "parquet"], default="csv", help="format of the sources")
    parser.add_argument("--previous", help="folder of an earlier load whose ids are kept")
    parser.add_argument("--database", help="catalog database that receives the views")
    parser.add_argument("--first-year", type=int, default=YearRange.first)
    parser.add_argument("--last-year", type=int, default=YearRange.last)
    parser.add_argument("--prevention", action="store_true", help="load projects as events too")
    parser.add_argument("--consolidated", action="store_true", help="one fact row per key")
    parser.add_argument("--latest-only", action="store_true", help="one row per state, year, phenomenon")
    parser.add_argument("--catalogues", help="folder of the catalogues, if not the bundled ones")
    parser.add_argument("--strict", action="store_true", help="reject unlisted phenomena and types")
    parser.add_argument("--plain-lines", action="store_true", help="no CSV field holds a line break")
    parser.add_argument("--shuffle-bytes", type=int, help="size of the largest expected shuffle")
    options = parser.parse_args(arguments)

    sized = shuffle_settings(options.shuffle_bytes) if options.shuffle_bytes else {}
    spark = build_session(**sized)

    def source(path: str, schema: StructType, spec: SourceSpec) -> DataFrame:
        if options.format == "parquet":
            return read_parquet(spark, path, schema, required=spec.columns())
        lines = not options.plain_lines
        rejects = csv_rejects(spark, path, schema, quoted_newlines=lines)
        write_table(rejects, located(options.folder, f"{CSV_REJECTS}_{spec.event_type}"), mode="error")
        return read_csv(spark, path, schema, quoted_newlines=lines)

    load = run_load(
        Staging(
            disasters=source(options.disasters, DISASTER_STAGING, DISASTERS),
            emergencies=source(options.emergencies, EMERGENCY_STAGING, EMERGENCIES),
            projects=source(options.projects, PROJECT_STAGING, PREVENTION),
        ),
        options.folder,
        catalogues=Catalogues.read(spark, options.catalogues) if options.catalogues else None,
        years=YearRange(options.first_year, options.last_year),
        include_prevention=options.prevention,
        consolidated=options.consolidated,
        previous=read_load(spark, options.previous) if options.previous else None,
        database=options.database,
        strict=options.strict,
        latest_only=options.latest_only,
    )
    print(f"loaded into {load.folder}")


if __name__ == "__main__":
    main()
