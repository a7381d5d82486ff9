"""Year range and period bounds, kept as data so that every analytic can be re-aimed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class YearRange:
    """Inclusive range of years a load keeps; a null year is outside."""

    first: int = 2018
    last: int = 2025

    def holds(self, year: Column) -> Column:
        return year.between(self.first, self.last)


@dataclass(frozen=True)
class Periods:
    """Three periods that partition all years: before, during and after [first, last]."""

    first: int = 2020
    last: int = 2021
    # Labels shown to report users.
    before_label: str = "Pre-pandemia"
    during_label: str = "Pandemia"
    after_label: str = "Post-pandemia"

    def before(self, year: Column) -> Column:
        return year < self.first

    def during(self, year: Column) -> Column:
        return year.isin(list(range(self.first, self.last + 1)))

    def after(self, year: Column) -> Column:
        return year > self.last

    def label(self, year: Column) -> Column:
        return (
            F.when(self.before(year), self.before_label)
            .when(self.during(year), self.during_label)
            .otherwise(self.after_label)
        )


YEARS = YearRange()
PERIODS = Periods()
