"""Reporting periods: year-to-date through each of a set of months, for each of a set of years or for every year."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Periods:
    """Report months of some years; a report for month m covers months 1..m of its year.

    Without ``years`` (None) every year of the data is meant: nothing is read to find them, and a whole
    year needs no test of dates at all. Given years become ranges that reach the file scan.
    """

    years: tuple[int, ...] | None
    months: tuple[int, ...]

    def __post_init__(self) -> None:
        if self.years is not None and not self.years or not self.months:
            raise ValueError("at least one year and one month are needed")
        if min(self.months) < 1 or max(self.months) > 12:
            raise ValueError("months run from 1 to 12")
        if self.years is not None:
            object.__setattr__(self, "years", tuple(sorted(set(self.years))))
        object.__setattr__(self, "months", tuple(sorted(set(self.months))))

    @classmethod
    def of(cls, year: int, month: int) -> Periods:
        return cls((year,), (month,))

    @classmethod
    def months_of(cls, year: int, first: int, last: int) -> Periods:
        return cls((year,), tuple(range(first, last + 1)))

    @classmethod
    def every_year(cls, *months: int) -> Periods:
        return cls(None, months)

    @property
    def last(self) -> int:
        return self.months[-1]

    def of_months(self, *months: int) -> Periods:
        """Other report months of the same years."""
        return Periods(self.years, months)

    def _runs(self) -> list[tuple[int, int]]:
        """Years as (first, last) runs that one range of months covers without a gap."""
        runs: list[tuple[int, int]] = []
        for year in self.years:
            if runs and self.last == 12 and runs[-1][1] == year - 1:
                runs[-1] = (runs[-1][0], year)
            else:
                runs.append((year, year))
        return runs

    def dates(self, column: str) -> Column:
        """Date ranges on ``column``; unlike ``year(d) = ...`` they reach the file scan."""
        if self.years is None:
            return F.col(column).isNotNull() if self.last == 12 else F.month(column) <= self.last
        test = F.lit(False)
        for first, last in self._runs():
            end = dt.date(last + self.last // 12, self.last % 12 + 1, 1)
            run = (F.col(column) >= F.lit(dt.date(first, 1, 1))) & (F.col(column) < F.lit(end))
            test = test | run
        return test

    def keys(self, column: str) -> Column:
        """The same for a ``yyyymm`` column: one range, which reaches the file scan, and the rest of
        the test only where the range has gaps."""
        if self.years is None:
            return F.col(column).isNotNull() if self.last == 12 else F.col(column) % 100 <= self.last
        first, last = self.years[0], self.years[-1]
        test = F.col(column).between(first * 100 + 1, last * 100 + self.last)
        if last > first and self.last < 12:
            test = test & (F.col(column) % 100 <= self.last)
        if last - first >= len(self.years):
            test = test & F.expr(f"{column} div 100").isin(*self.years)
        return test

    def year_months(self) -> Column:
        """The same for separate ``year`` and ``month`` columns."""
        return self.in_years("year") & F.col("month").between(1, self.last)

    def in_years(self, column: str) -> Column:
        return F.col(column).isNotNull() if self.years is None else F.col(column).isin(*self.years)

    def to_report_months(self, monthly: DataFrame) -> DataFrame:
        """Copy each monthly row to every report month that covers it.

        Grouping the result by report month gives year-to-date values for all months in one pass.
        The input is an aggregate per month, so at most twelve copies of few rows are made.
        """
        months = F.array(*[F.lit(m) for m in self.months])
        covering = F.filter(months, lambda m: m >= F.col("month"))
        return monthly.withColumn("month", F.explode(covering))


@dataclass(frozen=True)
class Months(Periods):
    """Exactly these months, without the ones before them: what an increment reads."""

    def dates(self, column: str) -> Column:
        if self.years is None:
            return F.month(column).isin(*self.months)
        test = F.lit(False)
        for year in self.years:
            for month in self.months:
                end = dt.date(year + month // 12, month % 12 + 1, 1)
                test = test | ((F.col(column) >= F.lit(dt.date(year, month, 1))) & (F.col(column) < F.lit(end)))
        return test

    def keys(self, column: str) -> Column:
        if self.years is None:
            return (F.col(column) % 100).isin(*self.months)
        return F.col(column).isin(*[y * 100 + m for y in self.years for m in self.months])

    def year_months(self) -> Column:
        return self.in_years("year") & F.col("month").isin(*self.months)
