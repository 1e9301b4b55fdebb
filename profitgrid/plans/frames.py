"""Input frames of a report and the organisation they belong to."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from profitgrid.operators.balances import point_sums
from profitgrid.operators.dims import AREAS, HEAD_OFFICE
from profitgrid.operators.ledger import monthly_by_rule_key
from profitgrid.periods import Periods
from profitgrid.rules import FINANCE_COMPANY, RuleBook
from profitgrid.session import stored_once


@dataclass(frozen=True)
class Organisation:
    rules: RuleBook = FINANCE_COMPANY
    head_office: str = HEAD_OFFICE
    area_names: tuple[str, ...] = field(default=tuple(n for n in AREAS if n != HEAD_OFFICE))


@dataclass(frozen=True)
class Frames:
    """``city`` has one row per point of sale, ``area`` one per region letter."""

    ledger: DataFrame
    balances: DataFrame
    city: DataFrame
    area: DataFrame
    sales: DataFrame
    roster: DataFrame
    organisation: Organisation = Organisation()
    sums: DataFrame | None = None
    january: Callable[[Periods], DataFrame] | None = None  # the Januaries of ``sales``, if the source can read them alone
    monthly: DataFrame | None = None  # stored sums of the ledger per month, rule key and scope

    def january_sales(self, periods: Periods) -> DataFrame:
        return self.sales if self.january is None else self.january(periods)

    @property
    def balance_sums(self) -> DataFrame:
        """Balances per month and point of sale: stored ones, or computed from all rows."""
        return point_sums(self.balances) if self.sums is None else self.sums

    def monthly_sums(self, periods: Periods, rules: RuleBook) -> DataFrame:
        """Ledger sums per month, rule key and scope: stored ones, or computed from all postings."""
        if self.monthly is None:
            return monthly_by_rule_key(self.ledger, periods, rules)
        return self.monthly.where(periods.year_months())

    def stored(self, periods: Periods) -> Frames:
        """Frames of the periods for a report that reads balances and the sheet more than once.

        Sums per point of sale and the sheet's rows are stored, so each source is read once. Where the
        ledger's sums are stored, the sheet's rows came from the same pass and are stored, too.
        """
        sums = self.sums
        if sums is None:
            sums = stored_once(point_sums(self.balances.where(periods.keys("kpi_month"))))
        if self.monthly is not None:
            return replace(self, sums=sums)
        return replace(self, sums=sums, sales=stored_once(self.sales.where(periods.year_months())), january=None)
