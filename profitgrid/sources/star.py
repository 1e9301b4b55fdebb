"""The finance model over star-schema tables (orders, line items, suppliers, customers).

Head office is the first region. Lines of its suppliers are pool postings, all other lines direct
ones; orders are loan contracts; suppliers are sales managers. Money is in whole cents.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profitgrid import rules as R
from profitgrid.functions.columns import ACCOUNTS_PER_CLASS, DIRECT, HEAD, account_class, or_default
from profitgrid.operators.balances import point_sums
from profitgrid.operators.ledger import scope
from profitgrid.operators.sheet import MANAGER, MEASURES, monthly_sheet, sheet_to_long
from profitgrid.periods import Periods
from profitgrid.plans.frames import Frames, Organisation
from profitgrid.rules import MetricRule, RuleBook
from profitgrid.session import stored_together

FILLER = "0000"  # characters 5 to 8 of an analysis code; the letter is character 9


def _account(number: int, suffix: int) -> int:
    return number * ACCOUNTS_PER_CLASS + suffix


# Classes are 80 + line number (81..87), suffixes part key modulo 5.
STAR_RULES = RuleBook(
    (
        MetricRule("interest_in_term", R.BALANCE_1, (_account(81, 0), _account(81, 1))),
        MetricRule("interest_overdue", R.BALANCE_2, (_account(81, 2), _account(81, 3))),
        MetricRule("fee_insurance", R.ACTIVATIONS, (_account(81, 4),)),
        MetricRule("fee_limit_increase", R.BALANCE_1, (_account(82, 0),)),
        MetricRule("fee_late_payment", R.BALANCE_2_TO_5, tuple(_account(82, s) for s in (1, 2, 3, 4))),
        MetricRule("rev_business", R.BALANCE_ALL, tuple(_account(83, s) for s in (0, 1, 2))),
        MetricRule("cost_commission", R.BALANCE_ALL, (_account(84, 0),)),
        MetricRule("cost_other_business", R.BALANCE_ALL, tuple(_account(84, s) for s in (1, 2, 3))),
        MetricRule("cost_staff", R.HEADCOUNT, account_classes=(85,)),
        MetricRule("cost_admin", R.HEADCOUNT, account_classes=(86,)),
        MetricRule("cost_asset", R.HEADCOUNT, account_classes=(87,)),
        MetricRule("cost_provision", R.HEADCOUNT, (_account(84, 3), _account(84, 4))),
        MetricRule("cost_fund_cctg", R.CARD_INCOME, (_account(83, 3),)),
        MetricRule("cost_fund_tt2", R.CARD_INCOME, (_account(83, 4),)),
    )
)
STAR = Organisation(STAR_RULES, "AFRICA", ("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))

# The finance company's own accounts, and two of each class that its rules take whole.
FINANCE = Organisation(R.FINANCE_COMPANY, STAR.head_office, STAR.area_names)
FINANCE_CHART = tuple(dict.fromkeys(a for r in R.FINANCE_COMPANY.rules for a in r.accounts)) + tuple(
    _account(number, suffix) for number in R.FINANCE_COMPANY.account_classes for suffix in (1, 2)
)
FIRST_COST_CLASS = 79  # of that chart


class StarModel:
    """Model frames over the tables in ``folder``. Tables are read once the frames are used.

    With a ``chart`` the lines are booked on its accounts, part by part, instead of the model's own.
    """

    def __init__(
        self, spark: SparkSession, folder: str, organisation: Organisation = STAR, chart: tuple[int, ...] = ()
    ) -> None:
        self.spark = spark
        self.folder = folder
        self.organisation = organisation
        self.chart = chart
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A table; its footer is read once per model."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def years(self) -> tuple[int, ...]:
        """All years from the first to the last shipment or order, for callers who need them beforehand: reads
        the two date columns. No report does; ``Periods.every_year`` needs no years."""
        return tuple(self._all_years.first()[0] or (1970,))

    @property
    def _all_years(self) -> DataFrame:
        """One row: the years from the first to the last shipment or order."""
        dates = self.table("lineitem").select(F.year("l_shipdate").alias("y"))
        dates = dates.union(self.table("orders").select(F.year("o_orderdate").alias("y")))
        return dates.agg(F.min("y").alias("first"), F.max("y").alias("last")).select(F.sequence("first", "last"))

    @cached_property
    def _nations(self) -> DataFrame:
        """25 nations with the letter and name of their region."""
        region = self.table("region").withColumn("letter", F.expr("substring('ABCDE', r_regionkey + 1, 1)"))
        nation = self.table("nation")
        joined = nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"])
        return F.broadcast(joined.select("n_nationkey", "n_name", "letter", "r_name"))

    @cached_property
    def _suppliers(self) -> DataFrame:
        key = F.col("s_suppkey").cast("string")
        code = F.when(F.col("letter") == "A", F.concat(F.lit(HEAD + FILLER), key)).otherwise(
            F.concat(F.lit(DIRECT + FILLER), "letter", key)
        )
        return (
            self.table("supplier")
            .join(self._nations, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                "s_suppkey",
                code.alias("analysis_code"),
                F.col("r_name").alias("area_name"),
                F.col("s_name").alias("sale_name"),
                F.concat(F.lower("s_name"), F.lit("@example.com")).alias("email"),
            )
        )

    @cached_property
    def postings(self) -> DataFrame:
        """The ledger's lines before the analysis code of their supplier is looked up."""
        return self._postings()

    def _postings(self, *more: str) -> DataFrame:
        """The same with more columns of the line."""
        number = F.col("l_linenumber") + 80
        suffix = F.col("l_partkey") % 5
        account = number.cast("long") * ACCOUNTS_PER_CLASS + suffix
        cost = (number >= 84) | ((number == 83) & (suffix >= 3))
        if self.chart:
            place = (F.col("l_partkey") % len(self.chart)).cast("int")
            account = F.get(F.array(*[F.lit(a) for a in self.chart]), place)
            number = account_class()
            cost = number >= FIRST_COST_CLASS
        cents = F.rint(F.col("l_extendedprice") * 100).cast("long")
        lines = self.table("lineitem").withColumn("account_code", account)
        return lines.select(
            "l_suppkey",
            F.to_date("l_shipdate").alias("transaction_date"),
            "account_code",
            F.concat(F.lit("class "), number.cast("string")).alias("account_description"),
            F.when(cost, -cents).otherwise(cents).alias("amount"),
            F.when(cost, F.lit("D")).otherwise(F.lit("C")).alias("d_c"),
            F.lit(None).cast("int").alias("funding_id"),
            *more,
        )

    @cached_property
    def ledger(self) -> DataFrame:
        lines, suppliers = self.postings, self._suppliers
        return lines.join(suppliers, lines["l_suppkey"] == suppliers["s_suppkey"]).select(
            "transaction_date",
            "account_code",
            "account_description",
            "analysis_code",
            "amount",
            "d_c",
            or_default("funding_id").alias("funding_id"),
        )

    @cached_property
    def _points_of_sale(self) -> DataFrame:
        """A customer's point of sale is its nation and market segment."""
        return (
            self.table("customer")
            .join(self._nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                "c_custkey",
                F.concat_ws("-", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("pos_cde"),
                F.col("n_name").alias("pos_city"),
                F.col("letter").alias("area_cde"),
            )
        )

    @cached_property
    def balances(self) -> DataFrame:
        return self.balances_of(None)

    def balances_of(self, periods: Periods | None) -> DataFrame:
        """Balances of all months, or of those that the periods cover; their dates reach the file scan."""
        rows = self.table("orders")
        if periods is not None:
            rows = rows.where(periods.dates("o_orderdate"))
        month = F.year("o_orderdate") * 100 + F.month("o_orderdate")
        principal = F.rint(F.col("o_totalprice") * 100).cast("long")
        closed, turn = F.col("o_orderstatus") == "F", F.col("o_orderkey") % 3
        bucket = F.substring("o_orderpriority", 1, 1).cast("int")
        orders = rows.select(
            "o_custkey",
            month.cast("long").alias("kpi_month"),
            F.col("o_orderkey").alias("application_id"),
            principal.alias("outstanding_principal"),
            F.when(closed & (turn == 0), month).when(closed & (turn == 1), month - 1).cast("long").alias("write_off_month"),
            F.when((F.col("o_orderstatus") == "O"), 1).when(closed, 0).alias("psdn"),
            F.when(~((bucket == 1) & (F.col("o_orderstatus") == "P")), bucket).alias("max_bucket"),
        )
        points = self._points_of_sale.drop("area_cde")
        written_off = F.when(F.col("write_off_month").isNotNull(), F.expr("outstanding_principal div 10"))
        return orders.join(points, orders["o_custkey"] == points["c_custkey"]).select(
            "kpi_month",
            "pos_cde",
            "pos_city",
            "application_id",
            "outstanding_principal",
            "write_off_month",
            written_off.alias("write_off_balance_principal"),
            "psdn",
            "max_bucket",
            F.lit(-1).alias("funding_id"),
        )

    @cached_property
    def city_letters(self) -> DataFrame:
        return self._nations.select(F.col("n_name").alias("pos_city"), F.col("letter").alias("area_cde"))

    @cached_property
    def city(self) -> DataFrame:
        """Points of sale of all customers."""
        return self._points_of_sale.select("pos_cde", "pos_city", "area_cde").distinct()

    @cached_property
    def area(self) -> DataFrame:
        region = self.table("region")
        return region.select(
            F.expr("substring('ABCDE', r_regionkey + 1, 1)").alias("area_cde"), F.col("r_name").alias("area_name")
        )

    @cached_property
    def roster(self) -> DataFrame:
        return self._suppliers.select("area_name", "sale_name", "email")

    def _monthly_kpis(self, periods: Periods | None = None) -> DataFrame:
        approved = F.count(F.when(F.col("l_returnflag") != "R", 1))
        lines = self.table("lineitem")
        if periods is not None:
            lines = lines.where(periods.dates("l_shipdate"))
        return (
            lines.groupBy("l_suppkey", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))
            .agg(
                F.nullif(F.count(F.when(F.col("l_linenumber") == 1, 1)), F.lit(0)).alias("ltn"),
                F.sum(F.col("l_quantity").cast("long")).alias("psdn"),
                approved.alias("approve"),
                F.count(F.lit(1)).alias("app_in"),
                (approved / F.count(F.lit(1))).alias("approval_rate"),
            )
        )

    @cached_property
    def sales(self) -> DataFrame:
        """KPIs of the months in which a manager had any line."""
        return self.sales_of(None)

    def sales_of(self, periods: Periods | None) -> DataFrame:
        """The same for the months that the periods cover; their dates reach the file scan."""
        monthly, suppliers = self._monthly_kpis(periods), self._suppliers
        return monthly.join(suppliers, monthly["l_suppkey"] == suppliers["s_suppkey"]).select(
            F.col("s_suppkey").alias(MANAGER), "area_name", "sale_name", "email", "year", "month", *MEASURES
        )

    def sheet(self, years: tuple[int, ...] | None = None, months: int = 12) -> DataFrame:
        """The wide sheet of the years, or of all: every manager, NULL where a month has no line."""
        listed = self._all_years.scalar() if years is None else F.array(*[F.lit(y) for y in years])
        each_year = F.explode(listed)
        managers = self._suppliers.withColumn("year", each_year).withColumnRenamed("s_suppkey", "l_suppkey")
        cells = monthly_sheet(self._monthly_kpis(), ["l_suppkey", "year"], months)
        wide = managers.join(cells, ["l_suppkey", "year"], "left").drop("analysis_code")
        return wide.withColumnRenamed("l_suppkey", MANAGER)

    def sales_of_all_months(self, years: tuple[int, ...] | None = None, months: int = 12) -> DataFrame:
        return sheet_to_long(self.sheet(years, months))

    def frames(self, periods: Periods | None = None) -> Frames:
        """Frames for reports of any periods, or of the given ones: then ``orders`` is read for them only.

        The headcount looks at January alone, so its scan of the lines is bounded by dates, too.
        """
        return Frames(
            self.ledger,
            self.balances_of(periods),
            self.city,
            self.area,
            self.sales if periods is None else self.sales_of(periods),
            self.roster,
            self.organisation,
            january=lambda wanted: self.sales_of(Periods(wanted.years, (1,))),
        )

    def frames_once(self, periods: Periods, sheet_months: tuple[int, ...] = (1,)) -> Frames:
        """Frames whose ledger sums and sheet rows come from one pass over the lines, and balance sums from one
        pass over the orders, both stored at the same time.

        The sheet has the given months only; the headcount needs no other than January.
        """
        frames = self.frames(periods)
        sums, points = stored_together(self._at_two_grains(periods, sheet_months), point_sums(frames.balances))
        monthly = sums.where(F.col("rule_key").isNotNull()).select("year", "month", "rule_key", "scope", "amount")
        cells = sums.where(F.col("l_suppkey").isNotNull())
        rates = cells.withColumns({"ltn": F.nullif("ltn", F.lit(0)), "approval_rate": F.col("approve") / F.col("app_in")})
        managers = self._suppliers
        sales = rates.join(managers, rates["l_suppkey"] == managers["s_suppkey"]).select(
            F.col("s_suppkey").alias(MANAGER), "area_name", "sale_name", "email", "year", "month", *MEASURES
        )
        return replace(frames, sales=sales, january=None, monthly=monthly, sums=points)

    def _at_two_grains(self, periods: Periods, sheet_months: tuple[int, ...]) -> DataFrame:
        """Sums of the lines per month, rule key and scope (``l_suppkey`` is NULL), and per month and manager
        (the other two are NULL): each line is counted at both grains in the same pass.

        Partial sums of the first grain are as few as the rule book and the months; those of the second one
        row per manager and month of the sheet.
        """
        rules = self.organisation.rules
        lines = self._postings("l_linenumber", "l_quantity", "l_returnflag").where(periods.dates("transaction_date"))
        lines = lines.join(self._suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        lines = lines.withColumns({"month": F.month("transaction_date"), "scope": scope()})
        keys, once = rules.keys(), F.lit(True)
        if rules.two_keys:  # the line is at the second grain once, however many rule keys it has
            lines = lines.select("*", F.posexplode(keys).alias("nth", "key"))
            keys, once = F.array("key"), F.col("nth") == 0
        posted = rules.has_account() & F.col("scope").isNotNull()
        counted = lines.select(
            F.year("transaction_date").alias("year"),
            "month",
            F.when(posted, keys[0]).alias("rule_key"),
            F.when(posted, F.col("scope")).alias("scope"),
            F.when(F.col("month").isin(*sheet_months) & once, F.col("l_suppkey")).alias("l_suppkey"),
            "amount",
            (F.col("l_linenumber") == 1).alias("first"),
            (F.col("l_returnflag") != "R").alias("kept"),
            F.col("l_quantity").cast("long").alias("quantity"),
        )
        names = ["year", "month", "rule_key", "scope", "l_suppkey"]
        grains = [names[:4], ["year", "month", "l_suppkey"]]
        sums = counted.groupingSets([[F.col(c) for c in grain] for grain in grains], *names).agg(
            F.sum("amount").alias("amount"),
            F.count(F.when(F.col("first"), 1)).alias("ltn"),
            F.sum("quantity").alias("psdn"),
            F.count(F.when(F.col("kept"), 1)).alias("approve"),
            F.count(F.lit(1)).alias("app_in"),
        )
        # Without a key: lines that a grain leaves out.
        return sums.where(F.col("rule_key").isNotNull() | F.col("l_suppkey").isNotNull())
