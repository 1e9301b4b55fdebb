"""Metrics as data: which accounts feed a metric and which weight splits its head-office pool."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profitgrid.functions.columns import ACCOUNTS_PER_CLASS, account_class, in_account_class

# Weights.
BALANCE_1 = "balance_bucket_1"
BALANCE_2 = "balance_bucket_2"
BALANCE_2_TO_5 = "balance_bucket_2_to_5"
BALANCE_ALL = "balance_all"
ACTIVATIONS = "activations"
HEADCOUNT = "headcount"
CARD_INCOME = "card_income"

BALANCE_WEIGHTS = (BALANCE_1, BALANCE_2, BALANCE_2_TO_5, BALANCE_ALL, ACTIVATIONS)

LEVEL_1 = (
    "interest_in_term",
    "interest_overdue",
    "fee_insurance",
    "fee_limit_increase",
    "fee_late_payment",
    "rev_business",
    "cost_commission",
    "cost_other_business",
    "cost_staff",
    "cost_admin",
    "cost_asset",
    "cost_provision",
)
CARD_INCOMES = LEVEL_1[:5]
LEVEL_2 = ("cost_fund_cctg", "cost_fund_tt2")


@dataclass(frozen=True)
class MetricRule:
    metric: str
    weight: str
    accounts: tuple[int, ...] = ()
    account_classes: tuple[int, ...] = ()

    def __post_init__(self) -> None:
        twice = [a for a in self.accounts if a // ACCOUNTS_PER_CLASS in self.account_classes]
        if twice:
            raise ValueError(f"{self.metric}: {twice} are listed and also part of a class")


@dataclass(frozen=True)
class RuleBook:
    """All metric rules of an organisation. One account may feed several metrics."""

    rules: tuple[MetricRule, ...]

    def only(self, metrics: Iterable[str]) -> RuleBook:
        wanted = set(metrics)
        return RuleBook(tuple(r for r in self.rules if r.metric in wanted))

    def weight_of(self, metric: str) -> str:
        return next(r.weight for r in self.rules if r.metric == metric)

    @property
    def weights(self) -> set[str]:
        return {r.weight for r in self.rules}

    @property
    def accounts(self) -> list[int]:
        return sorted({a for r in self.rules for a in r.accounts})

    @property
    def account_classes(self) -> list[int]:
        return sorted({c for r in self.rules for c in r.account_classes})

    def has_account(self, column: str = "account_code") -> Column:
        """A test of the account that reaches the file scan: a list and ranges of codes."""
        test = F.col(column).isin(*self.accounts) if self.accounts else F.lit(False)
        for number in self.account_classes:
            test = test | in_account_class(column, number)
        return test

    def keyed(self, postings: DataFrame) -> DataFrame:
        """Replace ``account_code`` by ``rule_key``: a listed account's code, else its class.

        Sums per rule key are as few as the rule book is long, however many accounts a class has.
        Only a book that lists accounts of one of its own classes needs two keys for a posting.
        """
        key = F.explode(self.keys()) if self.two_keys else self.keys()[0]
        return postings.withColumn("rule_key", key).drop("account_code")

    @property
    def two_keys(self) -> bool:
        return any(a // ACCOUNTS_PER_CLASS in self.account_classes for a in self.accounts)

    def keys(self) -> Column:
        """The rule keys of an account, one or two."""
        number = account_class("account_code")
        key = F.when(F.col("account_code").isin(*self.accounts), F.col("account_code")).otherwise(number)
        return F.array_distinct(F.array(key, number)) if self.two_keys else F.array(key)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per metric and account or class: (rule_key, metric, weight).

        A class has two digits and an account twelve, so one key column serves both.
        """
        rows = [
            {"rule_key": key, "metric": r.metric, "weight": r.weight}
            for r in self.rules
            for key in (*r.accounts, *r.account_classes)
        ]
        schema = pa.schema([("rule_key", pa.int64()), ("metric", pa.string()), ("weight", pa.string())])
        return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))

    def apply(self, keyed: DataFrame) -> DataFrame:
        """Join sums per ``rule_key`` with the metrics that use the key."""
        rules = F.broadcast(self.frame(keyed.sparkSession))  # as long as the rule book
        return keyed.join(rules, "rule_key")


# Accounts of each metric in the chart of accounts.
FINANCE_COMPANY = RuleBook(
    (
        MetricRule("interest_in_term", BALANCE_1, (702000030002, 702000030001, 702000030102)),
        MetricRule("interest_overdue", BALANCE_2, (702000030012, 702000030112)),
        MetricRule("fee_insurance", ACTIVATIONS, (716000000001,)),
        MetricRule("fee_limit_increase", BALANCE_1, (719000030002,)),
        MetricRule(
            "fee_late_payment",
            BALANCE_2_TO_5,
            (719000030003, 719000030103, 790000030003, 790000030103, 790000030004, 790000030104),
        ),
        MetricRule(
            "rev_business",
            BALANCE_ALL,
            (
                702000010001, 702000010002, 704000000001, 705000000001, 709000000001,
                714000000002, 714000000003, 714037000001, 714000000004, 714014000001,
                715000000001, 715037000001, 719000000001, 709000000101, 719000000101,
            ),
        ),
        MetricRule("cost_commission", BALANCE_ALL, (816000000001, 816000000002, 816000000003)),
        MetricRule(
            "cost_other_business",
            BALANCE_ALL,
            (
                809000000002, 809000000001, 811000000001, 811000000102, 811000000002, 811014000001, 811037000001,
                811039000001, 811041000001, 815000000001, 819000000002, 819000000003, 819000000001, 790000000003,
                790000050101, 790000000101, 790037000001, 849000000001, 899000000003, 899000000002, 811000000101,
                819000060001,
            ),
        ),
        MetricRule("cost_staff", HEADCOUNT, account_classes=(85,)),
        MetricRule("cost_admin", HEADCOUNT, account_classes=(86,)),
        MetricRule("cost_asset", HEADCOUNT, account_classes=(87,)),
        MetricRule(
            "cost_provision",
            HEADCOUNT,
            (
                790000050001, 882200050001, 790000030001, 882200030001, 790000000001, 790000020101,
                882200000001, 882200050101, 882200020101, 882200060001, 790000050101, 882200030101,
            ),
        ),
        MetricRule("cost_fund_cctg", CARD_INCOME, (803000000001,)),
        MetricRule("cost_fund_tt2", CARD_INCOME, (801000000001, 802000000001)),
    )
)
