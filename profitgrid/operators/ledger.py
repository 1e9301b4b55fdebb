"""Ledger sums: head-office pools and amounts booked directly to a region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitgrid.functions.columns import AREA_LETTERS, HEAD, account_class, area_letter, is_direct, is_head
from profitgrid.periods import Periods
from profitgrid.rules import RuleBook


def postings_in_scope(
    ledger: DataFrame,
    periods: Periods,
    rules: RuleBook,
    letters: tuple[str, ...] | None = AREA_LETTERS,
) -> DataFrame:
    """Postings of the period on accounts of the rules, with ``scope`` = HEAD or the region letter.

    All tests are on stored columns, so the file scan gets date ranges, account ranges and prefixes.
    A ledger stored by ``year`` and ``month`` is also pruned by these. ``letters=None`` keeps direct
    postings of any letter.
    """
    if {"year", "month"} <= set(ledger.columns):
        ledger = ledger.where(periods.year_months())
    direct = _direct(letters)
    return ledger.where(
        periods.dates("transaction_date")
        & rules.has_account()
        & (is_head() | is_direct())
        & (is_head() | direct)
    ).select(
        F.year("transaction_date").alias("year"),
        F.month("transaction_date").alias("month"),
        "account_code",
        F.when(is_head(), F.lit(HEAD)).otherwise(area_letter()).alias("scope"),
        "amount",
    )


def _direct(letters: tuple[str, ...] | None) -> Column:
    return is_direct() if letters is None else is_direct() & area_letter().isin(*letters)


def scope(letters: tuple[str, ...] | None = AREA_LETTERS) -> Column:
    """HEAD, the region letter, or NULL for a posting that no report takes."""
    return F.when(is_head(), F.lit(HEAD)).when(_direct(letters), area_letter())


def monthly_by_rule_key(
    ledger: DataFrame,
    periods: Periods,
    rules: RuleBook,
    letters: tuple[str, ...] | None = AREA_LETTERS,
) -> DataFrame:
    """The one pass over the ledger: sums per month, rule key and scope.

    Summing before the rules are joined leaves at most twelve months x rule keys x nine scopes per
    year, whatever the number of postings and accounts. A scope that holds most postings (head
    office) still is one row per map task and key.
    """
    return (
        rules.keyed(postings_in_scope(ledger, periods, rules, letters))
        .groupBy("year", "month", "rule_key", "scope")
        .agg(F.sum("amount").alias("amount"))
    )


def year_to_date(monthly: DataFrame, periods: Periods, rules: RuleBook) -> DataFrame:
    """Year-to-date sums per metric, report month and scope.

    ``monthly`` is as small as the rule book. It is spread by year, which also suits every later
    grouping and window of a report (they all include the year), so none of them shuffles again.
    """
    return (
        periods.to_report_months(rules.apply(monthly).repartition("year"))
        .groupBy("year", "month", "metric", "weight", "scope")
        .agg(F.sum("amount").alias("amount"))
    )


def head_pool(ledger: DataFrame, periods: Periods, rules: RuleBook) -> DataFrame:
    """Head-office total per metric and report month."""
    sums = year_to_date(monthly_by_rule_key(ledger, periods, rules), periods, rules)
    return sums.where(F.col("scope") == HEAD).select(
        "metric", "year", "month", F.col("amount").alias("total_head")
    )


def direct_by_area(ledger: DataFrame, periods: Periods, rules: RuleBook) -> DataFrame:
    """Directly booked total per metric, report month and region letter."""
    sums = year_to_date(monthly_by_rule_key(ledger, periods, rules), periods, rules)
    return sums.where(F.col("scope") != HEAD).select(
        "metric", "year", "month", F.col("scope").alias("area_cde"), F.col("amount").alias("total_direct")
    )


def account_set_totals(ledger: DataFrame, rules: RuleBook) -> DataFrame:
    """Postings and amount per metric and account, over the whole ledger."""
    per_account = (
        ledger.where(rules.has_account())
        .groupBy("account_code")
        .agg(F.count(F.lit(1)).alias("postings"), F.sum("amount").alias("amount"))
    )
    keyed = rules.keyed(per_account.withColumn("account", F.col("account_code")))
    return rules.apply(keyed).select("metric", F.col("account").alias("account_code"), "postings", "amount")


def account_class_totals(ledger: DataFrame) -> DataFrame:
    """Postings and amount per account class (first two digits), over the whole ledger."""
    return ledger.groupBy(account_class().alias("account_class")).agg(
        F.count(F.lit(1)).alias("postings"), F.sum("amount").alias("amount")
    )


def ledger_year_to_date(ledger: DataFrame, periods: Periods) -> DataFrame:
    """Year-to-date totals of pool and direct postings over all accounts."""
    monthly = (
        ledger.where(periods.dates("transaction_date") & (is_head() | is_direct()))
        .groupBy(
            F.year("transaction_date").alias("year"),
            F.month("transaction_date").alias("month"),
            F.when(is_head(), F.lit(HEAD)).otherwise(area_letter()).alias("scope"),
        )
        .agg(F.count(F.lit(1)).alias("postings"), F.sum("amount").alias("amount"))
    )
    return (
        periods.to_report_months(monthly)
        .groupBy("year", "month", "scope")
        .agg(F.sum("postings").alias("postings"), F.sum("amount").alias("amount"))
    )
