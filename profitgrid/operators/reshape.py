"""Wide to long and back: a row per criterion, a column per region and a total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitgrid.functions.columns import as_text, position_in

# Criteria of the multi-month report in display order, label and measure.
CRITERIA = (
    ("1.Lợi nhuận trước thuế", "profit_before_tax"),
    ("Thu nhập từ hoạt động thẻ", "card_income"),
    ("Lãi trong hạn", "interest_in_term"),
    ("Lãi quá hạn", "interest_overdue"),
    ("Phí Bảo hiểm", "fee_insurance"),
    ("Phí tăng hạn mức", "fee_limit_increase"),
    ("Phí thanh toán chậm, thu từ ngoại bảng, khác…", "fee_late_payment"),
    ("Chi phí thuần KDV", "net_fund_cost"),
    ("CP vốn TT 2", "cost_fund_tt2"),
    ("CP vốn CCTG", "cost_fund_cctg"),
    ("Chi phí thuần hoạt động khác", "net_other"),
    ("DT Kinh doanh", "rev_business"),
    ("CP hoa hồng", "cost_commission"),
    ("CP thuần KD khác", "cost_other_business"),
    ("Tổng thu nhập hoạt động", "total_income"),
    ("Tổng chi phí hoạt động", "total_cost"),
    ("CP nhân viên", "cost_staff"),
    ("CP quản lý", "cost_admin"),
    ("CP tài sản", "cost_asset"),
    ("Chi phí dự phòng", "cost_provision"),
    ("2.Số lượng nhân sự ( Sale Manager )", "headcount"),
    ("CIR (%)", "cir"),
    ("Margin (%)", "margin"),
    ("Hiệu suất trên/vốn (%)", "return_on_capital"),
    ("Hiệu suất BQ/ Nhân sự", "profit_per_head"),
)

# Criteria of the single-month report; those without a measure are filled with 0.
CRITERIA_ONE_MONTH = (
    *CRITERIA[:8],
    ("DT Nguồn vốn", None),
    ("CP vốn TT 2", "cost_fund_tt2"),
    ("CP vốn TT 1", None),
    ("CP vốn CCTG", "cost_fund_cctg"),
    ("Chi phí thuần hoạt động khác", "net_other"),
    ("DT Fintech", None),
    ("DT tiểu thương, cá nhân", None),
    ("DT Kinh doanh", "rev_business"),
    ("CP hoa hồng", "cost_commission"),
    ("CP thuần KD khác", "cost_other_business"),
    ("CP hợp tác kd tàu (net)", None),
    ("Tổng thu nhập hoạt động", "total_income"),
    ("Tổng chi phí hoạt động", "total_cost"),
    ("CP thuế, phí", None),
    ("CP nhân viên", "cost_staff"),
    ("CP quản lý", "cost_admin"),
    ("CP tài sản", "cost_asset"),
    ("Chi phí dự phòng", "cost_provision"),
    ("2.Số lượng nhân sự ( Sale Manager )", "headcount"),
    ("3.Chỉ số tài chính", None),
    *CRITERIA[21:],
)
# Display names of the wide report's columns that differ from the criteria above.
DISPLAY_NAMES = {
    "area_name": "tenkhuvuc",
    "criterion": "Tiêu chí",
    "headcount": "2. Số lượng nhân sự ( Sale Manager )",
}
NOT_TOTALLED = "Chỉ số tài chính"
FRACTIONS = ("profit_before_tax", "net_fund_cost", "cost_fund_tt2", "cost_fund_cctg", "total_income")
RATIOS = ("cir", "margin", "return_on_capital", "profit_per_head")

CELL = "decimal(38,2)"  # whole amounts stay exact at any size, ratios have two digits

Criteria = tuple[tuple[str, str | None], ...]


def melt(wide: DataFrame, criteria: Criteria = CRITERIA) -> DataFrame:
    """A row per region and criterion, in one pass over the wide rows."""
    cells = [
        F.struct(
            F.lit(label).alias("criterion"),
            (F.lit(0) if measure is None else F.col(measure)).cast(CELL).alias("value"),
        )
        for label, measure in criteria
    ]
    return wide.select("year", "month", "area_name", F.explode(F.array(*cells)).alias("c")).select(
        "year", "month", "area_name", "c.criterion", "c.value"
    )


def pivot(
    melted: DataFrame,
    area_names: tuple[str, ...],
    criteria: Criteria = CRITERIA,
    total_ratios: bool = True,
    text: bool = False,
) -> DataFrame:
    """A row per month and criterion, a column per region and ``Total``, in display order.

    Region columns are given, so Spark need not look for them first. The total adds up every
    criterion but the heading row, ratios included; ``total_ratios=False`` leaves theirs empty.
    ``text=True`` formats the cells, with decimals where a criterion has them.
    """
    order = tuple(label for label, _ in criteria)
    ratio_labels = [label for label, measure in criteria if measure in RATIOS]
    zero = F.lit(0).cast(CELL)
    summed = F.when(F.col("criterion").contains(NOT_TOTALLED), zero).otherwise(F.col("value"))
    total = F.coalesce(F.sum(summed).cast(CELL), zero)
    if not total_ratios:
        total = F.when(~F.col("criterion").isin(*ratio_labels), total)

    def cell(name: str) -> Column:
        return F.max(F.when(F.col("area_name") == name, F.col("value")))

    table = melted.groupBy("year", "month", "criterion").agg(
        *[cell(name).alias(name) for name in area_names], total.alias("Total")
    )
    if text:
        decimals = F.col("criterion").isin(*[label for label, m in criteria if m in (*FRACTIONS, *RATIOS)])
        cells = [as_text(F.col(f"`{c}`"), decimals).alias(c) for c in (*area_names, "Total")]
        table = table.select("year", "month", "criterion", *cells)
    return table.withColumn("sort_pos", position_in(F.col("criterion"), order)).orderBy(
        "year", "month", F.col("sort_pos").asc_nulls_last()
    )


def unpivot(table: DataFrame, area_names: tuple[str, ...]) -> DataFrame:
    """Back from region columns to rows."""
    return table.unpivot(
        ["year", "month", "criterion"], [F.col(f"`{n}`") for n in area_names], "area_name", "value"
    )
