"""Dimensions built from facts: points of sale, regions, metrics."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profitgrid.functions.columns import HEAD_OFFICE_LETTER
from profitgrid.session import stored_once

HEAD_OFFICE = "Hội Sở"

# Letter and name of each region, head office first.
AREAS = {
    "Hội Sở": "A",
    "Đông Bắc Bộ": "B",
    "Tây Bắc Bộ": "C",
    "Đồng Bằng Sông Hồng": "D",
    "Bắc Trung Bộ": "E",
    "Nam Trung Bộ": "F",
    "Tây Nam Bộ": "G",
    "Đông Nam Bộ": "H",
}

# Provinces and cities of each region.
CITIES = {
    "B": ("Hà Giang", "Tuyên Quang", "Phú Thọ", "Thái Nguyên", "Bắc Kạn", "Cao Bằng", "Lạng Sơn", "Bắc Giang", "Quảng Ninh"),
    "C": ("Lào Cai", "Yên Bái", "Điện Biên", "Sơn La", "Hòa Bình", "Lai Châu"),
    "D": ("Hà Nội", "Hải Phòng", "Vĩnh Phúc", "Bắc Ninh", "Hưng Yên", "Hải Dương", "Thái Bình", "Nam Định", "Ninh Bình", "Hà Nam"),
    "E": ("Thanh Hóa", "Nghệ An", "Hà Tĩnh", "Quảng Bình", "Quảng Trị", "Huế"),
    "F": (
        "Đà Nẵng", "Quảng Nam", "Quảng Ngãi", "Bình Định", "Phú Yên", "Khánh Hòa", "Ninh Thuận",
        "Bình Thuận", "Kon Tum", "Gia Lai", "Đắk Lắk", "Đắk Nông", "Lâm Đồng",
    ),
    "G": (
        "Cần Thơ", "Long An", "Đồng Tháp", "Tiền Giang", "An Giang", "Bến Tre", "Vĩnh Long",
        "Trà Vinh", "Hậu Giang", "Kiên Giang", "Sóc Trăng", "Bạc Liêu", "Cà Mau",
    ),
    "H": ("Hồ Chí Minh", "Bà Rịa - Vũng Tàu", "Bình Dương", "Bình Phước", "Đồng Nai", "Tây Ninh"),
}


def city_letters(spark: SparkSession) -> DataFrame:
    """(pos_city, area_cde) of the provinces above."""
    rows = [{"pos_city": city, "area_cde": letter} for letter, cities in CITIES.items() for city in cities]
    return spark.createDataFrame(pa.Table.from_pylist(rows))


def area_letters(spark: SparkSession) -> DataFrame:
    """(area_name, area_cde) of the regions above."""
    rows = [{"area_name": name, "area_cde": letter} for name, letter in AREAS.items()]
    return spark.createDataFrame(pa.Table.from_pylist(rows))


def build_city(balances: DataFrame, letters: DataFrame) -> DataFrame:
    """Points of sale seen in the balances, with the letter of their city's region.

    Cities that ``letters`` does not list count as head office. Of several cities of one point of
    sale the lowest name stays, so a rerun gives the same row.
    """
    points = (
        balances.where(F.col("pos_cde").isNotNull() & F.col("pos_city").isNotNull())
        .groupBy("pos_cde")
        .agg(F.min("pos_city").alias("pos_city"))
    )
    letter = F.coalesce("area_cde", F.lit(HEAD_OFFICE_LETTER)).alias("area_cde")
    return points.join(letters, "pos_city", "left").select("pos_cde", "pos_city", letter)


def build_area(sales: DataFrame, letters: DataFrame, head_office: str = HEAD_OFFICE) -> DataFrame:
    """Regions seen on the sales sheet plus head office, one row per letter.

    Names without a letter would take head office's; head office itself wins, then the lowest name.
    """
    names = sales.where(F.col("area_name").isNotNull()).select("area_name").distinct()
    lettered = names.join(letters, "area_name", "left").select(
        F.coalesce("area_cde", F.lit(HEAD_OFFICE_LETTER)).alias("area_cde"), "area_name"
    )
    constant = sales.sparkSession.range(1).select(
        F.lit(HEAD_OFFICE_LETTER).alias("area_cde"), F.lit(head_office).alias("area_name")
    )
    preferred = F.struct(F.col("area_name") != head_office, F.col("area_name"))
    return (
        lettered.union(constant)
        .distinct()
        .groupBy("area_cde")
        .agg(F.min_by("area_name", preferred).alias("area_name"))
        .orderBy("area_cde")
    )


@dataclass(frozen=True)
class MetricNode:
    code: str
    name: str
    parent: str | None
    level: int


# The metric tree of the report in display order.
METRIC_TREE = (
    MetricNode("profit_before_tax", "1.Lợi nhuận trước thuế", None, 0),
    MetricNode("total_income", "Tổng thu nhập hoạt động", "profit_before_tax", 1),
    MetricNode("card_income", "Thu nhập từ hoạt động thẻ", "total_income", 2),
    MetricNode("interest_in_term", "Lãi trong hạn", "card_income", 3),
    MetricNode("interest_overdue", "Lãi quá hạn", "card_income", 3),
    MetricNode("fee_insurance", "Phí Bảo hiểm", "card_income", 3),
    MetricNode("fee_limit_increase", "Phí tăng hạn mức", "card_income", 3),
    MetricNode("fee_late_payment", "Phí thanh toán chậm, thu từ ngoại bảng, khác…", "card_income", 3),
    MetricNode("net_fund_cost", "Chi phí thuần KDV", "total_income", 2),
    MetricNode("cost_fund_tt2", "CP vốn TT 2", "net_fund_cost", 3),
    MetricNode("cost_fund_cctg", "CP vốn CCTG", "net_fund_cost", 3),
    MetricNode("net_other", "Chi phí thuần hoạt động khác", "total_income", 2),
    MetricNode("rev_business", "DT Kinh doanh", "net_other", 3),
    MetricNode("cost_commission", "CP hoa hồng", "net_other", 3),
    MetricNode("cost_other_business", "CP thuần KD khác", "net_other", 3),
    MetricNode("total_cost", "Tổng chi phí hoạt động", "profit_before_tax", 1),
    MetricNode("cost_staff", "CP nhân viên", "total_cost", 2),
    MetricNode("cost_admin", "CP quản lý", "total_cost", 2),
    MetricNode("cost_asset", "CP tài sản", "total_cost", 2),
    MetricNode("cost_provision", "Chi phí dự phòng", "profit_before_tax", 1),
)


def metric_dimension(spark: SparkSession, tree: tuple[MetricNode, ...] = METRIC_TREE) -> DataFrame:
    """The metric dimension: serial key, code, name, parent, level, sort order, time of loading."""
    ids = {node.code: i + 1 for i, node in enumerate(tree)}
    rows = [
        {
            "funding_id": ids[node.code],
            "funding_code": node.code,
            "funding_name": node.name,
            "funding_parent_id": ids.get(node.parent),
            "funding_level": node.level,
            "sortorder": ids[node.code],
        }
        for node in tree
    ]
    text, number = pa.string(), pa.int32()
    schema = pa.schema(
        [
            ("funding_id", number),
            ("funding_code", text),
            ("funding_name", text),
            ("funding_parent_id", number),
            ("funding_level", number),
            ("sortorder", number),
        ]
    )
    now = F.current_timestamp()
    return (
        spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))
        .withColumn("rec_created_dt", now)
        .withColumn("rec_updated_dt", now)
    )


def metric_ancestors(spark: SparkSession, tree: tuple[MetricNode, ...] = METRIC_TREE) -> DataFrame:
    """(leaf, ancestor) pairs, each leaf also being its own ancestor."""
    parents = {node.code: node.parent for node in tree}
    leaves = set(parents) - set(parents.values())
    rows = []
    for leaf in sorted(leaves):
        node: str | None = leaf
        while node is not None:
            rows.append({"leaf": leaf, "ancestor": node})
            node = parents[node]
    return spark.createDataFrame(pa.Table.from_pylist(rows))


class Circle(ValueError):
    """A node of a hierarchy is its own ancestor."""


def ancestors(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, ancestor, distance): every node with all of its ancestors, itself at distance 0.

    ``nodes`` is a table of any depth with one row per node; a NULL parent makes a root, a parent without a
    row of its own an ancestor like any other. Each round joins the known paths with each other, which
    doubles their length, so rounds follow the logarithm of the depth. A circle raises ``Circle``.
    """
    parents = nodes.select(F.col(node).alias("node"), F.col(parent).alias("ancestor")).where(F.col("node").isNotNull())
    paths = stored_once(parents.where(F.col("ancestor").isNotNull()).distinct().withColumn("distance", F.lit(1)))
    reach = 1
    while True:
        circle = paths.where(F.col("node") == F.col("ancestor")).limit(3).collect()
        if circle:
            raise Circle(f"own ancestors: {sorted(str(r['node']) for r in circle)}")
        longest = paths.where(F.col("distance") == reach)
        if not longest.head(1):
            break
        further = paths.select(F.col("node").alias("_node"), F.col("ancestor").alias("_ancestor"), F.col("distance").alias("_more"))
        joined = longest.join(further, longest["ancestor"] == further["_node"])
        longer = joined.select("node", F.col("_ancestor").alias("ancestor"), (F.col("distance") + F.col("_more")).alias("distance"))
        paths, reach = stored_once(paths.union(longer)), 2 * reach
    themselves = parents.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("distance")).distinct()
    return paths.union(themselves)


def roll_up(leaf_amounts: DataFrame, keys: list[str], dimension: DataFrame | None = None) -> DataFrame:
    """Sum leaf amounts (``keys``, metric, amount) to every node of a metric dimension, by default the fixed one.

    Amounts are added as decimals, since a sum of doubles would depend on the order of the rows.
    """
    spark = leaf_amounts.sparkSession
    if dimension is None:
        pairs = F.broadcast(metric_ancestors(spark))  # as long as the tree
        dimension = F.broadcast(metric_dimension(spark))
    else:
        by_id = ancestors(dimension, "funding_id", "funding_parent_id")
        codes = [dimension.select(F.col("funding_id").alias(c), F.col("funding_code").alias(n))
                 for c, n in (("node", "leaf"), ("ancestor", "ancestor_code"))]
        pairs = by_id.join(codes[0], "node").join(codes[1], "ancestor").select("leaf", F.col("ancestor_code").alias("ancestor"))
    sums = (
        leaf_amounts.join(pairs, leaf_amounts["metric"] == pairs["leaf"])
        .groupBy(*keys, "ancestor")
        .agg(F.sum(F.col("amount").cast("decimal(38,6)")).cast("double").alias("amount"))
    )
    return sums.join(dimension, sums["ancestor"] == dimension["funding_code"]).select(
        *keys, "funding_id", "funding_code", "funding_parent_id", "funding_level", "sortorder", "amount"
    )
