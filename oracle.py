"""SQL for DuckDB that computes the registered queries another way.

Reports are computed period by period: each report month joins the postings and balances of its
months. Nothing is imported from the package: accounts, labels and the metric tree stand here once more.
"""

from __future__ import annotations

# Metric, weight, and the first and last account code of each range.
STAR_RULES = """
  ('interest_in_term', 'balance_bucket_1', 810000000000, 810000000001),
  ('interest_overdue', 'balance_bucket_2', 810000000002, 810000000003),
  ('fee_insurance', 'activations', 810000000004, 810000000004),
  ('fee_limit_increase', 'balance_bucket_1', 820000000000, 820000000000),
  ('fee_late_payment', 'balance_bucket_2_to_5', 820000000001, 820000000004),
  ('rev_business', 'balance_all', 830000000000, 830000000002),
  ('cost_commission', 'balance_all', 840000000000, 840000000000),
  ('cost_other_business', 'balance_all', 840000000001, 840000000003),
  ('cost_staff', 'headcount', 850000000000, 859999999999),
  ('cost_admin', 'headcount', 860000000000, 869999999999),
  ('cost_asset', 'headcount', 870000000000, 879999999999),
  ('cost_provision', 'headcount', 840000000003, 840000000004),
  ('cost_fund_cctg', 'card_income', 830000000003, 830000000003),
  ('cost_fund_tt2', 'card_income', 830000000004, 830000000004)"""

# Metric, weight and accounts of the finance company; classes 85 to 87 follow below.
FINANCE_ACCOUNTS = (
    ("interest_in_term", "balance_bucket_1", "702000030002 702000030001 702000030102"),
    ("interest_overdue", "balance_bucket_2", "702000030012 702000030112"),
    ("fee_insurance", "activations", "716000000001"),
    ("fee_limit_increase", "balance_bucket_1", "719000030002"),
    ("fee_late_payment", "balance_bucket_2_to_5",
     "719000030003 719000030103 790000030003 790000030103 790000030004 790000030104"),
    ("rev_business", "balance_all",
     "702000010001 702000010002 704000000001 705000000001 709000000001 714000000002 714000000003 714037000001 "
     "714000000004 714014000001 715000000001 715037000001 719000000001 709000000101 719000000101"),
    ("cost_commission", "balance_all", "816000000001 816000000002 816000000003"),
    ("cost_other_business", "balance_all",
     "809000000002 809000000001 811000000001 811000000102 811000000002 811014000001 811037000001 811039000001 "
     "811041000001 815000000001 819000000002 819000000003 819000000001 790000000003 790000050101 790000000101 "
     "790037000001 849000000001 899000000003 899000000002 811000000101 819000060001"),
    ("cost_provision", "headcount",
     "790000050001 882200050001 790000030001 882200030001 790000000001 790000020101 882200000001 882200050101 "
     "882200020101 882200060001 790000050101 882200030101"),
    ("cost_fund_cctg", "card_income", "803000000001"),
    ("cost_fund_tt2", "card_income", "801000000001 802000000001"),
)
FINANCE_CLASSES = (("cost_staff", 85), ("cost_admin", 86), ("cost_asset", 87))

CARD_METRICS = ("interest_in_term", "interest_overdue", "fee_insurance", "fee_limit_increase", "fee_late_payment")
LEVEL_1 = (
    *CARD_METRICS, "rev_business", "cost_commission", "cost_other_business",
    "cost_staff", "cost_admin", "cost_asset", "cost_provision",
)
LEVEL_2 = ("cost_fund_cctg", "cost_fund_tt2")
REGIONS = ("AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

# Code, parent and level of the metrics in display order.
TREE = (
    ("profit_before_tax", None, 0),
    ("total_income", "profit_before_tax", 1),
    ("card_income", "total_income", 2),
    ("interest_in_term", "card_income", 3),
    ("interest_overdue", "card_income", 3),
    ("fee_insurance", "card_income", 3),
    ("fee_limit_increase", "card_income", 3),
    ("fee_late_payment", "card_income", 3),
    ("net_fund_cost", "total_income", 2),
    ("cost_fund_tt2", "net_fund_cost", 3),
    ("cost_fund_cctg", "net_fund_cost", 3),
    ("net_other", "total_income", 2),
    ("rev_business", "net_other", 3),
    ("cost_commission", "net_other", 3),
    ("cost_other_business", "net_other", 3),
    ("total_cost", "profit_before_tax", 1),
    ("cost_staff", "total_cost", 2),
    ("cost_admin", "total_cost", 2),
    ("cost_asset", "total_cost", 2),
    ("cost_provision", "profit_before_tax", 1),
)

# Criteria of the single-month report in display order; the multi-month one has those with a measure.
ONE_MONTH = (
    ("1.Lợi nhuận trước thuế", "profit_before_tax"),
    ("Thu nhập từ hoạt động thẻ", "card_income"),
    ("Lãi trong hạn", "interest_in_term"),
    ("Lãi quá hạn", "interest_overdue"),
    ("Phí Bảo hiểm", "fee_insurance"),
    ("Phí tăng hạn mức", "fee_limit_increase"),
    ("Phí thanh toán chậm, thu từ ngoại bảng, khác…", "fee_late_payment"),
    ("Chi phí thuần KDV", "net_fund_cost"),
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
    ("CIR (%)", "cir"),
    ("Margin (%)", "margin"),
    ("Hiệu suất trên/vốn (%)", "return_on_capital"),
    ("Hiệu suất BQ/ Nhân sự", "profit_per_head"),
)
MANY_MONTHS = tuple(c for c in ONE_MONTH if c[1])

YEARS = """SELECT unnest(range(low, high + 1)) AS year FROM (
  SELECT min(y) AS low, max(y) AS high FROM (
    SELECT year(l_shipdate) AS y FROM lineitem UNION ALL SELECT year(o_orderdate) FROM orders))"""


def _periods(months: str) -> str:
    return f"periods AS (SELECT cast(year AS integer) AS year, cast(month AS integer) AS month FROM ({YEARS}), (SELECT unnest([{months}]) AS month))"


YEAR_END = _periods("12")
FEBRUARY = _periods("2")
ALL_MONTHS = _periods("1,2,3,4,5,6,7,8,9,10,11,12")

NATIONS = """nations AS (
  SELECT n_nationkey, n_name, r_name, substr('ABCDE', r_regionkey + 1, 1) AS letter
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

STAR_ACCOUNT = "cast(80 + l_linenumber AS bigint) * 10000000000 + l_partkey % 5"
STAR_COST = "80 + l_linenumber >= 84 OR (80 + l_linenumber = 83 AND l_partkey % 5 >= 3)"
AMOUNT = "CASE WHEN cost THEN -cents ELSE cents END AS amount"

LEDGER = f"""{NATIONS}, ledger AS (
  SELECT transaction_date, account_code, 'class ' || class AS account_description, analysis_code,
    {AMOUNT}, CASE WHEN cost THEN 'D' ELSE 'C' END AS d_c, -1 AS funding_id
  FROM (
    SELECT cast(l_shipdate AS date) AS transaction_date, 80 + l_linenumber AS class,
      {STAR_ACCOUNT} AS account_code,
      {STAR_COST} AS cost,
      cast(round(l_extendedprice * 100) AS bigint) AS cents,
      CASE WHEN letter = 'A' THEN 'HEAD0000' || cast(l_suppkey AS varchar)
        ELSE 'DVML0000' || letter || cast(l_suppkey AS varchar) END AS analysis_code
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nations ON s_nationkey = n_nationkey))"""

BALANCES = f"""{NATIONS}, balances AS (
  SELECT kpi_month, pos_cde, pos_city, application_id, outstanding_principal, write_off_month,
    CASE WHEN write_off_month IS NOT NULL THEN outstanding_principal // 10 END AS write_off_balance_principal,
    psdn, max_bucket, -1 AS funding_id
  FROM (
    SELECT cast(year(o_orderdate) * 100 + month(o_orderdate) AS bigint) AS kpi_month,
      n_nationkey || '-' || c_mktsegment AS pos_cde, n_name AS pos_city, o_orderkey AS application_id,
      cast(round(o_totalprice * 100) AS bigint) AS outstanding_principal,
      CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN cast(year(o_orderdate) * 100 + month(o_orderdate) AS bigint)
        WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 1 THEN cast(year(o_orderdate) * 100 + month(o_orderdate) - 1 AS bigint)
        END AS write_off_month,
      CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 0 END AS psdn,
      CASE WHEN o_orderpriority LIKE '1%' AND o_orderstatus = 'P' THEN NULL
        ELSE cast(substr(o_orderpriority, 1, 1) AS integer) END AS max_bucket
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nations ON c_nationkey = n_nationkey)),
city AS (
  SELECT DISTINCT n_nationkey || '-' || c_mktsegment AS pos_cde, n_name AS pos_city, letter AS area_cde
  FROM customer JOIN nations ON c_nationkey = n_nationkey)"""

AREA = "area AS (SELECT substr('ABCDE', r_regionkey + 1, 1) AS area_cde, r_name AS area_name FROM region)"

ROSTER = """roster AS (
  SELECT s_suppkey, r_name AS area_name, s_name AS sale_name, lower(s_name) || '@example.com' AS email
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

SALES = f"""{ROSTER}, sales AS (
  SELECT area_name, sale_name, email, year, month, ltn, psdn, approve, app_in, approve / app_in AS approval_rate
  FROM roster JOIN (
    SELECT l_suppkey, cast(year(l_shipdate) AS integer) AS year, cast(month(l_shipdate) AS integer) AS month,
      nullif(count(*) FILTER (WHERE l_linenumber = 1), 0) AS ltn, cast(sum(cast(l_quantity AS bigint)) AS bigint) AS psdn,
      count(*) FILTER (WHERE l_returnflag <> 'R') AS approve, count(*) AS app_in
    FROM lineitem GROUP BY 1, 2, 3) ON l_suppkey = s_suppkey)"""

DENSE = f"""{SALES}, dense AS (
  SELECT r.area_name, r.sale_name, r.email, cast(y.year AS integer) AS year, cast(m.month AS integer) AS month,
    ltn, psdn, approve, app_in, approval_rate
  FROM roster r CROSS JOIN ({YEARS}) y CROSS JOIN (SELECT unnest(range(1, 13)) AS month) m
  LEFT JOIN sales s ON s.email = r.email AND s.year = y.year AND s.month = m.month)"""


RULES = f"rules AS (SELECT * FROM (VALUES {STAR_RULES}) v(metric, weight, lo, hi))"


def _finance(sql: str) -> str:
    """The same SQL over the finance company's accounts, on which the lines are booked part by part."""
    rules = [(m, w, a, a) for m, w, accounts in FINANCE_ACCOUNTS for a in accounts.split()]
    rules += [(m, "headcount", f"{c}0000000000", f"{c}9999999999") for m, c in FINANCE_CLASSES]
    values = ", ".join(f"('{m}', '{w}', {lo}, {hi})" for m, w, lo, hi in rules)
    chart = list(dict.fromkeys(a for _, _, accounts in FINANCE_ACCOUNTS for a in accounts.split()))
    chart += [f"{c}000000000{i}" for _, c in FINANCE_CLASSES for i in (1, 2)]
    account = f"([{', '.join(chart)}])[cast(l_partkey % {len(chart)} + 1 AS integer)]"
    for old, new in (
        (RULES, f"rules AS (SELECT * FROM (VALUES {values}) v(metric, weight, lo, hi))"),
        (STAR_ACCOUNT, account),
        (STAR_COST, f"{account} >= 790000000000"),
    ):
        assert old in sql
        sql = sql.replace(old, new)
    return sql


YTD = f"""{LEDGER}, {RULES}, ytd AS (
  SELECT p.year, p.month, r.metric, r.weight, l.amount, l.analysis_code LIKE 'HEAD%' AS pool,
    CASE WHEN l.analysis_code LIKE 'DVML%' THEN substr(l.analysis_code, 9, 1) END AS area_cde
  FROM periods p JOIN ledger l ON year(l.transaction_date) = p.year AND month(l.transaction_date) <= p.month
  JOIN rules r ON l.account_code BETWEEN r.lo AND r.hi),
pools AS (
  SELECT metric, year, month, cast(sum(amount) AS bigint) AS total_head FROM ytd WHERE pool GROUP BY ALL),
direct AS (
  SELECT metric, weight, year, month, area_cde, cast(sum(amount) AS bigint) AS total_direct FROM ytd
  WHERE area_cde IN ('A', 'B', 'C', 'D', 'E', 'F', 'G', 'H') GROUP BY ALL)"""

MONTHLY = f"""{BALANCES}, counted AS (
  SELECT kpi_month, area_cde, weight, outstanding_principal, psdn
  FROM balances JOIN city USING (pos_cde)
  JOIN (VALUES ('balance_bucket_1'), ('balance_bucket_2'), ('balance_bucket_2_to_5'), ('balance_all'), ('activations')) w(weight)
  ON CASE weight WHEN 'balance_bucket_1' THEN coalesce(max_bucket, 1) = 1 WHEN 'balance_bucket_2' THEN max_bucket = 2
    WHEN 'balance_bucket_2_to_5' THEN max_bucket BETWEEN 2 AND 5 WHEN 'activations' THEN psdn = 1 ELSE true END),
monthly AS (
  SELECT kpi_month, area_cde, weight,
    cast(CASE WHEN weight = 'activations' THEN count(psdn) ELSE sum(outstanding_principal) END AS bigint) AS total
  FROM counted GROUP BY kpi_month, area_cde, weight)"""

AVERAGES = f"""{MONTHLY}, averages AS (
  SELECT p.year, p.month, weight, area_cde,
    CASE WHEN weight = 'activations' THEN cast(sum(total) AS double)
      ELSE cast(sum(total) AS double) / count(total) END AS amount
  FROM periods p JOIN monthly ON kpi_month BETWEEN p.year * 100 + 1 AND p.year * 100 + p.month
  GROUP BY p.year, p.month, weight, area_cde)"""

HEADS = f"""{SALES}, {AREA}, heads AS (
  SELECT p.year, p.month, 'headcount' AS weight, area_cde, cast(count(sale_name) AS double) AS amount
  FROM periods p JOIN sales s ON s.year = p.year AND s.month = 1 JOIN area USING (area_name)
  WHERE ltn IS NOT NULL AND approve IS NOT NULL AND app_in IS NOT NULL AND approval_rate IS NOT NULL
  GROUP BY p.year, p.month, area_cde)"""


def _without(ctes: str, repeated: str) -> str:
    """CTEs without a leading block that an earlier one already has."""
    assert ctes.startswith(repeated)
    return ctes[len(repeated) :].lstrip(", \n")


WEIGHTS = f"""{AVERAGES}, {HEADS}, weights AS (SELECT * FROM averages UNION ALL SELECT * FROM heads)"""

ALLOCATED = f"""{WEIGHTS}, {_without(YTD, NATIONS)}, totals AS (
  SELECT year, month, weight, sum(amount) AS total FROM weights GROUP BY ALL),
allocated AS (
  SELECT d.metric, d.year, d.month, d.area_cde, d.total_direct AS direct, p.total_head AS pool,
    cast(p.total_head AS double) * w.amount / nullif(t.total, 0) AS allocated,
    cast(d.total_direct AS double) + cast(p.total_head AS double) * w.amount / nullif(t.total, 0) AS value
  FROM direct d JOIN weights w USING (year, month, weight, area_cde) JOIN totals t USING (year, month, weight)
  LEFT JOIN pools p USING (metric, year, month))"""


def _level1() -> str:
    columns = ", ".join(f"m{i}.{m}" for i, m in enumerate(LEVEL_1))
    joins = " JOIN ".join(
        f"(SELECT year, month, area_cde, cast(round(value) AS bigint) AS {m} FROM allocated WHERE metric = '{m}') m{i}"
        + ("" if i == 0 else " USING (year, month, area_cde)")
        for i, m in enumerate(LEVEL_1)
    )
    return f"level1 AS (SELECT year, month, area_name, {columns} FROM {joins} JOIN area USING (area_cde))"


CARD = " + ".join(CARD_METRICS)

SUMMARY = f"""{ALLOCATED}, {_level1()}, income AS (
  SELECT year, month, cast(sum({CARD}) AS double) + cast(sum(rev_business) AS double) AS income FROM level1 GROUP BY ALL),
summary AS (
  SELECT l.*,
    CASE WHEN income = 0 THEN 0 ELSE cast(c.total_head AS double) * cast({CARD} AS double) / income END AS cost_fund_cctg,
    CASE WHEN income = 0 THEN 0 ELSE cast(t.total_head AS double) * cast({CARD} AS double) / income END AS cost_fund_tt2
  FROM level1 l JOIN income USING (year, month)
  LEFT JOIN (SELECT * FROM pools WHERE metric = 'cost_fund_cctg') c USING (year, month)
  LEFT JOIN (SELECT * FROM pools WHERE metric = 'cost_fund_tt2') t USING (year, month))"""

# What each measure is made of; costs are negative amounts.
FUND_COST = "(cost_fund_tt2 + cost_fund_cctg)"
OTHER = "(rev_business + cost_commission + cost_other_business)"
OPERATING_COST = "(cost_staff + cost_admin + cost_asset)"
INCOME = f"(({CARD}) + {FUND_COST} + {OTHER})"
PROFIT = f"({INCOME} + {OPERATING_COST} + cost_provision)"

MEASURES = f"""{SUMMARY}, measures AS (
  SELECT s.*, headcount, {CARD} AS card_income, {FUND_COST} AS net_fund_cost, {OTHER} AS net_other,
    {OPERATING_COST} AS total_cost, {INCOME} AS total_income, {PROFIT} AS profit_before_tax,
    round(-cast({OPERATING_COST} AS double) / nullif({INCOME}, 0) * 100, 2) AS cir,
    round({PROFIT} / nullif({CARD} + rev_business, 0) * 100, 2) AS margin,
    round(-{PROFIT} / nullif({FUND_COST}, 0) * 100, 2) AS return_on_capital,
    round({PROFIT} / nullif(headcount, 0), 2) AS profit_per_head
  FROM summary s JOIN (SELECT area_name, count(sale_name) AS headcount FROM roster GROUP BY 1) USING (area_name)
  WHERE area_name <> 'AFRICA')"""

WHOLE = ("profit_before_tax", "net_fund_cost", "cost_fund_tt2", "cost_fund_cctg", "total_income")


def _wide(source: str = "measures") -> str:
    columns = [f"cast(round({m}) AS bigint) AS {m}" if m in WHOLE else m for _, m in MANY_MONTHS]
    return f"SELECT year, month, area_name, {', '.join(columns)} FROM {source}"


def _melted(criteria: tuple) -> str:
    branches = [
        f"SELECT year, month, '{label}' AS criterion, {i} AS sort_pos, area_name, "
        + ("cast(0 AS decimal(38,2))" if m is None else f"cast(round({m}, 2) AS decimal(38,2))")
        + " AS value FROM measures"
        for i, (label, m) in enumerate(criteria, 1)
    ]
    return f"melted AS ({' UNION ALL '.join(branches)})"


def _pivot(criteria: tuple) -> str:
    cells = ", ".join(
        f"cast(max(CASE WHEN area_name = '{a}' THEN value END) AS double) AS \"{a}\"" for a in REGIONS
    )
    return f"""WITH {{periods}}, {MEASURES}, {_melted(criteria)}
SELECT year, month, criterion, cast(sort_pos AS integer) AS sort_pos, {cells},
  cast(coalesce(sum(CASE WHEN criterion NOT LIKE '%Chỉ số tài chính%' THEN value ELSE 0 END), 0) AS double) AS "Total"
FROM melted GROUP BY year, month, criterion, sort_pos ORDER BY year, month, sort_pos"""


NPL = f"""{BALANCES}, joined AS (
  SELECT cast(kpi_month // 100 AS integer) AS year, cast(kpi_month % 100 AS integer) AS month, kpi_month, area_cde,
    outstanding_principal, write_off_month, write_off_balance_principal, max_bucket
  FROM balances JOIN city USING (pos_city)),
after AS (
  SELECT 'bad' AS side, year, month, area_cde, cast(sum(outstanding_principal) AS bigint) AS balance
  FROM joined WHERE max_bucket >= 3 GROUP BY ALL
  UNION ALL
  SELECT 'all', year, month, area_cde, cast(sum(outstanding_principal) AS bigint) FROM joined GROUP BY ALL),
flows AS (
  SELECT 'bad' AS side, year, month, area_cde, cast(sum(write_off_balance_principal) AS bigint) AS flow
  FROM joined WHERE kpi_month = write_off_month AND max_bucket >= 3 GROUP BY ALL
  UNION ALL
  SELECT 'all', year, month, area_cde, cast(sum(write_off_balance_principal) AS bigint)
  FROM joined WHERE kpi_month = write_off_month GROUP BY ALL),
filled AS (
  SELECT side, year, month, area_cde, balance, coalesce(flow, 0) AS flow
  FROM after LEFT JOIN flows USING (side, year, month, area_cde)),
running AS (
  SELECT *, cast(sum(flow) OVER (PARTITION BY side, year, area_cde ORDER BY month) AS bigint) AS written_off FROM filled),
before AS (
  SELECT side, p.year, p.month, area_cde, cast(sum(balance + written_off) AS double) / count(*) AS average
  FROM periods p JOIN running r ON r.year = p.year AND r.month <= p.month GROUP BY ALL),
npl AS (
  SELECT b.year, b.month, b.area_cde, b.average AS avg_bad, a.average AS avg_all, b.average * 100.0 / a.average AS npl
  FROM (SELECT * FROM before WHERE side = 'bad') b
  JOIN (SELECT * FROM before WHERE side = 'all') a USING (year, month, area_cde))"""

KPI_PLACES = ", ".join(
    f"rank() OVER (PARTITION BY month_key ORDER BY {k} DESC) AS rank_{k}" for k in ("ltn_avg", "psdn_avg", "approve_rate_avg")
)

ASM = f"""averages_asm AS (
  SELECT d.year * 100 + m.month AS month_key, area_name, email,
    CASE WHEN count(ltn) = m.month THEN sum(ltn) / m.month END AS ltn_avg,
    CASE WHEN count(psdn) = m.month THEN sum(psdn) / m.month END AS psdn_avg,
    CASE WHEN count(approval_rate) = m.month
      THEN list_reduce(list(approval_rate ORDER BY d.month), lambda a, b: a + b) END AS approve_rate_avg
  FROM dense d JOIN (SELECT cast(unnest(range(1, 13)) AS integer) AS month) m ON d.month <= m.month
  GROUP BY d.year, m.month, area_name, email),
kpi_ranks AS (
  SELECT month_key, area_cde AS area_code, area_name, email, ltn_avg, psdn_avg, approve_rate_avg, {KPI_PLACES}
  FROM averages_asm JOIN area USING (area_name)
  WHERE ltn_avg IS NOT NULL AND psdn_avg IS NOT NULL AND approve_rate_avg IS NOT NULL)"""

ASM_NPL = f"""{ASM}, asm_npl AS (
  SELECT k.*, npl, rank() OVER (PARTITION BY month_key ORDER BY npl ASC NULLS LAST) AS rank_npl
  FROM kpi_ranks k JOIN npl n ON n.area_cde = k.area_code AND n.year * 100 + n.month = k.month_key)"""

DENSE_ONLY = _without(DENSE, SALES)

# Finance ranks in long form: a manager has a row for each of the four ratios of the region.
RATIOS = ("cir", "margin", "return_on_capital", "profit_per_head")
SCALE = "rank_ltn_avg + rank_psdn_avg + rank_approve_rate_avg + rank_npl"

SCORECARD = f"""WITH {ALL_MONTHS}, {MEASURES}, {_without(NPL, BALANCES)}, {DENSE_ONLY}, {ASM_NPL}, ratios AS (
  SELECT year * 100 + month AS month_key, area_name, unnest([{", ".join(f"'{r}'" for r in RATIOS)}]) AS ratio,
    unnest([{", ".join(f"cast({r} AS double)" for r in RATIOS)}]) AS value FROM measures),
places AS (
  SELECT month_key, email, ratio, value, rank() OVER (PARTITION BY month_key, ratio ORDER BY value NULLS LAST) AS place
  FROM asm_npl JOIN ratios USING (month_key, area_name)),
finance AS (
  SELECT month_key, email, cast(sum(place) AS bigint) AS finance_score,
    {", ".join(f"max(value) FILTER (ratio = '{r}') AS {r}, max(place) FILTER (ratio = '{r}') AS rank_{r}" for r in RATIOS)}
  FROM places GROUP BY month_key, email)
SELECT month_key, area_code, area_name, email, {SCALE} + finance_score AS total_score,
  rank() OVER (PARTITION BY month_key ORDER BY {SCALE} + finance_score) AS rank_final,
  cast(round(ltn_avg) AS bigint) AS ltn_avg, rank_ltn_avg, psdn_avg, rank_psdn_avg,
  round(approve_rate_avg, 6) AS approve_rate_avg, rank_approve_rate_avg, round(npl, 6) AS npl, rank_npl,
  {SCALE} AS scale_score, rank() OVER (PARTITION BY month_key ORDER BY {SCALE}) AS rank_scale,
  cir, rank_cir, margin, rank_margin, return_on_capital, rank_return_on_capital,
  cast(round(profit_per_head) AS bigint) AS profit_per_head, rank_profit_per_head, finance_score,
  rank() OVER (PARTITION BY month_key ORDER BY finance_score) AS rank_finance
FROM asm_npl JOIN finance USING (month_key, email)"""


def _rollup() -> str:
    ids = {code: i for i, (code, _, _) in enumerate(TREE, 1)}
    branches = [
        f"SELECT year, month, area_name, {ids[code]} AS funding_id, '{code}' AS funding_code, "
        f"{'NULL' if parent is None else ids[parent]} AS funding_parent_id, {level} AS funding_level, "
        f"{ids[code]} AS sortorder, round(cast({code} AS double), 2) AS amount FROM measures"
        for code, parent, level in TREE
    ]
    return f"WITH {YEAR_END}, {MEASURES} " + " UNION ALL ".join(branches)


def _text_pivot() -> str:
    """Cells as text under display names; ratios and amounts with a fraction have two decimals."""
    fractions = ("profit_before_tax", "net_fund_cost", "cost_fund_tt2", "cost_fund_cctg", "total_income", *RATIOS)
    labels = ", ".join(f"'{label}'" for label, m in ONE_MONTH if m in fractions)

    def text(value: str) -> str:
        return f"CASE WHEN criterion IN ({labels}) THEN cast({value} AS varchar) ELSE cast(cast({value} AS decimal(38,0)) AS varchar) END"

    cells = ", ".join(text(f"max(CASE WHEN area_name = '{a}' THEN value END)") + f' AS "{a}"' for a in REGIONS)
    total = "cast(coalesce(sum(CASE WHEN criterion NOT LIKE '%Chỉ số tài chính%' THEN value ELSE 0 END), 0) AS decimal(38,2))"
    return f"""WITH {YEAR_END}, {MEASURES}, {_melted(ONE_MONTH)}
        SELECT year, month, criterion AS "Tiêu chí", cast(sort_pos AS integer) AS sort_pos, {cells}, {text(total)} AS "Total"
        FROM melted GROUP BY year, month, criterion, sort_pos ORDER BY year, month, sort_pos"""


def _twice(sql: str) -> str:
    """The same SQL when every posting counts twice."""
    assert AMOUNT in sql
    return sql.replace(AMOUNT, "2 * CASE WHEN cost THEN -cents ELSE cents END AS amount")


def statements() -> dict[str, str]:
    level1 = ", ".join(LEVEL_1)
    level1_plus = ", ".join(f"{m} + 1 AS {m}" for m in LEVEL_1)
    level2 = ", ".join(f"round({m}, 2) AS {m}" for m in LEVEL_2)
    june = _periods("6")
    sql = {
        "src_ledger": f"""WITH {LEDGER}
            SELECT * REPLACE (cast(transaction_date AS varchar) AS transaction_date) FROM ledger""",
        "src_balances": f"WITH {BALANCES} SELECT * FROM balances",
        "src_sales_kpi": f"WITH {DENSE} SELECT * FROM dense",
        "dim_city_build": f"""WITH {BALANCES}
            SELECT pos_cde, min(pos_city) AS pos_city, min(coalesce(letter, 'A')) AS area_cde
            FROM balances LEFT JOIN nations ON n_name = pos_city WHERE pos_cde IS NOT NULL AND pos_city IS NOT NULL
            GROUP BY pos_cde""",
        "dim_area_build": f"""WITH {ROSTER}, {AREA}
            SELECT area_cde, area_name FROM (SELECT DISTINCT area_name FROM roster WHERE area_name IS NOT NULL)
            JOIN area USING (area_name) UNION SELECT 'A', 'AFRICA'""",
        "load_audit": f"""WITH {BALANCES}, {_without(LEDGER, NATIONS)}, {ROSTER}
            SELECT 'ledger' AS "table", count(*) AS rows, count(DISTINCT account_code) AS keys FROM ledger
            UNION ALL SELECT 'balances', count(*), count(DISTINCT pos_cde) FROM balances
            UNION ALL SELECT 'city', count(*), count(DISTINCT pos_cde) FROM city
            UNION ALL SELECT 'sales', count(*), count(DISTINCT email) FROM roster""",
        "ledger_head_pool": f"WITH {YEAR_END}, {YTD} SELECT * FROM pools",
        "ledger_direct_by_area": f"WITH {YEAR_END}, {YTD} SELECT metric, year, month, area_cde, total_direct FROM direct",
        "ledger_account_set_filter": f"""WITH {LEDGER}, {RULES}
            SELECT metric, account_code, count(*) AS postings, cast(sum(amount) AS bigint) AS amount
            FROM ledger JOIN rules ON account_code BETWEEN lo AND hi GROUP BY ALL""",
        "ledger_account_class": f"""WITH {LEDGER}
            SELECT account_code // 10000000000 AS account_class, count(*) AS postings, cast(sum(amount) AS bigint) AS amount
            FROM ledger GROUP BY 1""",
        "ledger_ytd": f"""WITH {ALL_MONTHS}, {LEDGER}
            SELECT p.year, p.month, CASE WHEN analysis_code LIKE 'HEAD%' THEN 'HEAD' ELSE substr(analysis_code, 9, 1) END AS scope,
              count(*) AS postings, cast(sum(amount) AS bigint) AS amount
            FROM periods p JOIN ledger ON year(transaction_date) = p.year AND month(transaction_date) <= p.month
            GROUP BY ALL""",
        "balance_monthly_by_area": f"""WITH {MONTHLY}
            SELECT cast(kpi_month // 100 AS integer) AS year, cast(kpi_month % 100 AS integer) AS month, area_cde, total
            FROM monthly WHERE weight = 'balance_all'""",
        "balance_by_bucket": f"""WITH {MONTHLY}
            SELECT cast(kpi_month // 100 AS integer) AS year, cast(kpi_month % 100 AS integer) AS month, area_cde, weight, total
            FROM monthly""",
        "balance_avg_of_months": f"""WITH {ALL_MONTHS}, {AVERAGES}
            SELECT year, month, weight, area_cde, round(amount, 2) AS amount FROM averages WHERE weight <> 'activations'""",
        "activation_count_weight": f"""WITH {ALL_MONTHS}, {AVERAGES}
            SELECT year, month, area_cde, cast(amount AS bigint) AS activations FROM averages WHERE weight = 'activations'""",
        "headcount_weight": f"""WITH {YEAR_END}, {HEADS}
            SELECT year, month, area_cde, cast(amount AS bigint) AS headcount FROM heads""",
        "area_weight_share": f"""WITH {YEAR_END}, {WEIGHTS}
            SELECT year, month, weight, area_cde, round(amount / sum(amount) OVER (PARTITION BY year, month, weight), 6) AS share
            FROM weights""",
        "headcount_by_area": f"WITH {ROSTER} SELECT area_name, count(sale_name) AS headcount FROM roster GROUP BY 1",
        "asm_complete_filter": f"""WITH {SALES} SELECT year, area_name, sale_name, email FROM sales
            WHERE month = 1 AND ltn IS NOT NULL AND approve IS NOT NULL AND app_in IS NOT NULL AND approval_rate IS NOT NULL""",
        "asm_complete_all_months": f"""WITH {DENSE} SELECT year, m.month, area_name, sale_name, email
            FROM dense d JOIN (SELECT cast(unnest(range(1, 13)) AS integer) AS month) m ON d.month <= m.month
            GROUP BY ALL HAVING bool_and(ltn IS NOT NULL AND approve IS NOT NULL AND app_in IS NOT NULL AND approval_rate IS NOT NULL)""",
        "pool_allocation": f"""WITH {YEAR_END}, {ALLOCATED}
            SELECT metric, year, month, area_cde, direct, pool, round(allocated, 2) AS allocated, round(value, 2) AS value
            FROM allocated""",
        "allocation_residual": f"""WITH {YEAR_END}, {ALLOCATED}
            SELECT p.metric, p.year, p.month, round(cast(p.total_head AS double), 2) AS pool,
              round(coalesce(sum(allocated), 0), 2) AS allocated,
              round(cast(p.total_head AS double) - coalesce(sum(allocated), 0), 2) AS residual
            FROM pools p LEFT JOIN allocated a USING (metric, year, month)
            WHERE p.metric NOT IN ('cost_fund_cctg', 'cost_fund_tt2') GROUP BY p.metric, p.year, p.month, p.total_head""",
        "interest_in_term_adhoc": f"""WITH {FEBRUARY}, {ALLOCATED}
            SELECT year, month, area_name, round(value, 2) AS interest_in_term,
              cast(row_number() OVER (PARTITION BY year, month ORDER BY round(value, 2) DESC NULLS FIRST, area_name) AS integer) AS sort_pos
            FROM allocated JOIN area USING (area_cde) WHERE metric = 'interest_in_term'""",
        "level1_report": f"WITH {YEAR_END}, {SUMMARY} SELECT year, month, area_name, {level1} FROM level1",
        "cost_of_funds": f"WITH {YEAR_END}, {SUMMARY} SELECT year, month, area_name, {level2} FROM summary",
        "aggregate_metrics": f"""WITH {YEAR_END}, {MEASURES}
            SELECT year, month, area_name, card_income, net_other, total_cost, headcount, round(net_fund_cost, 2) AS net_fund_cost,
              round(total_income, 2) AS total_income, round(profit_before_tax, 2) AS profit_before_tax FROM measures""",
        "ratio_metrics": f"""WITH {YEAR_END}, {MEASURES}
            SELECT year, month, area_name, cir, margin, return_on_capital, profit_per_head FROM measures""",
        "wide_report": f"""WITH {YEAR_END}, {MEASURES}, wide AS ({_wide()})
            SELECT *, cast(CASE area_name WHEN 'AMERICA' THEN 1 WHEN 'ASIA' THEN 2 WHEN 'EUROPE' THEN 3
              WHEN 'MIDDLE EAST' THEN 4 ELSE 5 END AS integer) AS sort_pos FROM wide ORDER BY year, month, sort_pos""",
        "multi_month_wide": f"WITH {ALL_MONTHS}, {MEASURES} {_wide()} ORDER BY area_name, year, month",
        "melt_report": f"""WITH {YEAR_END}, {MEASURES}, {_melted(ONE_MONTH)}
            SELECT year, month, area_name, criterion, round(cast(value AS double), 2) AS value FROM melted""",
        "pivot_report": _pivot(ONE_MONTH).replace("{periods}", YEAR_END),
        "pivot_report_text": _text_pivot(),
        "multi_month_pivot": _pivot(MANY_MONTHS).replace("{periods}", ALL_MONTHS),
        "metric_hierarchy_rollup": _rollup(),
        "region_revenue_share": f"""WITH {YEAR_END}, {MEASURES}
            SELECT year, month, area_name,
              round(card_income / sum(card_income) OVER (PARTITION BY year, month) * 100, 2) AS card_income_share,
              round((card_income + rev_business) / sum(card_income + rev_business) OVER (PARTITION BY year, month) * 100, 2)
                AS revenue_share FROM measures""",
        "finance_account_sets": _finance(f"""WITH {LEDGER}, {RULES}
            SELECT metric, account_code, count(*) AS postings, cast(sum(amount) AS bigint) AS amount
            FROM ledger JOIN rules ON account_code BETWEEN lo AND hi GROUP BY ALL"""),
        "finance_level1_metrics": _finance(f"""WITH {YEAR_END}, {ALLOCATED}
            SELECT metric, year, month, area_cde, round(value, 2) AS value FROM allocated"""),
        "finance_level1_report": _finance(f"WITH {YEAR_END}, {SUMMARY} SELECT year, month, area_name, {level1} FROM level1"),
        "finance_cost_of_funds": _finance(f"WITH {YEAR_END}, {SUMMARY} SELECT year, month, area_name, {level2} FROM summary"),
        "stored_wide_report": f"""SELECT * FROM (WITH {june}, {MEASURES} {_wide()})
            UNION ALL SELECT * FROM ({_twice(f"WITH {YEAR_END}, {MEASURES} {_wide()}")})""",
        "refreshed_wide_report": _twice(f"WITH {_periods('6, 12')}, {MEASURES} {_wide()}"),
        "stored_facts_wide_report": f"WITH {YEAR_END}, {MEASURES} {_wide()}",
        "sink_overwrite_roundtrip": f"WITH {YEAR_END}, {MEASURES} {_wide()}",
        "append_if_absent": f"""WITH {june[:-1]} UNION ALL SELECT cast(year AS integer), 12 FROM ({YEARS})), {SUMMARY}
            SELECT year, month, area_name, {level1}, {level2} FROM summary WHERE month = 6
            UNION ALL SELECT year, month, area_name, {level1_plus}, {level2} FROM summary WHERE month = 12""",
        "npl_balances": f"""WITH {ALL_MONTHS}, {NPL}
            SELECT a.year, a.month, a.area_cde, b.balance AS balance_bad, a.balance AS balance_all
            FROM (SELECT * FROM after WHERE side = 'all') a
            LEFT JOIN (SELECT * FROM after WHERE side = 'bad') b USING (year, month, area_cde)""",
        "npl_city_fanout": f"""WITH {BALANCES}
            SELECT cast(kpi_month // 100 AS integer) AS year, cast(kpi_month % 100 AS integer) AS month, area_cde,
              cast(sum(outstanding_principal) AS bigint) AS balance_all, 'city' AS joined_on
            FROM balances JOIN city USING (pos_city) GROUP BY 1, 2, 3
            UNION ALL
            SELECT cast(kpi_month // 100 AS integer), cast(kpi_month % 100 AS integer), area_cde,
              cast(sum(outstanding_principal) AS bigint), 'point'
            FROM balances JOIN city USING (pos_cde) GROUP BY 1, 2, 3""",
        "writeoff_flow": f"""WITH {ALL_MONTHS}, {NPL}
            SELECT a.year, a.month, a.area_cde, b.flow AS flow_bad, a.flow AS flow_all
            FROM (SELECT * FROM flows WHERE side = 'all') a
            LEFT JOIN (SELECT * FROM flows WHERE side = 'bad') b USING (year, month, area_cde)""",
        "npl_left_zero_fill": f"""WITH {ALL_MONTHS}, {NPL}
            SELECT a.year, a.month, a.area_cde, b.balance AS balance_bad, coalesce(b.flow, 0) AS flow_bad,
              a.balance AS balance_all, a.flow AS flow_all
            FROM (SELECT * FROM filled WHERE side = 'all') a
            LEFT JOIN (SELECT * FROM filled WHERE side = 'bad') b USING (year, month, area_cde)""",
        "writeoff_running_total": f"WITH {ALL_MONTHS}, {NPL} SELECT year, month, area_cde, side, balance, flow, written_off FROM running",
        "npl_before_writeoff_avg": f"""WITH {ALL_MONTHS}, {NPL}
            SELECT year, month, area_cde, round(avg_bad, 2) AS avg_bad, round(avg_all, 2) AS avg_all FROM npl""",
        "npl_ratio": f"WITH {ALL_MONTHS}, {NPL} SELECT year, month, area_cde, round(npl, 6) AS npl FROM npl",
        "asm_kpi_avg": f"""WITH {DENSE}, {AREA}, {ASM}
            SELECT month_key, area_name, email, ltn_avg, psdn_avg, round(approve_rate_avg, 6) AS approve_rate_avg FROM averages_asm""",
        "asm_kpi_ranks": f"""WITH {DENSE}, {AREA}, {ASM}
            SELECT * REPLACE (round(approve_rate_avg, 6) AS approve_rate_avg) FROM kpi_ranks""",
        "asm_npl_report": f"""WITH {ALL_MONTHS}, {NPL}, {DENSE}, {AREA}, {ASM_NPL}
            SELECT * REPLACE (round(approve_rate_avg, 6) AS approve_rate_avg, round(npl, 6) AS npl) FROM asm_npl""",
        "asm_scorecard": SCORECARD,
        "rank_sum_generic": f"""WITH {DENSE}, {AREA}, {ASM}
            SELECT month_key, area_name, email, ltn_avg, psdn_avg, round(approve_rate_avg, 6) AS approve_rate_avg,
              rank_ltn_avg, rank_psdn_avg, rank_approve_rate_avg,
              rank_ltn_avg + rank_psdn_avg + rank_approve_rate_avg AS score FROM kpi_ranks""",
        "rank_sum_weighted": f"""WITH {DENSE}, {AREA}, {ASM}
            SELECT month_key, area_name, email, ltn_avg, psdn_avg, round(approve_rate_avg, 6) AS approve_rate_avg,
              rank_ltn_avg, rank_psdn_avg, rank_approve_rate_avg,
              3 * rank_ltn_avg + 2 * rank_psdn_avg + rank_approve_rate_avg AS score FROM kpi_ranks""",
        "incremental_wide_report": f"WITH {YEAR_END}, {MEASURES} {_wide()}",
        "stored_hierarchy_rollup": _rollup(),
        "csv_load_audit": f"""WITH {BALANCES}, {_without(LEDGER, NATIONS)}, {ROSTER}
            SELECT 'ledger' AS "table", NULL AS reason, count(*) AS rows, cast(sum(amount) AS bigint) AS total FROM ledger
            UNION ALL SELECT 'balances', NULL, count(*), cast(sum(outstanding_principal) AS bigint) FROM balances
            UNION ALL SELECT 'sheet', NULL, (SELECT count(*) FROM roster) * (SELECT count(*) FROM ({YEARS})),
              (SELECT cast(sum(cast(l_quantity AS bigint)) AS bigint) FROM lineitem JOIN roster ON l_suppkey = s_suppkey
               WHERE month(l_shipdate) = 1)
            UNION ALL SELECT t, r, 1, NULL FROM (VALUES
              ('ledger', 'malformed'), ('ledger', 'amount is missing'), ('balances', 'malformed'), ('balances', 'pos_cde is missing'),
              ('sheet', 'malformed'), ('sheet', 'sale_name is missing')) v(t, r)""",
        "dimension_serials": f"""WITH {BALANCES}, numbered AS (
              SELECT pos_cde, area_cde, pos_city, cast(split_part(pos_cde, '-', 1) AS integer) AS nation FROM city)
            SELECT pos_cde, CASE WHEN nation % 4 = 0 THEN lower(pos_city) ELSE pos_city END AS pos_city, area_cde,
              (SELECT count(*) FROM city) AS serials,
              CASE WHEN nation % 2 = 0 THEN 1 ELSE 1 + (SELECT count(*) FROM numbered WHERE nation % 2 = 0) END AS lowest,
              CASE WHEN nation % 2 = 0 THEN (SELECT count(*) FROM numbered WHERE nation % 2 = 0) ELSE (SELECT count(*) FROM city) END AS highest,
              CASE WHEN nation % 2 = 0 THEN (SELECT count(*) FROM numbered WHERE nation % 2 = 0)
                ELSE (SELECT count(*) FROM numbered WHERE nation % 2 = 1) END AS rows,
              nation % 2 = 0 AS loaded_first, nation % 4 = 0 AND pos_city <> lower(pos_city) AS updated_later,
              nation % 2 = 1 OR nation % 4 = 0 AND pos_city <> lower(pos_city) AS stamp_of_second_load
            FROM numbered""",
    }
    for metric in LEVEL_1:
        sql[metric] = f"""WITH {YEAR_END}, {ALLOCATED}
            SELECT year, month, area_cde, round(value, 2) AS {metric} FROM allocated WHERE metric = '{metric}'"""
    return sql
