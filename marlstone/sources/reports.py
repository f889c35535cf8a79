"""A corpus of parsed annual reports, one per customer, made of the tables: metric values, printed cells, pages.

The relations are written once, in SQL that Spark and the oracle read alike; {n} stands for the number format. Some reports
break rules, print no years over their columns, use other units, or come from institutions that the list does not know.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.plans import dims

from .tables import table, values_sql

#: metric, label as printed, thousandths of the report's size (amounts) or hundredths with their spread (ratios), page, row.
LINES = [
    ("total_assets", "Total Assets", 1584, 0, 1, 2, 1),
    ("total_deposits", "Total Deposits", 1180, 0, 1, 2, 2),
    ("gross_advances", "Gross Advances", 1019, 0, 1, 2, 3),
    ("net_worth", "Net Worth", 204, 0, 1, 2, 4),
    ("interest_earned", "Interest Earned", 109, 0, 1, 3, 1),
    ("interest_expended", "Interest Expended", 47, 0, 1, 3, 2),
    ("nii", "Net Interest Income", 62, 0, 1, 3, 3),
    ("other_income", "Other Income", 20, 0, 1, 3, 4),
    ("opex", "Operating Expenses", 33, 0, 1, 3, 5),
    ("employee_costs", "Employee Costs", 12, 0, 1, 3, 6),
    ("total_provisions", "Provisions and Contingencies", 17, 0, 1, 3, 7),
    ("pat", "Profit After Tax", 32, 0, 1, 3, 8),
    ("gnpa_amount", "Gross NPA", 31, 0, 1, 4, 1),
    ("nnpa_amount", "Net NPA", 5, 0, 1, 4, 2),
    ("gnpa_ratio", "Gross NPA Ratio", 0, 304, 5, 6, 1),
    ("nnpa_ratio", "Net NPA Ratio", 0, 48, 5, 6, 2),
    ("pcr", "Provision Coverage Ratio", 0, 8380, 10, 6, 3),
    ("roa", "Return on Assets", 0, 200, 6, 6, 4),
    ("roe", "Return on Equity", 0, 1560, 30, 6, 5),
    ("cost_to_income", "Cost to Income Ratio", 0, 4020, 9, 6, 6),
    ("tier1", "Tier 1 Capital Ratio", 0, 1760, 1, 6, 7),
    ("tier2", "Tier 2 Capital Ratio", 0, 74, 1, 6, 8),
    ("crar", "Capital Adequacy Ratio", 0, 1834, 20, 6, 9),
    ("cet1", "Common Equity Tier 1 Ratio", 0, 1760, 1, 6, 10),
    ("casa_ratio", "CASA Ratio", 0, 4580, 400, 6, 11),
    ("retail_mix", "Retail Mix", 0, 6000, 900, 6, 12),
    ("branches", "Number of Branches", 0, 590000, 1, 6, 13),
]
_LINES = values_sql("metric, label, num, plus, spread, page, r", LINES)
_NAMES = values_sql("k, institution, cin", [(i, r[0], dims.CINS.get(r[0], "")) for i, r in enumerate(dims.INSTITUTIONS)])

DOCS = f"""(SELECT c_custkey AS doc_id, substr('bsnha', CAST(1 + c_nationkey % 5 AS INTEGER), 1) AS kind, CAST(2020 + c_custkey % 4 AS INTEGER) AS fy, CAST(round(abs(c_acctbal) * 100) AS BIGINT) AS cents,
  COALESCE(institution, 'Rural Finance ' || CAST(c_custkey AS STRING) || ' Limited') AS name, COALESCE(cin, '') AS cin, CASE c_custkey % 3 WHEN 0 THEN '(₹ in crore)' WHEN 1 THEN '(₹ in lakh)' ELSE '(₹ in million)' END AS caption, CASE c_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 100 ELSE 10 END AS units
FROM {{customer}} LEFT JOIN {_NAMES} ON k = c_custkey % 37)"""

#: (doc_id, kind, fy, metric, value, prior, confidence, and what is printed)
VALUES = f"""(SELECT doc_id, kind, fy, metric, label, page, r, caption, units, num, CAST(floor(whole) AS DOUBLE) / 100 AS value, CAST(floor(whole * (80 + doc_id % 20) / 100) AS DOUBLE) / 100 AS prior, CAST(55 + (doc_id * 7 + r * 13 + page) % 46 AS DOUBLE) AS confidence
FROM (SELECT d.*, t.*, CASE WHEN num > 0 THEN CAST(floor((1000000 + cents) * num / 1000) AS BIGINT) * CASE WHEN metric = 'nnpa_amount' AND doc_id % 7 = 3 THEN 10 WHEN metric = 'total_deposits' AND doc_id % 7 = 5 THEN 2 WHEN metric = 'interest_expended' AND doc_id % 11 = 4 THEN 3 ELSE 1 END
  ELSE plus + cents % spread + CASE WHEN metric = 'cet1' AND doc_id % 7 = 3 THEN 140 WHEN metric = 'pcr' AND doc_id % 7 = 5 THEN 5700 ELSE 0 END END AS whole
  FROM {DOCS} AS d CROSS JOIN {_LINES}) AS w)"""

_SECTION = "CASE page WHEN 6 THEN 'key_ratios' ELSE 'financial_statements' END"
_PRINTED = "CASE WHEN num > 0 THEN {{n}}({0} * units) WHEN metric = 'branches' THEN CAST(CAST({0} AS BIGINT) AS STRING) ELSE {{n}}({0}) END"
#: (doc_id, page, section, table_id, caption, r, c, cell): a table per page, with heads; every fifth report's heads name no year.
CELLS = f"""(SELECT doc_id, page, {_SECTION} AS section, 'p' || CAST(page AS STRING) || '-t0' AS table_id, CASE WHEN page = 6 THEN '' ELSE caption END AS caption, CAST(r AS INTEGER) AS r, CAST(c AS INTEGER) AS c, cell FROM (
  SELECT doc_id, page, caption, r, 0 AS c, label AS cell FROM {VALUES} AS v
  UNION ALL SELECT doc_id, page, caption, r, 1, {_PRINTED.format('value')} FROM {VALUES} AS v
  UNION ALL SELECT doc_id, page, caption, r, 2, {_PRINTED.format('prior')} FROM {VALUES} AS v
  UNION ALL SELECT doc_id, page, caption, 0, 0, 'Particulars' FROM {DOCS} AS d CROSS JOIN (VALUES (2), (3), (4), (6)) AS p(page)
  UNION ALL SELECT doc_id, page, caption, 0, 1, CASE WHEN doc_id % 5 = 4 THEN 'Current' ELSE 'As at March 31, ' || CAST(fy AS STRING) END FROM {DOCS} AS d CROSS JOIN (VALUES (2), (3), (4), (6)) AS p(page)
  UNION ALL SELECT doc_id, page, caption, 0, 2, CASE WHEN doc_id % 5 = 4 THEN 'Previous' ELSE 'As at March 31, ' || CAST(fy - 1 AS STRING) END FROM {DOCS} AS d CROSS JOIN (VALUES (2), (3), (4), (6)) AS p(page)
  UNION ALL SELECT doc_id, 3, caption, 9, 0, 'Total' FROM {DOCS} AS d
  UNION ALL SELECT doc_id, 3, caption, 9, 1, {{n}}(cents * 1.0) FROM {DOCS} AS d
  UNION ALL SELECT doc_id, 4, caption, 9, 0, 'Sundry items' FROM {DOCS} AS d
  UNION ALL SELECT doc_id, 4, caption, 9, 1, CASE WHEN doc_id % 2 = 0 THEN 'nil' ELSE CAST(fy AS STRING) END FROM {DOCS} AS d) AS x)"""

_LINE = "label || ' ' || {n}(value * units) || ' ' || {n}(prior * units)"
#: (doc_id, fy, kind, page, body): cover, statements, a page that goes on, highlights, ratios, prose, the auditors; some covers have no name, some a registered number.
PAGES = f"""(SELECT doc_id, fy, kind, CAST(1 AS INTEGER) AS page, CASE WHEN doc_id % 10 = 7 THEN 'A year of growth' ELSE name END || chr(10) || 'Annual Report ' || CAST(fy - 1 AS STRING) || '-' || CAST(fy % 100 AS STRING) || CASE WHEN doc_id % 4 = 3 AND cin <> '' THEN chr(10) || 'CIN: ' || cin ELSE '' END AS body FROM {DOCS} AS d
  UNION ALL SELECT doc_id, fy, kind, 8, 'Independent Auditors Report' || chr(10) || 'To the Members of ' || name || chr(10) || 'We have audited the standalone financial statements of ' || name || ' for ' || CAST(fy AS STRING) || chr(10) || 'Balance Sheet of Reserve Bank of India' || chr(10) || CASE kind WHEN 'n' THEN 'NBFC, a non-banking financial company' WHEN 'a' THEN 'All-India financial institution, an all india financial institution' ELSE 'Banking Regulation Act, Banking Regulation Act, Banking Regulation Act' END FROM {DOCS} AS d WHERE doc_id % 3 <> 0
  UNION ALL SELECT doc_id, fy, kind, 9, 'Consolidated Balance Sheet as at March 31, ' || CAST(fy AS STRING) || chr(10) || caption FROM {DOCS} AS d WHERE doc_id % 6 = 0
  UNION ALL SELECT doc_id, fy, kind, 2, 'Balance Sheet as at March 31, ' || CAST(fy AS STRING) || chr(10) || caption || chr(10) || {_LINE} FROM {VALUES} AS v WHERE metric = 'total_assets'
  UNION ALL SELECT doc_id, fy, kind, 3, 'Profit and Loss Account' || chr(10) || caption || chr(10) || {_LINE} FROM {VALUES} AS v WHERE metric = 'interest_earned'
  UNION ALL SELECT doc_id, fy, kind, 4, {_LINE} FROM {VALUES} AS v WHERE metric = 'gnpa_amount'
  UNION ALL SELECT doc_id, fy, kind, 5, 'Financial Highlights' || chr(10) || caption FROM {DOCS} AS d
  UNION ALL SELECT doc_id, fy, kind, 6, 'Key Ratios' FROM {DOCS} AS d
  UNION ALL SELECT doc_id, fy, kind, 7, 'our profit after tax crossed ' || {{n}}(value) || ' crore' || chr(10) || 'a good year of our people, to ' || CASE WHEN doc_id % 4 = 1 THEN 'FY' || CAST(fy - 1 AS STRING) ELSE 'March 31, ' || CAST(fy AS STRING) END FROM {VALUES} AS v WHERE metric = 'pat')"""


def oracle(relation: str) -> str:
    """The relation for the oracle."""
    return relation.replace("{customer}", "customer").replace("{n}(", "printf('%,.2f', ").replace("AS STRING", "AS VARCHAR")


def _made(spark: SparkSession, sf_dir: str, relation: str) -> DataFrame:
    # the number format takes its places last in Spark: its calls are closed by the first bracket at their own depth
    text, out, i = relation, [], 0
    while (at := text.find("{n}(", i)) >= 0:
        depth, j = 1, at + 4
        while depth:
            depth += {"(": 1, ")": -1}.get(text[j], 0)
            j += 1
        out.append(f"{text[i:at]}format_number({text[at + 4 : j - 1]}, 2)")
        i = j
    # one small file is one task: customers are dealt out by key, so that all cores make reports and what is keyed by document moves no more
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    return spark.sql(f"SELECT * FROM {''.join(out)}{text[i:]} AS relation", customer=customer)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, DOCS)


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, VALUES)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, CELLS)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, PAGES)


DOCS_SQL, VALUES_SQL, CELLS_SQL, PAGES_SQL = (oracle(x) for x in (DOCS, VALUES, CELLS, PAGES))
