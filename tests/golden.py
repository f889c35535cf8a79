"""A small annual report, parsed: the golden case of the page pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.sources.tables import inline

CAPTION = "(₹ in crore)"
#: Page, section, head of the table, and its rows (label, this year, last year).
TABLES = [
    (2, "financial_statements", ("Particulars", "As at March 31, 2023", "As at March 31, 2022"), [("Capital", "1,396.78", "1,389.97"), ("Deposits", "11,80,840.70", "10,64,571.61"), ("Advances", "10,19,638.31", "8,59,020.44"), ("TOTAL ASSETS", "15,84,206.65", "14,11,297.74"), ("Net Worth", "2,04,000.00", "1,73,000.00")]),
    (3, "financial_statements", ("Particulars", "Year ended March 31, 2023", "Year ended March 31, 2022"), [("Interest earned", "1,09,231.34", "86,374.55"), ("Interest expended", "47,102.74", "41,166.66"), ("Other income", "19,883.14", "16,966.11"), ("Operating expenses", "32,873.24", "26,733.32"), ("Payments to and provisions for employees", "12,376.11", "9,672.87"), ("Provisions and contingencies", "16,667.11", "13,974.16"), ("Profit after tax", "31,896.50", "23,339.49")]),
    (4, "financial_statements", ("Particulars", "March 31, 2023", "March 31, 2022"), [("Net Interest Income", "62,129.00", "47,466.10"), ("Interest Earned", "1,09,231.34", "86,374.55"), ("Interest Expended", "47,102.74", "41,166.66"), ("Gross NPA", "31,183.70", "33,919.52"), ("Net NPA", "5,155.07", "6,960.89"), ("Provision Coverage Ratio", "82.86", "79.48")]),
    (5, "financial_highlights", ("Particulars", "FY2023", "FY2022"), [("Total Assets", "15,84,206.65", "14,11,297.74"), ("Total Deposits", "11,80,840.70", "10,64,571.61"), ("Gross Advances", "10,19,638.31", "8,59,020.44"), ("Interest Earned", "1,09,231.34", "86,374.55"), ("Interest Expended", "47,102.74", "41,166.66"), ("Net Interest Income", "62,129.00", "47,466.10"), ("Profit After Tax", "31,896.50", "23,339.49"), ("Net Worth", "2,04,000.00", "1,73,000.00"), ("Gross NPA Ratio", "2.81", "3.60"), ("Net NPA Ratio", "0.48", "0.76"), ("CASA Ratio", "45.80", "48.70"), ("Capital Adequacy Ratio", "18.34", "19.16"), ("Tier 1 Capital Ratio", "17.60", "17.60"), ("Number of Branches", "5900", "5418"), ("Number of Employees", "129020", "105844")]),
    (6, "key_ratios", ("Particulars", "March 31, 2023", "March 31, 2022"), [("Common Equity Tier 1 Ratio", "17.60", "17.60"), ("Tier 1 Capital Ratio", "17.60", "17.60"), ("Tier 2 Capital Ratio", "0.74", "1.55"), ("Total Capital Ratio", "18.34", "19.16"), ("Gross NPA Ratio", "2.81", "3.60")]),
]
#: Page and text.
PAGES = [
    (1, "ICICI Bank Limited\nAnnual Report 2022-23\nCIN: L65190GJ1994PLC021012"),
    (2, "Balance Sheet as at March 31, 2023\n(₹ in crore)\nCapital 1,396.78 1,389.97\nDeposits 11,80,840.70 10,64,571.61"),
    (3, "Profit and Loss Account\n(₹ in crore)\nInterest earned 1,09,231.34 86,374.55"),
    (4, "Schedule 18 Notes to accounts\n(₹ in crore)\nNet Interest Income 62,129.00 47,466.10"),
    (5, "Financial Highlights\n(₹ in crore)"),
    (6, "Key Ratios"),
    (7, "our profit after tax crossed 30,000 crore\nCASA ratio stood at 45.8% as at March 31, 2023"),
]


def cell_rows() -> list[tuple]:
    out = []
    for page, section, head, rows in TABLES:
        for r, row in enumerate([head, *rows]):
            out += [(page, section, f"p{page}-t0", CAPTION if page != 6 else "", r, c, text) for c, text in enumerate(row)]
    return out


def cells(spark: SparkSession) -> DataFrame:
    """(doc_id, page, section, table_id, caption, r, c, cell)."""
    return inline(spark, "doc_id, page, section, table_id, caption, r, c, cell", [(1, *r) for r in cell_rows()])


def docs(spark: SparkSession) -> DataFrame:
    return inline(spark, "doc_id, kind, fy", [(1, "b", 2023)])


def pages(spark: SparkSession) -> DataFrame:
    return inline(spark, "doc_id, page, body", [(1, *r) for r in PAGES])
