"""Queries of the scalar functions, on inline cases; the SQL states what each case must give."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.functions import fiscal, numbers, text
from marlstone.plans import dims
from marlstone.plans.dims import METRICS
from marlstone.sources import reports
from marlstone.sources.tables import inline, table, values_sql


def cases(columns: str, rows: list[tuple], result: str, f, kind: str):
    """A query that applies f to the inputs of rows (their last field is the expected result), and the SQL of the expected rows."""
    names = columns.split(", ")
    given = [r[:-1] for r in rows]
    query = lambda s, d: inline(s, columns, given).select(*names, f(*(F.col(c) for c in names)).alias(result))
    # null-only columns get their type here
    sql = f"SELECT {columns}, CAST({result} AS {kind}) AS {result} FROM {values_sql(f'{columns}, {result}', rows)}"
    return query, sql


D, S, B, I = "DOUBLE", "VARCHAR", "BOOLEAN", "INTEGER"
NUMBERS = [("1,36,882.10", 136882.1), ("1,368,821", 1368821.0), ("(1,234)", -1234.0), ("−1,234", -1234.0), ("–1,234", -1234.0), ("₹ (1,234) crore", -1234.0), ("1234*", 1234.0), ("1234#", 1234.0), ("1234†", 1234.0), ("1234¹", 1234.0), ("1234^", 1234.0), ("3,19", 3.19), ("3.19%", 3.19), ("Particulars", None), ("CRISIL AAA/Stable", None), ("", None), ("-", None), ("--", None), ("NIL", None), ("N/A", None), ("Not disclosed", None), ("Rs. 12,345 lakh", 12345.0), ("1..5", 1.5)]
AMOUNTS = [("₹ 12,345 crore", "", 12345.0), ("12,345 million", "", 1234.5), ("12 billion", "", 1200.0), ("1,00,000 lakh", "", 1000.0), ("1.5 lakh crore", "", 150000.0), ("12,345", "(₹ in million)", 1234.5), ("12,345", "", 12345.0)]
PAIRS = [(70901.0, 70910.0), (70901.0, 71901.0), (0.0, 0.0), (2.81, 2.815), (100.0, 100.6), (-5.0, 5.0)]
_PAIRS = values_sql("a, b", PAIRS)

#: Cases by hand of what the queries below run over tables.
FIXTURES = {
    "num_parse_pkg": cases("cell", NUMBERS, "value", numbers.parse_number, D),
    "num_parse_single": cases("cell", [("1,09,231.34", 109231.34), ("(1,234)", -1234.0), ("3,19", 319.0), ("2.81%", 2.81), ("nil", None), ("-", None), ("abc", None), ("12 crore", None)], "value", numbers.parse_number_single, D),
    "nil_tokens": cases("cell", [("", True), ("-", True), ("--", True), ("NIL", True), ("N/A", True), ("n.a.", True), ("Not disclosed", True), ("0", False), ("12", False), ("none", False)], "nil", numbers.is_nil, B),
    "scale_detect_pkg": cases("caption", [("(₹ in crore)", "crore"), ("₹ in lakhs", "lakh"), ("in '000s", "thousand"), ("1,00,000", None), ("₹ lakh crore", "lakh crore"), ("USD million", "million"), ("Rs. bn", "billion"), ("in rupees", "rupee"), ("nothing", None)], "scale", numbers.scale_name, S),
    "scale_detect_single": cases("caption", [("over 50 million customers.", None), ("Balance Sheet (₹ in million)", "million"), ("(USD million)", "million"), ("₹ in crore", "crore"), ("crore of rupees", None)], "scale", numbers.caption_scale, S),
    "foreign_currency": cases("caption", [("(USD million)", True), ("(₹ in crore)", False), ("US $ in mn", True), ("EUR", True), ("", False)], "is_foreign", numbers.is_foreign, B),
    "amount_to_crore": cases("cell, context", AMOUNTS, "crore", numbers.to_crore, D),
    "missing_decimal": cases("v, low, high", [(319.0, 0.0, 15.0, True), (3.19, 0.0, 15.0, False), (5000.0, 0.0, 15.0, False), (12.0, 0.0, 15.0, False)], "lacks", numbers.lacks_decimal, B),
    "value_signature": cases("v", [(62129.0, "62129"), (2.81, "2.81"), (1234567890.5, "1234567890.5"), (0.0, "0"), (17.6, "17.6"), (-5.125, "-5.125")], "sig", numbers.signature, S),
    "digits_only": cases("cell", [("₹ 1,23.4", "1234"), ("none", ""), ("FY22-23", "2223")], "digits", numbers.digits_only, S),
    "report_number": cases("raw", [("₹6,589 crore", 6589.0), ("45.00%", 45.0), ("1.04 Lakh", 1.04), ("5.90 Crore", 5.9), ("5,865", 5865.0), ("ND", None), ("Not Found", None)], "number", lambda c: numbers.report_value(c)["number"], D),
    "report_kv_normalise": cases("raw", [("₹6,589 crore", "crore"), ("45.00%", "percent"), ("1.04 Lakh", "lakh"), ("5,865", "plain"), ("ND", None)], "unit", lambda c: numbers.report_value(c)["unit"], S),
    "name_key": cases("name", [("State Bank of India (SBI)", "state bank of india sbi"), ("ICICI Bank Ltd.", "icici bank"), ("ICICI Bank Limited", "icici bank"), ("L&T Finance Holdings Limited", "l&t finance holdings")], "k", text.name_key, S),
    "tidy_name": cases("name", [("STATE BANK OF INDIA", "State Bank of India"), ("HDFC Bank Limited", "HDFC Bank Limited"), ("  Axis   Bank ", "Axis Bank")], "tidy", text.tidy_name, S),
    "clean_label": cases("label", [("i)  Interest earned (Schedule 13)", "interest earned"), ("Net Interest Margin (%)", "net interest margin"), ("2. Deposits *", "deposits"), ("CASA (%)", "casa"), ("11 Total assets (9) + (10)", "total assets"), ("अन्य व्यय / Other expenditure", "other expenditure"), ("Deposits (Global)", "deposits"), ("Tier 2", "tier 2")], "cleaned", text.clean_label, S),
    "partial_ratio": cases("a, b", [("net worth", "total net worth", 100.0), ("abc", "xyz", 0.0), ("abcd", "xxabzdxx", 75.0), ("", "abc", 0.0)], "ratio", text.partial_ratio, D),
    "token_set_ratio": cases("a, b", [("icici bank", "bank icici", 100.0), ("kotak mahindra bank limited", "kotak mahindra bank", 100.0), ("a", "b", 0.0)], "ratio", text.token_set_ratio, D),
    "sequence_ratio": cases("a, b", [("abcd", "abcd", 1.0), ("abcd", "bcde", 0.75), ("abc", "xyz", 0.0)], "ratio", text.sequence_ratio, D),
    "nfkc": cases("raw", [("ﬁnance", "finance"), ("Ａ１", "A1"), ("plain", "plain")], "normal", text.nfkc, S),
    "safe_filename": cases("name", [("ICICI Bank: FY22/23", "ICICI_Bank_FY22_23"), ("a.b-c", "a.b-c")], "file", text.safe_filename, S),
    "first_line": cases("line", [("hello\nworld", "hello"), ("hello", "hello")], "head", text.first_line, S),
    "fy_label": cases("y", [(2023, "FY22-23"), (2000, "FY99-00"), (2010, "FY09-10")], "label", fiscal.fy_label, S),
    "fy_end": cases("label", [("FY22-23", 2023), ("FY99-00", 2000), ("FY09-10", 2010)], "y", fiscal.fy_end, I),
    "token_end_year": cases("token", [("2022-23", 2023), ("2023", 2023), ("FY2023", 2023), ("FY23", 2023), ("31.03.2023", 2023), ("Mar-23", 2023), ("Deposits", None)], "y", fiscal.token_end, I),
    "end_years": cases("line", [("As at March 31, 2023 and 31st March 2022", "2023,2022"), ("Annual Report 2022-23", "2023"), ("FY2021", "2021"), ("in 1789", "")], "years", lambda c: F.array_join(fiscal.end_years(c), ","), S),
    "year_tokens": cases("y, token", [(2023, "2022-23", True), (2023, "march31,2023", True), (2023, "fy23", True), (2023, "2021-22", False)], "has", lambda y, t: F.array_contains(fiscal.year_tokens(y), t), B),
    "same_value_pairs": (
        lambda s, d: inline(s, "a, b", PAIRS).select("a", "b", numbers.same_value(F.col("a"), F.col("b")).alias("same"), numbers.close_to(F.col("a"), F.col("b")).alias("close")),
        f"SELECT a, b, greatest(abs(a), abs(b)) = 0 OR abs(a - b) <= 0.005 * greatest(abs(a), abs(b)) AS same, abs(a - b) <= greatest(CAST(0.01 AS DOUBLE), 0.005 * abs(a)) AS close FROM {_PAIRS}",
    ),
    "safe_div": (
        lambda s, d: inline(s, "a, b", PAIRS).select("a", "b", numbers.safe_div(F.col("a"), F.col("b")).alias("q")),
        f"SELECT a, b, CASE WHEN b <> 0 THEN a / b END AS q FROM {_PAIRS}",
    ),
    "format_thousands": (
        lambda s, d: inline(s, "a, b", PAIRS).select("a", F.format_number("a", 2).alias("shown")),
        f"SELECT a, printf('%,.2f', a) AS shown FROM {_PAIRS}",
    ),
}


_V, _C, _D = (f"{x} AS x" for x in (reports.VALUES_SQL, reports.CELLS_SQL, reports.DOCS_SQL))
_KEY = ("doc_id", "metric")


def _printed(s, d):
    return reports.cells(s, d).where("r > 0 and c > 0")


_AT = ("doc_id", "page", "r", "c")
_RANGE = values_sql("metric, low, high", [(m[0], m[6], m[7]) for m in METRICS if m[6] is not None]).replace(" t(", " g(")

#: The same functions over the reports' cells, values and names.
OVER_TABLES = {
    "num_parse_pkg": (lambda s, d: _printed(s, d).select(*_AT, numbers.parse_number(F.col("cell")).alias("value")), f"SELECT doc_id, page, r, c, TRY_CAST(replace(cell, ',', '') AS DOUBLE) AS value FROM {_C} WHERE r > 0 AND c > 0"),
    "num_parse_single": (lambda s, d: _printed(s, d).select(*_AT, numbers.parse_number_single(F.col("cell")).alias("value")), f"SELECT doc_id, page, r, c, TRY_CAST(replace(cell, ',', '') AS DOUBLE) AS value FROM {_C} WHERE r > 0 AND c > 0"),
    "nil_tokens": (lambda s, d: _printed(s, d).select(*_AT, numbers.is_nil(F.col("cell")).alias("nil")), f"SELECT doc_id, page, r, c, cell = 'nil' AS nil FROM {_C} WHERE r > 0 AND c > 0"),
    "scale_detect_pkg": (lambda s, d: reports.docs(s, d).select("doc_id", numbers.scale_name(F.col("caption")).alias("scale")), f"SELECT doc_id, regexp_extract(caption, 'in ([a-z]+)', 1) AS scale FROM {_D}"),
    "scale_detect_single": (lambda s, d: reports.pages(s, d).select("doc_id", "page", numbers.caption_scale(F.col("body")).alias("scale")), f"SELECT doc_id, page, nullif(regexp_extract(body, '[(]₹ in ([a-z]+)[)]', 1), '') AS scale FROM {reports.PAGES_SQL} AS x"),
    "amount_to_crore": (lambda s, d: _printed(s, d).where("page < 6").select(*_AT, numbers.to_crore(F.col("cell"), F.col("caption")).alias("crore")), f"SELECT doc_id, page, r, c, ROUND(TRY_CAST(replace(cell, ',', '') AS DOUBLE) * CASE WHEN contains(caption, 'lakh') THEN CAST(0.01 AS DOUBLE) WHEN contains(caption, 'million') THEN CAST(0.1 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END, 6) AS crore FROM {_C} WHERE r > 0 AND c > 0 AND page < 6"),
    "missing_decimal": (lambda s, d: reports.values(s, d).join(F.broadcast(dims.metrics(s).where("low is not null").select("metric", "low", "high")), "metric").select(*_KEY, numbers.lacks_decimal(F.col("value") * 100, F.col("low"), F.col("high")).alias("lacks")), f"SELECT doc_id, metric, NOT value * 100 BETWEEN low AND high AND value * 100 / 100 BETWEEN low AND high AS lacks FROM {_V} JOIN {_RANGE} USING (metric)"),
    "value_signature": (lambda s, d: reports.values(s, d).select(*_KEY, numbers.signature(F.col("value")).alias("sig")), f"SELECT doc_id, metric, regexp_replace(regexp_replace(CAST(CAST(value AS DECIMAL(28,4)) AS VARCHAR), '0+$', ''), '[.]$', '') AS sig FROM {_V}"),
    "digits_only": (lambda s, d: _printed(s, d).select(*_AT, numbers.digits_only(F.col("cell")).alias("digits")), f"SELECT doc_id, page, r, c, regexp_replace(cell, '[^0-9]', '', 'g') AS digits FROM {_C} WHERE r > 0 AND c > 0"),
    "name_key": (lambda s, d: reports.docs(s, d).select("doc_id", text.name_key(F.col("name")).alias("k")), f"SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(name), '[^a-z0-9& ]', ' ', 'g'), '\\b(limited|ltd|pvt|private|corporation|corp|inc|the)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS k FROM {_D}"),
    "safe_filename": (lambda s, d: reports.docs(s, d).select("doc_id", text.safe_filename(F.col("name")).alias("file")), f"SELECT doc_id, regexp_replace(name, '[^A-Za-z0-9._-]+', '_', 'g') AS file FROM {_D}"),
    "first_line": (lambda s, d: table(s, d, "documents").select("doc_id", text.first_line(F.col("text")).alias("head")), "SELECT doc_id, string_split(text, chr(10))[1] AS head FROM documents"),
    "fy_label": (lambda s, d: reports.docs(s, d).select("doc_id", fiscal.fy_label(F.col("fy")).alias("label")), f"SELECT doc_id, printf('FY%02d-%02d', (fy - 1) % 100, fy % 100) AS label FROM {_D}"),
    "fy_end": (lambda s, d: reports.docs(s, d).select("doc_id", fiscal.fy_end(fiscal.fy_label(F.col("fy"))).alias("y")), f"SELECT doc_id, fy AS y FROM {_D}"),
    "same_value_pairs": (lambda s, d: reports.values(s, d).select(*_KEY, numbers.same_value(F.col("value"), F.col("prior")).alias("same"), numbers.close_to(F.col("value"), F.col("prior")).alias("close")), f"SELECT doc_id, metric, greatest(abs(value), abs(prior)) = 0 OR abs(value - prior) <= 0.005 * greatest(abs(value), abs(prior)) AS same, abs(value - prior) <= greatest(CAST(0.01 AS DOUBLE), 0.005 * abs(value)) AS close FROM {_V}"),
    "safe_div": (lambda s, d: reports.values(s, d).select(*_KEY, numbers.safe_div(F.col("prior"), F.col("value") * (F.col("doc_id") % 3)).alias("q")), f"SELECT doc_id, metric, CASE WHEN value * (doc_id % 3) <> 0 THEN prior / (value * (doc_id % 3)) END AS q FROM {_V}"),
    "format_thousands": (lambda s, d: reports.values(s, d).select(*_KEY, F.format_number("value", 2).alias("shown")), f"SELECT doc_id, metric, printf('%,.2f', value) AS shown FROM {_V}"),
}
QUERIES = FIXTURES | OVER_TABLES
