"""Facts that hold for any input: permutation, round trips, identities of the book, both rule profiles, the stream."""

from __future__ import annotations

import random
import re
import time

import golden
import pytest
from pyspark.sql import functions as F

from marlstone.functions import numbers
from marlstone.operators import book, candidates, checks, output, trial, votes
from marlstone.plans import dims, reporting
from marlstone.sources import tables
from marlstone.streaming import book as live

D = "/root/testdata/sf0.001"


def indian(n: int) -> str:
    s = str(n)
    head, tail = s[:-3], s[-3:]
    parts = []
    while len(head) > 2:
        parts.insert(0, head[-2:])
        head = head[:-2]
    return ",".join([x for x in [head, *parts] if x] + [tail])


def test_indian_grouping_round_trip(spark):
    r = random.Random(3)
    rows = [(indian(n), float(n)) for n in (r.randrange(1000, 10**12) for _ in range(200))]
    got = tables.inline(spark, "cell, n", rows).where(~F.col("n").eqNullSafe(numbers.parse_number(F.col("cell")))).collect()
    assert got == []


POOL = "doc_id, metric, fy, low, high, " + trial.COLUMNS
#: A pool for total assets with a wrong year, a wrong unit, another metric's number and prose in it.
ROWS = [
    (1, "total_assets", 2023, 100.0, 9e7, 1, 1584207.0, 120, "financial_statements", "financial_highlights|multi_year_summary", 2, 2023, True, True, False, False, True, True, 100.0, True, "t1", 1),
    (1, "total_assets", 2023, 100.0, 9e7, 2, 1411297.74, 120, "financial_statements", "", 1, 2022, True, True, False, False, True, True, 100.0, True, "t1", 2),
    (1, "total_assets", 2023, 100.0, 9e7, 3, 15842070000.0, 121, "financial_statements", "", 1, 2023, True, False, False, True, True, True, 100.0, True, "t2", 1),
    (1, "total_assets", 2023, 100.0, 9e7, 4, 204000.0, 120, "financial_statements", "", 1, 2023, True, True, False, False, True, False, 61.0, True, "t1", 1),
    (1, "total_assets", 2023, 100.0, 9e7, 5, 1600000.0, 7, "narrative", "", 1, None, False, False, False, True, False, True, 100.0, False, None, 0),
]


def courts(spark, rows):
    return {(r.doc_id, r.metric, r.cid): (r.court, r.place) for r in trial.ranked(trial.trial(tables.inline(spark, POOL, rows))).collect()}


def test_trial_is_permutation_invariant(spark):
    first = courts(spark, ROWS)
    assert first[1, "total_assets", 1][1] == 1
    assert courts(spark, ROWS[::-1]) == first


def test_metrics_and_documents_do_not_touch_each_other(spark):
    """A second metric of the document, and a second document, change nothing."""
    alone = courts(spark, ROWS)
    other = [(1, "net_worth", 2023, 1.0, 5e6, *r[5:6], r[6] * 0.13, *r[7:]) for r in ROWS] + [(2, *r[1:5], r[5], r[6] * 3, *r[7:]) for r in ROWS]
    both = courts(spark, ROWS + other)
    assert {k: v for k, v in both.items() if k[:2] == (1, "total_assets")} == alone
    assert {k[:2] for k, v in both.items() if v[1] == 1} == {(1, "total_assets"), (1, "net_worth"), (2, "total_assets")}


def test_dimensions(spark):
    assert dims.metrics(spark).count() == 52
    assert dims.aliases(spark).count() == 197
    assert dims.institutions(spark).count() == 36


def test_report_winners(spark):
    """The printed values of the golden report come out of its tables."""
    found = {(r.metric, round(r.value, 2)) for r in candidates.from_tables(golden.cells(spark), golden.docs(spark), golden.pages(spark)).where("y = 2023").collect()}
    for metric, value in [("total_assets", 1584206.65), ("total_deposits", 1180840.7), ("nii", 62129.0), ("pat", 31896.5), ("gnpa_ratio", 2.81), ("crar", 18.34)]:
        assert (metric, value) in found
    assert golden.cells(spark).where("page = 6").count() == 18


@pytest.mark.parametrize(("profile", "n"), [(dims.DOCUMENTED, 0), (dims.SHIPPED, 1)])
def test_derivation_floor_is_a_parameter(spark, profile, n):
    v = tables.inline(spark, "doc_id, metric, value, confidence", [(1, "interest_earned", 109231.34, 70.0), (1, "interest_expended", 47102.74, 70.0)])
    assert checks.derived(v, profile=profile).count() == n


def test_write_floor(spark):
    v = tables.inline(spark, "doc_id, metric, value, confidence", [(1, "nii", 1.0, 55.0)])
    by = lambda p: output.cells(v, golden.docs(spark), "doc_id", p).where("metric = 'nii'").first().sentinel
    assert by(dims.DOCUMENTED) == "ND"
    assert by(dims.SHIPPED) is None


def test_pnl_is_now_minus_then(spark):
    b = book.book(spark, D)
    one = {tuple(r)[:3]: round(r.pnl, 4) for r in book.pnl_since(b, 300).collect()}
    two = {tuple(r)[:3]: round(r.pnl, 4) for r in book.pnl_full_join(b, 300).collect()}
    assert one == two


def test_as_of_is_last_running_row(spark):
    b = book.book(spark, D)
    runs = book.running(book.as_of(b, 400)).groupBy(*book.KEYS).agg(F.max_by("position", "event_id").alias("position"))
    assert {tuple(r) for r in runs.collect()} == {tuple(r)[:4] for r in book.positions(book.as_of(b, 400)).select(*book.KEYS, "position").collect()}


def test_unknown_bond_goes_to_quarantine(spark):
    tape = book.trades(spark, D)
    terms = book.bonds(spark, D).where("bond_id <> 7")
    assert book.priced(tape, terms).count() + book.quarantine(tape, terms).count() == tape.count()


def test_stream_equals_batch(spark, tmp_path):
    tape, terms = book.trades(spark, D), book.bonds(spark, D)
    tape.repartition(3).write.parquet(f"{tmp_path}/tape")
    q = live.live_positions(live.trade_stream(spark, f"{tmp_path}/tape", tape.schema), terms).writeStream.format("memory").queryName("live_book").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/state").start()
    q.awaitTermination(120)
    got = {tuple(r)[:4] for r in spark.table("live_book").collect()}
    assert got == {tuple(r)[:4] for r in book.positions(book.book(spark, D)).collect()}


def test_csv_discovery_and_cache(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.csv").write_text("Metric,Value\nNII,1\n")
    (tmp_path / "y.csv").write_text("Metric,Value\nNII,1\n")
    assert tables.read_csv(spark, str(tmp_path)).count() == 2
    found = tables.discover(spark, str(tmp_path), "*.csv")
    assert found.count() == 1  # equal content counts once
    assert tables.new_files(found, found).count() == 0


def test_sheets_by_year(spark, tmp_path):
    v = tables.inline(spark, "inst, fy, metric, value", [("A", "FY22-23", "nii", 1.0), ("A", "FY21-22", "nii", 2.0)])
    output.write_sheets(v, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").where("fy = 'FY22-23'").count() == 1


def two_reports(spark):
    """The golden report twice: once as it is, once under another id with all amounts of its tables ten times as large."""
    cells, pages = golden.cells(spark), golden.pages(spark)
    big = cells.withColumn("doc_id", F.lit(2)).withColumn("caption", F.when(F.col("caption") != "", "(₹ in billion)").otherwise(""))
    return pages.union(pages.withColumn("doc_id", F.lit(2))), cells.unionByName(big), golden.docs(spark).union(golden.docs(spark).withColumn("doc_id", F.lit(2)))


def test_each_document_has_its_own_winners(spark):
    pages, cells, docs = two_reports(spark)
    win = {(r.doc_id, r.metric): r.value for r in reporting.winners(reporting.pool(pages, cells, docs)).collect()}
    for metric, value in [("total_assets", 1584206.65), ("total_deposits", 1180840.7), ("nii", 62129.0), ("pat", 31896.5)]:
        assert win[1, metric] == pytest.approx(value)
        assert win[2, metric] == pytest.approx(value * 100) or win[2, metric] <= 9e7
    assert win[2, "nii"] == pytest.approx(6212900.0) or win[2, "nii"] == pytest.approx(62129.0)
    assert win[1, "gnpa_ratio"] == win[2, "gnpa_ratio"] == pytest.approx(2.81)


def test_golden_documents(spark):
    (r,) = reporting.documents(golden.pages(spark)).collect()
    assert (r.institution, r.kind, r.fy, r.identified) == ("ICICI Bank Limited", "b", 2023, 100.0)


def test_institutions_by_number_name_and_slip(spark):
    rows = [(1, 1, "a report\nCIN: L65920MH1994PLC080618"), (2, 1, "Axis Bank Limited\nAnnual Report"), (3, 1, "Cholamandalam Investment and Finanse Company"), (4, 1, "Lakeside Finance Limited\n2023"), (5, 1, "x\nabc"), (6, 1, "the notes"), (6, 2, "To the members of Canara Bank")]
    got = {r.doc_id: (r.institution, r.type, r.confidence) for r in candidates.identified(tables.inline(spark, "doc_id, page, body", rows), ["doc_id"]).collect()}
    assert got[1] == ("HDFC Bank Limited", "bank", 100.0)
    assert got[2][0] == "Axis Bank Limited"
    assert got[3][0] == "Cholamandalam Investment and Finance Company Limited" and got[3][2] < 75
    assert got[4] == ("Lakeside Finance Limited", "nbfc", 0.0)
    assert got[5][0] == "unknown"
    assert got[6][0] == "Canara Bank"


def test_slips_are_found_at_the_end_of_long_texts(spark):
    slip, prose = "Punjab National Banc", "our people had a good year " * 4000
    six = lambda doc: [(doc, n, "Annual Report") for n in range(1, 7)]
    rows = [(1, 1, f"{prose[:2700]}{slip}"), (2, 1, f"{prose[:3996]}{slip}"), (3, 1, f"{prose}\n{slip}"), *six(4), (4, 7, f"To the members of us\n{prose}\n{slip}"), *six(5), (5, 7, f"Notes\n{prose}{slip}"), *six(6), (6, 7, prose)]
    got = {r.doc_id: (r.institution, r.confidence) for r in candidates.identified(tables.inline(spark, "doc_id, page, body", rows), ["doc_id"]).collect()}
    assert got == {**{i: ("Punjab National Bank", c) for i, c in ((1, 71.25), (2, 71.25), (3, 71.25), (4, 64.125), (5, 49.875))}, 6: ("Annual Report", 0.0)}


def test_bare_totals_and_foreign_tables(spark):
    rows = [("", 0, 0, "Particulars"), ("", 0, 1, "March 31, 2023"), ("", 1, 0, "Grand Total"), ("", 1, 1, "5,000"), ("", 2, 0, "Total Assets"), ("", 2, 1, "9,000"), ("", 3, 0, "Net Profit"), ("", 3, 1, "70")]
    cells = lambda caption: tables.inline(spark, "doc_id, page, section, table_id, caption, r, c, cell", [(1, 2, "financial_statements", "t", caption, *x[1:]) for x in rows])
    got = {(r.metric, r.value, r.is_foreign) for r in candidates.from_tables(cells("(₹ in crore)"), golden.docs(spark)).collect()}
    assert got == {("total_assets", 9000.0, False), ("pat", 70.0, False)}
    assert all(r.is_foreign for r in candidates.from_tables(cells("(USD million)"), golden.docs(spark)).collect())
    assert candidates.from_tables(cells("(USD million)"), golden.docs(spark), drop_foreign=True).count() == 0


def test_scale_by_caption_rows_and_page(spark):
    row = lambda t, caption, head: [(1, t, "x", f"t{t}", caption, 0, 0, head), (1, t, "x", f"t{t}", caption, 1, 0, "Deposits")]
    cells = tables.inline(spark, "doc_id, page, section, table_id, caption, r, c, cell", [*row(1, "(₹ in lakh)", "₹ in million"), *row(2, "", "₹ in million"), *row(3, "", "x"), *row(4, "", "USD"), *row(5, "", "y")])
    pages = tables.inline(spark, "doc_id, page, body", [(1, p, "amounts (₹ in thousand)" if p < 5 else "z") for p in range(1, 6)])
    got = {r.page: (r.scale, r.foreign) for r in candidates.table_scales(cells, pages, ["doc_id"]).collect()}
    assert got == {1: ("lakh", False), 2: ("million", False), 3: ("thousand", False), 4: (None, True), 5: (None, False)}


def test_serial_numbers_run_on(spark):
    known = tables.inline(spark, "sr_no, institution", [(1, "HDFC"), (4, "Axis")])
    rows = tables.inline(spark, "institution", [("Zeta",), ("Alpha",), ("HDFC",), *((f"N{i:03d}",) for i in range(50))])
    got = {r.institution: r.sr_no for r in output.numbered(rows, known).collect()}
    fresh = sorted(set(got) - {"HDFC", "Axis"})
    assert [got[x] for x in fresh] == list(range(5, 57)) and got["Axis"] == 4


def test_entity_names_leave_out_regulators(spark):
    rows = [(1, 1, "To the Members of Lakeside Bank Limited\nBalance Sheet of Reserve Bank of India"), (1, 2, "we have audited the accounts of LAKESIDE BANK LTD"), (2, 1, "no hint at all")]
    got = votes.name_votes(votes.entity_names(tables.inline(spark, "doc_id, page, body", rows), ["doc_id"]), ["doc_id"]).collect()
    assert [(r.doc_id, r.name, r.confidence) for r in got] == [(1, "Lakeside Bank Limited", 1.0)]
    names = tables.inline(spark, "p", [("/a/b/Bank_of_India_FY2021-22.pdf",), ("LAKESIDE-FINANCE 2022.pdf",)])
    assert [r[0] for r in names.select(votes.file_name_guess(F.col("p"))).collect()] == ["Bank of India", "Lakeside Finance"]


def test_slips_of_a_document_in_time(spark):
    """Names in many documents of many pages: one pass, and ratios of long words by bits."""
    from marlstone.functions import text

    assert text._ratio("kitten", "sitting") == pytest.approx(200 * 4 / 13) and text._ratio("ab", "ba") == 50.0
    run = text.nearest_run([(7, "canara bank of india")], 95.0)
    rows = [(1, ["of kanara bank of india and", "canara bank of indja"], [0.7, 1.0]), (2, ["reserve bank of india", None], [1.0, 1.0]), (3, None, None)]
    got = {r.id: r.b for r in spark.createDataFrame(rows, "id int, k array<string>, w array<double>").select("id", run("k", "w").alias("b")).collect()}
    assert (got[1].i, got[1].s) == (7, pytest.approx(0.75 * 95.0)) and got[2].i is None and got[3].i is None
    t = time.time()
    assert text.partial("a" * 4000, "b" * 4001) == 0.0 and time.time() - t < 2  # 16 million steps a letter pair at a time


def test_what_an_alias_needs_is_in_all_it_matches():
    from marlstone.operators.candidates import needed
    from marlstone.sources.reports import LINES

    labels = [x[1] for x in LINES] + ["TOTAL ASSETS", "deposits", "Non-Interest Income", "write-offs during the year", "GNPA %", "Tier II Capital", "P / E", "CARE AA+", "Shareholders' Funds"]
    for patterns in dims.ALIASES.values():
        for p in patterns:
            assert all(needed(p) in x.lower() for x in labels if re.search(p, x, re.I)), p
    assert needed(r"Gross\s+Loans?\s*(?:and\s+Advances)?") == "gross" and needed(r"\bD/E\b") == "d/e" and needed("(?:a|b)") == ""


def test_years_alone_look_for_no_names(spark):
    """Who asks documents for their years pays for no names, and pages are sorted once."""
    from marlstone.queries import report_years

    plan = report_years(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "Join" not in plan.replace("BroadcastNestedLoopJoin", "").replace("BroadcastHashJoin", "")


def test_votes_for_years(spark):
    """A year's votes add up over a document's pages; the latest of ties wins, and a document without a year is none."""
    rows = [(1, 1, "Annual Report 2021-22"), (1, 2, "Balance Sheet as at March 31, 2023\nand March 31, 2023"), (2, 1, "FY2020 and FY2021"), (3, 1, "no year")]
    got = {r.doc_id: (r.fy, r.fy_confidence) for r in reporting.documents(spark.createDataFrame(rows, "doc_id long, page int, body string")).collect()}
    # document 1: 2022 has 1 + 0.5; 2023 twice 3 + 1 of the body and twice 0.5 of the first two lines
    assert got == {1: (2023, round(9 / 10.5, 4)), 2: (2021, 0.5)}


def test_cells_are_read_once(spark, tmp_path):
    """Labels, years, columns, units and numbers of a table come out of one reading of its cells."""
    golden.cells(spark).write.parquet(str(tmp_path / "cells"))
    found = candidates.from_tables(spark.read.parquet(str(tmp_path / "cells")), golden.docs(spark), golden.pages(spark))
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_columns_of_a_table(spark):
    """A numeric column beside years has none; without heads the first two are this year and last; a lone one is sure; labels may stand behind a number."""
    tables_ = {"named": [["Particulars", "Note", "March 31, 2023", "March 31, 2022"], ["Total Assets", "4", "9,000", "8,000"]], "bare": [["x", "y", "z", "w"], ["Net Worth", "50", "40", "30"]], "lone": [["x", "y"], ["Net Worth", "70"]], "behind": [["No", "x", "y"], ["7", "Net Worth", "60"]]}
    rows = [(1, 2, "financial_statements", t, "(₹ in lakh)", r, c, x) for t, lines in tables_.items() for r, line in enumerate(lines) for c, x in enumerate(line)]
    cells = tables.inline(spark, "doc_id, page, section, table_id, caption, r, c, cell", rows)
    got = {(r.table_id, r.c, r.y, r.resolved, round(r.value, 4)) for r in candidates.from_tables(cells, golden.docs(spark)).collect()}
    assert got == {
        ("named", 1, None, False, 0.04), ("named", 2, 2023, True, 90.0), ("named", 3, 2022, True, 80.0), ("bare", 1, 2023, False, 0.5), ("bare", 2, 2022, False, 0.4), ("bare", 3, None, False, 0.3),
        ("lone", 1, 2023, True, 0.7), ("behind", 0, 2023, False, 0.07), ("behind", 2, 2022, False, 0.6),
    }


def test_many_labels_join(spark, monkeypatch):
    """More matches than are held in a small table give the same rows."""
    rows = lambda: sorted(map(str, candidates.from_tables(golden.cells(spark), golden.docs(spark), golden.pages(spark)).collect()))
    few = rows()
    monkeypatch.setattr(candidates, "HELD", 3)
    assert rows() == few


def test_best_is_first_of_ranked(spark):
    t = trial.trial(tables.inline(spark, POOL, ROWS))
    first = {(r.doc_id, r.metric, r.cid, r.court) for r in trial.ranked(t).where("place = 1").collect()}
    assert {(r.doc_id, r.metric, r.cid, r.court) for r in trial.best(t).collect()} == first


def test_plain_numbers(spark):
    given = {"1,234.50": 1234.5, "12,34": 12.34, "1,23,456": 123456.0, "(5)": -5.0, "7": 7.0, "1,2,3": 123.0, " 1,000 ": 1000.0, "Total": None, "": None, "12,345,6": 123456.0, "0.5": 0.5}
    got = {r.x: r.v for r in spark.createDataFrame([(x,) for x in given], "x string").select("x", numbers.parse_number(F.col("x")).alias("v")).collect()}
    assert got == given


def test_lines_ask_in_one_list(spark):
    """Lines ask for all aliases in one list of constants, not in an expression per pattern."""
    plan = candidates.from_lines(golden.pages(spark), golden.docs(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") < 20  # most are those of the section headings and of numbers; with a pattern each, what is shown of the plan has 36


def test_first_alias_counts(spark):
    """Of several aliases of a metric that match, a line's first with a number gives the value, a label's first the score."""
    rows = [(1, 1, "Gross Advances and Total Advances of 500"), (1, 2, "no number of Total Assets"), (1, 3, "TOTAL ASSETS 7,000 and Total Assets 8,000")]
    got = {(r.page, r.metric, r.value) for r in candidates.from_lines(spark.createDataFrame(rows, "doc_id long, page int, body string"), golden.docs(spark)).where("metric in ('gross_advances', 'total_assets')").collect()}
    assert got == {(1, "gross_advances", 500.0), (3, "total_assets", 7000.0)}
    labels = spark.createDataFrame([("Total Advances",), ("Advances %",), ("Gross Advances of the bank",)], "label string")
    known = {(r.label, r.metric): (r.ord, r.score) for r in candidates.dictionary(labels, "label").where("metric = 'gross_advances'").collect()}
    assert known == {("Total Advances", "gross_advances"): (1, 100.0), ("Gross Advances of the bank", "gross_advances"): (0, 82.0)}
