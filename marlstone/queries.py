"""The queries of the library proper: name -> (query, SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.operators import book, candidates, checks, lookup, output, pages, scalars, trial, votes
from marlstone.plans import reporting
from marlstone.plans.dims import METRICS
from marlstone.sources import reports
from marlstone.sources.tables import values_sql


def report_winners(s, d):
    """The whole way from pages and cells to the best candidate of each metric, against what the reports were made of: within 1 %."""
    pages_, cells = reports.pages(s, d), reports.cells(s, d)
    win = reporting.winners(reporting.pool(pages_, cells, reports.docs(s, d).select("doc_id", "kind", "fy")))
    true = reports.values(s, d).select("doc_id", "metric", F.col("value").alias("true_value"))
    return win.join(true, ["doc_id", "metric"]).select("doc_id", "metric", (F.abs(F.col("value") - F.col("true_value")) <= 0.01 * F.abs("true_value")).alias("right"))


def report_years(s, d):
    return reporting.documents(reports.pages(s, d)).select("doc_id", "fy")


def report_cells(s, d):
    """Decided cells of all reports: how many there are, and how many hold neither or both of a value and a sentinel."""
    cells = reporting.decided(reports.pages(s, d), reports.cells(s, d), reports.docs(s, d).select("doc_id", "kind", "fy"))
    return cells.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_cells"), F.count_if(F.col("sentinel").isNull() != F.col("value").isNotNull()).alias("n_odd"))


_TYPES = values_sql("metric, types", [(m[0], m[4]) for m in METRICS]).replace(" t(", " m(")

QUERIES = {
    **book.QUERIES, **pages.QUERIES, **candidates.QUERIES, **trial.QUERIES, **votes.QUERIES, **checks.QUERIES, **output.QUERIES, **lookup.QUERIES, **scalars.QUERIES,
    "report_winners": (report_winners, f"SELECT doc_id, metric, TRUE AS right FROM {reports.VALUES_SQL} AS v JOIN {_TYPES} USING (metric) WHERE contains(types, kind)"),
    "report_years": (report_years, f"SELECT doc_id, fy FROM {reports.DOCS_SQL} AS d"),
    "report_cells": (report_cells, f"SELECT doc_id, CAST({len(METRICS)} AS BIGINT) AS n_cells, CAST(0 AS BIGINT) AS n_odd FROM {reports.DOCS_SQL} AS d"),
}
