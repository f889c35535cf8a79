"""Decided cells and what is made of them: merge into a template, gaps from history, missing and summary reports, audit, wide sheets.

A cell is a value, a text or a sentinel (ND: not disclosed, NA: not applicable), in three columns. A number is never
replaced by a sentinel, and what comes from a template says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import numbers
from marlstone.plans import dims
from marlstone.plans.dims import DOCUMENTED, METRICS, Profile
from marlstone.sources import reports
from marlstone.sources.tables import values_sql

from .trial import decision


def cells(winners: DataFrame, docs: DataFrame, by: str = "doc_id", profile: Profile = DOCUMENTED) -> DataFrame:
    """One cell per document and metric: NA where the metric does not apply to the document's type (kind), ND below the floor or without a candidate, else the value. The dimension has 52 rows."""
    every = F.array(*(F.struct(F.lit(m[0]).alias("metric"), F.lit(m[4]).alias("types")) for m in METRICS))
    j = docs.select(by, "kind", F.explode(every).alias("m")).select(by, "kind", "m.*").join(winners.select(by, "metric", "value", "confidence"), [by, "metric"], "left")
    applies = F.contains("types", F.col("kind"))
    written = F.coalesce(F.col("confidence") >= profile.write_floor, F.lit(False))
    sentinel = F.when(~applies, "NA").when(~written, "ND")
    return j.select(
        by, "metric", F.when(sentinel.isNull(), F.col("value")).alias("value"), sentinel.alias("sentinel"), F.when(~applies, 100.0).otherwise(F.coalesce("confidence", F.lit(0.0))).alias("confidence"),
        F.when(~applies, "not applicable").otherwise(decision(F.coalesce("confidence", F.lit(0.0)), profile)).alias("decision"),
    )


def reason(year_penalty: Column, failed: Column, section: Column, sources: Column) -> Column:
    """Why a value was rejected: the top penalty, a failed check, prose only, or too few sources."""
    return F.coalesce(F.when(year_penalty > 0, F.format_string("penalty of %d points", year_penalty)), F.when(failed.isNotNull(), F.concat(F.lit("failed check: "), failed)), F.when(section == "narrative", F.lit("found in prose only")), F.format_string("only %d independent source(s)", sources))


def merged(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Template cells after a run: per key the most confident new number (the first on ties) replaces a less confident one; sentinels only fill blanks. Existing cells carry their ledger confidence, 0 if none."""
    order = Window.partitionBy(*keys).orderBy(F.col("confidence").desc(), "seq")
    best = new.where("value is not null").withColumn("n", F.row_number().over(order)).where("n = 1").select(*keys, F.col("value").alias("nv"), F.col("confidence").alias("nc"))
    marks = new.where("value is null").groupBy(*keys).agg(F.min("sentinel").alias("ns"))
    j = existing.join(best, keys, "full").join(marks, keys, "full")
    take = F.col("nv").isNotNull() & (F.col("value").isNull() | (F.col("nc") > F.coalesce("ledger", F.lit(0.0))))
    value = F.when(take, F.col("nv")).otherwise(F.col("value"))
    return j.select(*keys, value.alias("value"), F.when(value.isNull(), F.coalesce("ns", F.lit("ND"))).alias("sentinel"), F.when(take, F.col("nc")).otherwise(F.coalesce("ledger", F.lit(0.0))).alias("ledger"))


def numbered(rows: DataFrame, known: DataFrame) -> DataFrame:
    """New institutions are appended after the largest serial number, in order of name: ranges of names are numbered each by itself, after what the ranges before them hold."""
    top = known.agg(F.coalesce(F.max("sr_no"), F.lit(0))).first()[0]
    fresh = rows.join(known, "institution", "left_anti").distinct().repartitionByRange("institution").sortWithinPartitions("institution")
    fresh = fresh.select("institution", F.spark_partition_id().alias("part")).withColumn("n", F.row_number().over(Window.partitionBy("part").orderBy("institution")))
    sizes = fresh.groupBy("part").agg(F.max("n").alias("size"))  # a row per range
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size") + top).alias("before"))
    fresh = fresh.join(F.broadcast(before), "part")  # as many rows as ranges
    return known.select("sr_no", "institution").union(fresh.select((F.col("before") + F.col("n")).cast("int"), "institution"))


def filled(values: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """Gaps take the history's value and say where it comes from."""
    h = history.select(*keys, F.col("value").alias("hv"))
    return values.join(h, keys, "left").select(*keys, F.coalesce("value", "hv").alias("value"), F.when(F.col("value").isNotNull(), "report").when(F.col("hv").isNotNull(), "template").alias("source"))


def summary(cells: DataFrame, by: str = "doc_id") -> DataFrame:
    """Per document: counts of filled, ND and NA cells, mean confidence of the filled ones, cells per band, and the metrics to look at."""
    filled_ = F.col("sentinel").isNull()
    return cells.groupBy(by).agg(
        F.count_if(filled_).alias("filled"), F.count_if(F.col("sentinel") == "ND").alias("nd"), F.count_if(F.col("sentinel") == "NA").alias("na"), F.round(F.avg(F.when(filled_, F.col("confidence"))), 2).alias("mean_confidence"),
        *(F.count_if(F.col("decision") == b).alias(b) for b in ("auto_approve", "high", "manual_review", "reject")), F.array_join(F.array_sort(F.collect_list(F.when(F.col("decision") == "manual_review", F.col("metric")))), ", ").alias("look_at"),
    )


def to_wide(values: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    return values.groupBy(*keys).pivot("metric", metrics).agg(F.max("value"))


def to_long(sheet: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """History scan: numeric cells of a wide sheet."""
    return sheet.unpivot(keys, [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value").where("value is not null")


def audit(cells: DataFrame, by: str = "doc_id") -> DataFrame:
    """One JSON text per cell."""
    return cells.select(by, "metric", F.to_json(F.struct("metric", "value", "sentinel", "decision")).alias("audit"))


def category(name: Column, kind: Column) -> Column:
    """Default category by type; unknown names with finance in them are non-banks."""
    k = F.coalesce(kind, F.when(F.lower(name).contains("finance"), F.lit("nbfc")).otherwise(F.lit("bank")))
    return F.coalesce(*(F.when(k == t, F.lit(c)) for t, c in (("bank", "Private Sector Bank"), ("sfb", "Small Finance Bank"), ("nbfc", "NBFC"), ("hfc", "Housing Finance Company"), ("aifi", "All-India Financial Institution"))))


def write_sheets(values: DataFrame, path: str) -> None:
    """One folder per fiscal year."""
    values.write.mode("overwrite").partitionBy("fy").parquet(path)


def quarantined(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that can be worked on, and the others with what is wrong: a bad one never stops the batch."""
    error = F.when(F.col("body").isNull(), "no text").when(F.length(F.trim("body")) == 0, "empty").when(~F.col("body").rlike(r"(?:19|20)\d{2}"), "no fiscal year")
    d = docs.withColumn("error", error)
    return d.where("error is null").drop("error"), d.where("error is not null")


_M = values_sql("metric, header, band, unit, types, tier, low, high, negative", METRICS)
_W = f"(SELECT doc_id, metric, value, confidence FROM {reports.VALUES_SQL} AS x)"
_C = f"WITH c AS (SELECT doc_id, metric, CASE WHEN contains(types, kind) AND confidence >= 65 THEN value END AS value, CASE WHEN NOT contains(types, kind) THEN 'NA' WHEN NOT coalesce(confidence >= 65, FALSE) THEN 'ND' END AS sentinel, CASE WHEN NOT contains(types, kind) THEN CAST(100 AS DOUBLE) ELSE coalesce(confidence, 0) END AS confidence, CASE WHEN NOT contains(types, kind) THEN 'not applicable' WHEN confidence >= 95 THEN 'auto_approve' WHEN confidence >= 80 THEN 'high' WHEN confidence >= 65 THEN 'manual_review' ELSE 'reject' END AS decision FROM {reports.DOCS_SQL} AS d CROSS JOIN {_M.replace(' t(', ' m(')} LEFT JOIN {_W} AS w USING (doc_id, metric)) "
_KEYS = ["doc_id", "metric"]
_V = f"{reports.VALUES_SQL} AS v"
#: A template's cells, and a run's: some template cells are blank, some have a ledger, some metrics come twice or without a number.
_OLD = f"(SELECT doc_id, metric, CASE WHEN r % 3 = 0 THEN NULL ELSE prior END AS value, CASE WHEN r % 3 = 1 THEN CAST(90 AS DOUBLE) END AS ledger FROM {_V} WHERE page <> 4)"
_RUN = f"(SELECT doc_id, metric, 1 AS seq, CASE WHEN (doc_id + r) % 5 = 0 THEN NULL ELSE value END AS value, CASE WHEN (doc_id + r) % 5 = 0 THEN 'ND' END AS sentinel, confidence FROM {_V} UNION ALL SELECT doc_id, metric, 2, value + 1, NULL, confidence FROM {_V} WHERE doc_id % 2 = 0)"


def _win(s, d) -> DataFrame:
    return cells(reports.values(s, d), reports.docs(s, d))


def _old(s, d) -> DataFrame:
    v = reports.values(s, d).where("page <> 4")
    return v.select(*_KEYS, F.when(F.col("r") % 3 != 0, F.col("prior")).alias("value"), F.when(F.col("r") % 3 == 1, 90.0).alias("ledger"))


def _run(s, d) -> DataFrame:
    v, none = reports.values(s, d), (F.col("doc_id") + F.col("r")) % 5 == 0
    one = v.select(*_KEYS, F.lit(1).alias("seq"), F.when(~none, F.col("value")).alias("value"), F.when(none, "ND").alias("sentinel"), "confidence")
    return one.union(v.where("doc_id % 2 = 0").select(*_KEYS, F.lit(2), F.col("value") + 1, F.lit(None).cast("string"), "confidence"))


def _known(s, d) -> DataFrame:
    """A template's institutions: every fourth report's, numbered with gaps."""
    return reports.docs(s, d).where("doc_id % 4 = 0").groupBy(F.col("name").alias("institution")).agg(F.min(F.col("doc_id") * 3 + 1).cast("int").alias("sr_no"))


QUERIES = {
    "cell_decide": (lambda s, d: _win(s, d), _C + "SELECT * FROM c"),
    "missing_report": (lambda s, d: _win(s, d).where("sentinel = 'ND'").join(dims.metrics(s), "metric").select("doc_id", "header", "tier"), _C + f"SELECT doc_id, header, tier FROM c JOIN {_M.replace(' t(', ' m(')} USING (metric) WHERE sentinel = 'ND'"),
    "summary_bands": (lambda s, d: summary(_win(s, d)), _C + "SELECT doc_id, COUNT(*) FILTER (sentinel IS NULL) AS filled, COUNT(*) FILTER (sentinel = 'ND') AS nd, COUNT(*) FILTER (sentinel = 'NA') AS na, ROUND(AVG(CASE WHEN sentinel IS NULL THEN confidence END), 2) AS mean_confidence, COUNT(*) FILTER (decision = 'auto_approve') AS auto_approve, COUNT(*) FILTER (decision = 'high') AS high, COUNT(*) FILTER (decision = 'manual_review') AS manual_review, COUNT(*) FILTER (decision = 'reject') AS reject, coalesce(string_agg(CASE WHEN decision = 'manual_review' THEN metric END, ', ' ORDER BY metric), '') AS look_at FROM c GROUP BY doc_id"),
    "audit_json": (lambda s, d: audit(_win(s, d).where("value is null or value = cast(value as bigint)").withColumn("value", F.col("value").cast("long"))), _C + """SELECT doc_id, metric, '{"metric":"' || metric || '"' || CASE WHEN value IS NOT NULL THEN ',"value":' || CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE '' END || CASE WHEN sentinel IS NOT NULL THEN ',"sentinel":"' || sentinel || '"' ELSE '' END || ',"decision":"' || decision || '"}' AS audit FROM c WHERE value IS NULL OR value = floor(value)"""),
    "reject_reason": (lambda s, d: reports.values(s, d).select("doc_id", "metric", reason((F.col("confidence") % 7 * F.when(F.col("r") % 2 == 0, 12).otherwise(0)).cast("int"), F.when(F.col("confidence") % 3 == 0, "range"), F.when(F.col("page") == 6, "narrative"), F.col("r"))
                      .alias("reason")), f"SELECT doc_id, metric, CASE WHEN r % 2 = 0 AND confidence % 7 > 0 THEN 'penalty of ' || CAST(confidence % 7 * 12 AS INTEGER) || ' points' WHEN confidence % 3 = 0 THEN 'failed check: range' WHEN page = 6 THEN 'found in prose only' ELSE 'only ' || r || ' independent source(s)' END AS reason FROM {_V}"),
    "merge_guard": (lambda s, d: merged(_old(s, d), _run(s, d), _KEYS), f"WITH b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, metric ORDER BY confidence DESC, seq) AS n FROM {_RUN} AS x WHERE value IS NOT NULL), m AS (SELECT doc_id, metric, MIN(sentinel) AS ns FROM {_RUN} AS x WHERE value IS NULL GROUP BY ALL), j AS (SELECT COALESCE(o.doc_id, b.doc_id, m.doc_id) AS doc_id, COALESCE(o.metric, b.metric, m.metric) AS metric, o.value, o.ledger, b.value AS nv, b.confidence AS nc, ns, b.value IS NOT NULL AND (o.value IS NULL OR b.confidence > COALESCE(o.ledger, 0)) AS take FROM {_OLD} AS o FULL JOIN (SELECT * FROM b WHERE n = 1) AS b ON o.doc_id = b.doc_id AND o.metric = b.metric FULL JOIN m ON COALESCE(o.doc_id, b.doc_id) = m.doc_id AND COALESCE(o.metric, b.metric) = m.metric) SELECT doc_id, metric, CASE WHEN take THEN nv ELSE value END AS value, CASE WHEN (CASE WHEN take THEN nv ELSE value END) IS NULL THEN COALESCE(ns, 'ND') END AS sentinel, CASE WHEN take THEN nc ELSE COALESCE(ledger, CAST(0 AS DOUBLE)) END AS ledger FROM j"),
    "append_serial": (lambda s, d: numbered(reports.docs(s, d).select(F.col("name").alias("institution")), _known(s, d)), f"WITH k AS (SELECT name AS institution, CAST(MIN(doc_id * 3 + 1) AS INTEGER) AS sr_no FROM {reports.DOCS_SQL} AS x WHERE doc_id % 4 = 0 GROUP BY name), f AS (SELECT DISTINCT name AS institution FROM {reports.DOCS_SQL} AS x WHERE name NOT IN (SELECT institution FROM k)) SELECT sr_no, institution FROM k UNION ALL SELECT CAST((SELECT MAX(sr_no) FROM k) + row_number() OVER (ORDER BY institution) AS INTEGER), institution FROM f"),
    "fill_history": (lambda s, d: filled(_old(s, d).select(*_KEYS, "value"), reports.values(s, d).where("doc_id % 2 = 0").select(*_KEYS, "value"), _KEYS), f"SELECT o.doc_id, o.metric, COALESCE(o.value, h.value) AS value, CASE WHEN o.value IS NOT NULL THEN 'report' WHEN h.value IS NOT NULL THEN 'template' END AS source FROM {_OLD} AS o LEFT JOIN (SELECT doc_id, metric, value FROM {_V} WHERE doc_id % 2 = 0) AS h ON o.doc_id = h.doc_id AND o.metric = h.metric"),
    "sheet_wide": (lambda s, d: to_wide(reports.values(s, d), ["doc_id", "fy"], ["nii", "pat", "roe"]), f"SELECT doc_id, fy, MAX(CASE WHEN metric = 'nii' THEN value END) AS nii, MAX(CASE WHEN metric = 'pat' THEN value END) AS pat, MAX(CASE WHEN metric = 'roe' THEN value END) AS roe FROM {_V} GROUP BY doc_id, fy"),
    "sheet_long": (lambda s, d: to_long(to_wide(_old(s, d), ["doc_id"], ["nii", "pat", "roe", "crar"]), ["doc_id"], ["nii", "pat", "roe", "crar"]), f"SELECT doc_id, metric, value FROM {_OLD} AS o WHERE metric IN ('nii', 'pat', 'roe', 'crar') AND value IS NOT NULL"),
    "category_default": (lambda s, d: reports.docs(s, d).select("doc_id", category(F.col("name"), F.when(F.col("doc_id") % 3 == 0, F.element_at(F.create_map(*(F.lit(x) for kv in dims.TYPES.items() for x in kv)), F.col("kind")))).alias("category")), f"SELECT doc_id, CASE CASE WHEN doc_id % 3 = 0 THEN kind WHEN contains(lower(name), 'finance') THEN 'n' ELSE 'b' END WHEN 'b' THEN 'Private Sector Bank' WHEN 's' THEN 'Small Finance Bank' WHEN 'n' THEN 'NBFC' WHEN 'h' THEN 'Housing Finance Company' ELSE 'All-India Financial Institution' END AS category FROM {reports.DOCS_SQL} AS x"),
    "failure_quarantine": (lambda s, d: quarantined(reports.pages(s, d).select("doc_id", "page", F.when(F.col("doc_id") % 13 != 0, F.col("body")).alias("body")))[1].select("doc_id", "page", "error"), f"SELECT doc_id, page, CASE WHEN doc_id % 13 = 0 THEN 'no text' ELSE 'no fiscal year' END AS error FROM {reports.PAGES_SQL} AS x WHERE doc_id % 13 = 0 OR NOT regexp_matches(body, '(19|20)[0-9][0-9]')"),
    "cell_comment": (lambda s, d: _win(s, d).where("value is not null and confidence < 80").select("doc_id", "metric", F.concat(F.lit("confidence "), numbers.general(F.col("confidence"))).alias("comment")), _C + "SELECT doc_id, metric, 'confidence ' || CAST(CAST(confidence AS INTEGER) AS VARCHAR) AS comment FROM c WHERE value IS NOT NULL AND confidence < 80"),
}
