"""Scores for and against candidate values, the winner, evidence and confidence, per document and metric.

Candidates of a metric and document are few (what the pages hold). Rivals meet, and winners are ranked, in windows over
(document, metric): one shuffle serves both, and candidates of other metrics or documents never touch one another. The order
of the winner ends in page, table and column: it never depends on how rows arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import numbers
from marlstone.plans import dims
from marlstone.plans.dims import DOCUMENTED, METRICS, Profile
from marlstone.sources import reports
from marlstone.sources.tables import inline, values_sql

#: Points of a defence.
SECTION_POINTS = {"financial_statements": 30, "financial_highlights": 22, "multi_year_summary": 14, "key_ratios": 14, "mdna": 8, "narrative": 2}
SOURCE = {"financial_statements": 1.0, "financial_highlights": 0.9, "multi_year_summary": 0.8, "key_ratios": 0.8, "mdna": 0.5, "narrative": 0.2}
TIERS = {"A": (3, 2, 0.35), "B": (2, 1, 0.70), "C": (1, 1, 1.00)}  # sources for full marks, least, score of one
WEIGHTS = {"court": 0.34, "source": 0.18, "evidence": 0.18, "dna": 0.15, "formula": 0.10, "trend": 0.05}

BY = ["doc_id", "metric"]
#: What a candidate has, besides its document, metric, the document's year (fy) and the metric's range (low, high).
COLUMNS = "cid, value, page, section, other_sections, n_aliases, y, resolved, unit_printed, is_foreign, inferred, in_table, exact, label_score, has_header, table_id, col"


def points(name: Column) -> Column:
    return F.coalesce(*(F.when(name == k, F.lit(v)) for k, v in SECTION_POINTS.items()), F.lit(0))


def sections(c: DataFrame) -> Column:
    return F.array_distinct(F.filter(F.concat(F.array("section"), F.split("other_sections", r"\|")), lambda x: x != ""))


def defence(c: DataFrame) -> DataFrame:
    s = sections(c)
    score = 20 + F.aggregate(F.transform(s, points), F.lit(0), lambda a, x: a + x) + 18 * (F.size(s) - 1) + 8 * (F.col("n_aliases") - 1)
    for flag, p in (("unit_printed", 8), ("resolved", 12), ("in_table", 10), ("exact", 6)):
        score = score + F.when(F.col(flag), p).otherwise(0)
    return c.withColumn("n_sections", F.size(s)).withColumn("defence", F.least(F.lit(100), score).cast("int"))


def penalty_year() -> Column:
    return F.when(F.col("y").isNotNull() & (F.col("y") != F.col("fy")), 60).when(~F.col("resolved"), 12).otherwise(0)


def penalty_unit() -> Column:
    v = F.col("value")
    within = lambda x: numbers.in_range(x, F.col("low"), F.col("high"))
    out = ~within(v)
    return F.when(F.col("is_foreign"), 70).otherwise(0) + F.when(F.col("inferred"), 15).otherwise(0) + F.when(out, 35).otherwise(0) + F.when(out & within(v / 100), 35).otherwise(0)


def scale_hint() -> Column:
    """First factor that would bring an out-of-range value into range."""
    within = lambda x: numbers.in_range(x, F.col("low"), F.col("high"))
    return F.when(~within(F.col("value")), F.get(F.filter(F.array(F.lit(0.01), F.lit(100.0), F.lit(0.001), F.lit(1000.0)), lambda f: within(F.col("value") * f)), F.lit(0)))


def penalty_alignment(by: list[str] = BY) -> Column:
    """A poor label, a head without a year, and a neighbouring column of the same table whose year is known."""
    every = F.collect_list(F.struct("table_id", "col", "resolved")).over(Window.partitionBy(*by))
    beside = F.exists(every, lambda o: (o["table_id"] == F.col("table_id")) & o["resolved"] & (o["col"] != F.col("col")) & (F.abs(o["col"] - F.col("col")) <= 1))
    return F.when(F.col("in_table") & (F.col("label_score") < 88), 30).otherwise(0) + F.when(~F.col("resolved") & F.col("has_header"), 20).otherwise(0) + F.when(~F.col("resolved") & beside, 20).otherwise(0)


def penalty_conflict(by: list[str] = BY) -> Column:
    """22 if a candidate of the same year has another value, 12 more if the strongest such rival is better founded; of defended candidates."""
    year = F.coalesce("y", "fy")
    strength = F.struct(F.col("n_sections").alias("n"), points(F.col("section")).alias("p"))
    every = F.collect_list(F.struct(year.alias("y"), F.col("value").alias("value"), strength.alias("s"))).over(Window.partitionBy(*by))
    rivals = F.filter(every, lambda o: (o["y"] == year) & ~numbers.same_value(o["value"], F.col("value")))
    best = F.array_max(F.transform(rivals, lambda o: o["s"]))
    return F.when(best.isNull(), 0).otherwise(F.lit(22) + F.when(best > strength, 12).otherwise(0))


def trial(c: DataFrame, by: list[str] = BY, keep: tuple[str, ...] = ()) -> DataFrame:
    """Penalties and what is left of the defence (court), with the columns in keep."""
    d = defence(c)
    t = d.select(
        *by, *keep, "cid", "value", "page", "section", "col", "n_sections", "defence", penalty_year().alias("year_penalty"), penalty_conflict(by).alias("conflict_penalty"), penalty_unit().alias("unit_penalty"), penalty_alignment(by).alias("alignment_penalty")
    )
    return t.withColumn("court", F.col("defence") - F.col("year_penalty") - F.col("conflict_penalty") - F.col("unit_penalty") - F.col("alignment_penalty"))


def ranked(t: DataFrame, by: list[str] = BY) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("court").desc(), F.col("n_sections").desc(), points(F.col("section")).desc(), "page", "col", "cid")
    return t.withColumn("place", F.row_number().over(w))


def best(t: DataFrame, by: list[str] = BY, keep: tuple[str, ...] = ()) -> DataFrame:
    """The first of ranked, with its court, n_sections, section, page, col, cid and the columns in keep: folded, so that candidates are not sorted again."""
    order = F.struct(F.col("court").isNull().alias("none"), (-F.col("court")).alias("least"), (-F.col("n_sections")).alias("fewest"), (-points(F.col("section"))).alias("lowest"), "page", "col", "cid", "court", "n_sections", "section", *keep)
    return t.groupBy(*by).agg(F.min(order).alias("b")).select(*by, *(f"b.{c}" for c in ("court", "n_sections", "section", "page", "col", "cid", *keep)))


def rejected(t: DataFrame, by: list[str] = BY, most: int = 8) -> DataFrame:
    """Per document and metric the candidates after the winner, the best eight, in order."""
    lost = ranked(t, by).where((F.col("place") > 1) & (F.col("place") <= most + 1))
    return lost.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "cid"))), lambda x: x["cid"].cast("string")), ",").alias("rejected"))


def trial_single(c: DataFrame, by: list[str] = BY) -> DataFrame:
    """The single profile: quality, agreement and units in one clipped score."""
    s = 20 + (40 * F.coalesce(*(F.when(F.col("section") == k, F.lit(v)) for k, v in SOURCE.items()), F.lit(0.3))).cast("int") + 12 * F.least(F.size(sections(c)) - 1, F.lit(3))
    s = s + F.when(F.col("in_table"), 10).otherwise(0) + F.when(F.col("exact"), 6).otherwise(0) + F.when(F.col("unit_printed"), 8).otherwise(-15) + F.when(F.col("resolved"), 12).otherwise(-12)
    s = s - F.when(F.col("y").isNotNull() & (F.col("y") != F.col("fy")), 60).otherwise(0) - F.when(F.col("label_score") < 88, 20).otherwise(0)
    return c.select(*by, "cid", F.greatest(F.lit(0), F.least(F.lit(100), s)).cast("int").alias("score"))


def evidence_score(tier: Column, sources: Column, n_aliases: Column) -> Column:
    out = F.lit(None).cast("double")
    for t, (full, least, single) in TIERS.items():
        linear = single + (1 - single) * (sources - least + 0.0) / max(full - least, 1)
        out = F.when(tier == t, F.when(sources >= full, 1.0).when(sources >= least, linear).otherwise(single / 2)).otherwise(out)
    return F.round(F.least(F.lit(1.0), out + F.when(n_aliases > 1, 0.05).otherwise(0.0)), 4)


def confidence(court: Column, source: Column, evidence: Column, dna: Column, formula: Column, trend: Column, derived: Column, profile: Profile = DOCUMENTED) -> Column:
    parts = {"court": F.greatest(F.lit(0.0), F.least(F.lit(1.0), court / 100.0)), "source": source, "evidence": evidence, "dna": dna, "formula": formula, "trend": trend}
    total = 100 * sum((w * parts[k] for k, w in WEIGHTS.items()), F.lit(0.0))
    return F.round(F.greatest(F.lit(0.0), F.least(F.when(derived, F.lit(float(profile.derived_cap))).otherwise(F.lit(100.0)), total)), 1)


def decision(c: Column, profile: Profile = DOCUMENTED) -> Column:
    return F.when(c >= 95, "auto_approve").when(c >= 80, "high").when(c >= profile.write_floor, "manual_review").otherwise("reject")


def clamp_fold(steps: Column, start: Column) -> Column:
    """Adjustments in order, clamped to 0..100 after each."""
    return F.aggregate(F.transform(F.array_sort(steps), lambda s: s["delta"]), start, lambda a, d: F.least(F.lit(100.0), F.greatest(F.lit(0.0), a + d)))


#: Kinds of candidates, in factors of the true value: sound, last year's, in another unit, another metric's, from prose, and from a column without a year.
KINDS = [
    (1, 1.0, 120, "financial_statements", "financial_highlights|multi_year_summary", 2, 0, True, True, False, False, True, True, 100.0, True, "t120", 1),
    (2, 0.85, 120, "financial_statements", "", 1, -1, True, True, False, False, True, True, 100.0, True, "t120", 2),
    (3, 10000.0, 121, "financial_statements", "", 1, 0, True, False, False, True, True, True, 100.0, True, "t121", 1),
    (4, 0.13, 120, "financial_statements", "", 1, 0, True, True, False, False, True, False, 61.0, True, "t120", 1),
    (5, 1.01, 7, "narrative", "", 1, None, False, False, False, True, False, True, 100.0, False, None, 0),
    (6, 0.5, 121, "key_ratios", "", 1, None, False, True, True, False, True, True, 95.0, True, "t121", 2),
]
_KINDS = values_sql(COLUMNS.replace("value", "times").replace(" y,", " years,"), KINDS)
_RANGES = values_sql("metric, low, high", [(m[0], m[6], m[7]) for m in METRICS if m[6] is not None])
_POOL = f"(SELECT v.doc_id, v.metric, v.fy, g.low, g.high, k.*, v.value * k.times AS value, v.fy + k.years AS y FROM {reports.VALUES_SQL} AS v JOIN {_RANGES.replace(' t(', ' g(')} USING (metric) CROSS JOIN {_KINDS.replace(' t(', ' k(')} WHERE v.doc_id % 6 + 1 >= k.cid OR k.cid = 1)"


def pool(s, d) -> DataFrame:
    """Candidates of all reports and metrics: the first kinds, one to six of them by report."""
    ranges = F.broadcast(dims.metrics(s).where("low is not null").select("metric", "low", "high"))  # 52 rows at most
    v = reports.values(s, d).select("doc_id", "metric", "fy", F.col("value").alias("true_value")).join(ranges, "metric")
    k = inline(s, COLUMNS.replace("value", "times").replace(" y,", " years,"), KINDS)
    out = v.join(F.broadcast(k), (F.col("doc_id") % 6 + 1 >= F.col("cid")) | (F.col("cid") == 1))  # six rows
    return out.withColumn("value", F.col("true_value") * F.col("times")).withColumn("y", F.col("fy") + F.col("years"))


_PTS = "CASE {0} WHEN 'financial_statements' THEN 30 WHEN 'financial_highlights' THEN 22 WHEN 'multi_year_summary' THEN 14 WHEN 'key_ratios' THEN 14 WHEN 'mdna' THEN 8 WHEN 'narrative' THEN 2 ELSE 0 END"
_T = f"""WITH s AS (SELECT *, list_distinct(list_filter(list_concat([section], string_split(other_sections, '|')), lambda x: x <> '')) AS secs FROM {_POOL} AS pool),
d AS (SELECT *, CAST(len(secs) AS INTEGER) AS n_sections, {_PTS.format('section')} AS pts, CAST(least(100, 20 + list_sum(list_transform(secs, lambda x: {_PTS.format('x')})) + 18 * (len(secs) - 1) + 8 * (n_aliases - 1)
  + CASE WHEN unit_printed THEN 8 ELSE 0 END + CASE WHEN resolved THEN 12 ELSE 0 END + CASE WHEN in_table THEN 10 ELSE 0 END + CASE WHEN exact THEN 6 ELSE 0 END) AS INTEGER) AS defence FROM s),
n AS (SELECT DISTINCT a.doc_id, a.metric, a.cid FROM d a JOIN d b ON a.doc_id = b.doc_id AND a.metric = b.metric AND a.table_id = b.table_id AND abs(a.col - b.col) = 1 AND b.resolved AND NOT a.resolved),
p AS (SELECT d.*, CASE WHEN y <> fy THEN 60 WHEN NOT resolved THEN 12 ELSE 0 END AS year_penalty,
  CASE WHEN is_foreign THEN 70 ELSE 0 END + CASE WHEN inferred THEN 15 ELSE 0 END + CASE WHEN NOT value BETWEEN low AND high THEN 35 ELSE 0 END + CASE WHEN NOT value BETWEEN low AND high AND value / 100 BETWEEN low AND high THEN 35 ELSE 0 END AS unit_penalty,
  CASE WHEN in_table AND label_score < 88 THEN 30 ELSE 0 END + CASE WHEN NOT resolved AND has_header THEN 20 ELSE 0 END + CASE WHEN n.cid IS NOT NULL THEN 20 ELSE 0 END AS alignment_penalty FROM d LEFT JOIN n USING (doc_id, metric, cid)),
r AS (SELECT a.doc_id, a.metric, a.cid, max(b.n_sections * 1000 + b.pts) AS rival, any_value(a.n_sections * 1000 + a.pts) AS own FROM p a JOIN p b ON a.doc_id = b.doc_id AND a.metric = b.metric AND a.cid <> b.cid AND coalesce(a.y, a.fy) = coalesce(b.y, b.fy) AND abs(a.value - b.value) > 0.005 * greatest(abs(a.value), abs(b.value)) GROUP BY a.doc_id, a.metric, a.cid),
t AS (SELECT p.*, COALESCE(CASE WHEN r.cid IS NULL THEN 0 ELSE 22 + CASE WHEN rival > own THEN 12 ELSE 0 END END, 0) AS conflict_penalty FROM p LEFT JOIN r USING (doc_id, metric, cid)),
c AS (SELECT *, CAST(defence - year_penalty - conflict_penalty - unit_penalty - alignment_penalty AS INTEGER) AS court FROM t),
w AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, metric ORDER BY court DESC, n_sections DESC, pts DESC, page, col, cid) AS INTEGER) AS place FROM c)
"""
_CC = "court, source, evidence, dna, formula, trend, derived"
_STEPS = [(1, 50.0, 1, -90.0), (1, 50.0, 2, 5.0), (2, 90.0, 1, 30.0), (2, 90.0, 2, -15.0), (3, 70.0, 1, 0.0)]
#: Parts of the confidence, made of what the reports print.
_PARTS = f"(SELECT doc_id, metric, CAST(confidence * 2 - 60 AS DOUBLE) AS court, CAST(r % 5 AS DOUBLE) / 4 AS source, CAST(doc_id % 3 AS DOUBLE) / 2 AS evidence, CASE WHEN r % 2 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS dna, CAST(page % 3 AS DOUBLE) / 2 AS formula, CAST(1 AS DOUBLE) AS trend, doc_id % 7 = 0 AS derived FROM {reports.VALUES_SQL} AS v)"
_SUM = "CAST(ROUND(greatest(0, least(CASE WHEN derived THEN 90 ELSE 100 END, 100 * (0.34 * greatest(0, least(1, court / 100)) + 0.18 * source + 0.18 * evidence + 0.15 * dna + 0.10 * formula + 0.05 * trend))), 1) AS DOUBLE)"


def _parts(s, d) -> DataFrame:
    f = lambda x: F.col(x).cast("double")
    return reports.values(s, d).select(
        *BY, (F.col("confidence") * 2 - 60).alias("court"), ((F.col("r") % 5).cast("double") / 4).alias("source"), ((F.col("doc_id") % 3).cast("double") / 2).alias("evidence"), F.when(F.col("r") % 2 == 0, 1.0).otherwise(0.5).alias("dna"),
        ((F.col("page") % 3).cast("double") / 2).alias("formula"), F.lit(1.0).alias("trend"), (F.col("doc_id") % 7 == 0).alias("derived"),
    )


def _tiers(s, d) -> DataFrame:
    tiers = F.broadcast(dims.metrics(s).select("metric", "tier"))
    return reports.values(s, d).join(tiers, "metric").select(*BY, "tier", (F.col("doc_id") % 4).cast("int").alias("sources"), (F.col("r") % 3).cast("int").alias("n"))


QUERIES = {
    "defence": (lambda s, d: defence(pool(s, d)).select(*BY, "cid", "n_sections", "defence"), _T + "SELECT doc_id, metric, cid, n_sections, defence FROM c"),
    "penalty_year": (lambda s, d: trial(pool(s, d)).select(*BY, "cid", "year_penalty"), _T + "SELECT doc_id, metric, cid, year_penalty FROM c"),
    "penalty_conflict": (lambda s, d: trial(pool(s, d)).select(*BY, "cid", "conflict_penalty"), _T + "SELECT doc_id, metric, cid, conflict_penalty FROM c"),
    "penalty_unit": (lambda s, d: trial(pool(s, d)).select(*BY, "cid", "unit_penalty"), _T + "SELECT doc_id, metric, cid, unit_penalty FROM c"),
    "penalty_alignment": (lambda s, d: trial(pool(s, d)).select(*BY, "cid", "alignment_penalty"), _T + "SELECT doc_id, metric, cid, alignment_penalty FROM c"),
    "scale_hint": (lambda s, d: pool(s, d).select(*BY, "cid", scale_hint().alias("hint")), _T + "SELECT doc_id, metric, cid, CAST(CASE WHEN NOT value BETWEEN low AND high THEN CASE WHEN value * 0.01 BETWEEN low AND high THEN 0.01 WHEN value * 100 BETWEEN low AND high THEN 100 WHEN value * 0.001 BETWEEN low AND high THEN 0.001 WHEN value * 1000 BETWEEN low AND high THEN 1000 END END AS DOUBLE) AS hint FROM c"),
    "trial_winner": (lambda s, d: ranked(trial(pool(s, d))).select(*BY, "cid", "court", "place"), _T + "SELECT doc_id, metric, cid, court, place FROM w"),
    "rejected_list": (lambda s, d: rejected(trial(pool(s, d))), _T + "SELECT doc_id, metric, string_agg(CAST(cid AS VARCHAR), ',' ORDER BY place) AS rejected FROM w WHERE place > 1 AND place <= 9 GROUP BY doc_id, metric"),
    "trial_single": (lambda s, d: trial_single(pool(s, d)), f"SELECT doc_id, metric, cid, CAST(greatest(0, least(100, 20 + CASE section WHEN 'narrative' THEN 8 WHEN 'key_ratios' THEN 32 ELSE 40 END + 12 * least(len(list_distinct(list_filter(list_concat([section], string_split(other_sections, '|')), lambda x: x <> ''))) - 1, 3) + CASE WHEN in_table THEN 10 ELSE 0 END + CASE WHEN exact THEN 6 ELSE 0 END + CASE WHEN unit_printed THEN 8 ELSE -15 END + CASE WHEN resolved THEN 12 ELSE -12 END - CASE WHEN y <> fy THEN 60 ELSE 0 END - CASE WHEN label_score < 88 THEN 20 ELSE 0 END)) AS INTEGER) AS score FROM {_POOL} AS pool"),
    "evidence_tier": (lambda s, d: _tiers(s, d).select(*BY, evidence_score(F.col("tier"), F.col("sources"), F.col("n")).alias("score")), f"SELECT doc_id, metric, CAST(ROUND(least(1.0, CASE tier WHEN 'A' THEN CASE WHEN sources >= 3 THEN 1 WHEN sources >= 2 THEN 0.35 ELSE 0.175 END WHEN 'B' THEN CASE WHEN sources >= 2 THEN 1 WHEN sources >= 1 THEN 0.7 ELSE 0.35 END ELSE CASE WHEN sources >= 1 THEN 1 ELSE 0.5 END END + CASE WHEN n > 1 THEN 0.05 ELSE 0 END), 4) AS DOUBLE) AS score FROM (SELECT doc_id, metric, tier, doc_id % 4 AS sources, r % 3 AS n FROM {reports.VALUES_SQL} AS v JOIN {values_sql('metric, tier', [(m[0], m[5]) for m in METRICS]).replace(' t(', ' m(')} USING (metric))"),
    "confidence_band": (lambda s, d: _parts(s, d).select(*BY, confidence(*(F.col(c) for c in _CC.split(", "))).alias("confidence")).withColumn("decision", decision(F.col("confidence"))), f"SELECT doc_id, metric, confidence, CASE WHEN confidence >= 95 THEN 'auto_approve' WHEN confidence >= 80 THEN 'high' WHEN confidence >= 65 THEN 'manual_review' ELSE 'reject' END AS decision FROM (SELECT doc_id, metric, {_SUM} AS confidence FROM {_PARTS} AS parts)"),
    "clamp_fold": (lambda s, d: inline(s, "i, start_score, step, delta", _STEPS).groupBy("i", "start_score").agg(F.collect_list(F.struct("step", "delta")).alias("steps")).select("i", clamp_fold(F.col("steps"), F.col("start_score")).alias("score")), f"SELECT i, score FROM {values_sql('i, score', [(1, 5.0), (2, 85.0), (3, 70.0)])}"),
}
