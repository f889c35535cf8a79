"""From parsed pages and table cells of many reports to their decided cells: one plan, keyed by document throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import numbers
from marlstone.operators import candidates as C
from marlstone.operators import output, trial
from marlstone.operators import pages as P
from marlstone.plans import dims
from marlstone.plans.dims import DOCUMENTED, Profile


def documents(pages: DataFrame, by: str = "doc_id") -> DataFrame:
    """(by, institution, category, kind, identified, fy, fy_confidence) of every document whose pages name a year. Pages meet once, for who and when."""
    kinds = F.create_map(*(F.lit(x) for letter, name in dims.TYPES.items() for x in (name, letter)))
    who = C.identified(P.labelled(pages), [by], also=P.ballots(F.col("n")))
    best = who.withColumn("best", numbers.let(F.col("also"), P.elected)).where("best is not null")
    return best.select(by, "institution", "category", F.element_at(kinds, F.col("type")).alias("kind"), F.col("confidence").alias("identified"), F.col("best.y").alias("fy"), F.col("best.confidence").alias("fy_confidence"))


def pool(pages: DataFrame, cells: DataFrame, docs: DataFrame, by: str = "doc_id") -> DataFrame:
    """All candidates of all metrics, with what the trial asks of them: in which other sections and under how many labels a document prints the same value for the same year."""
    key = [by, "metric"]
    p = P.spread(P.labelled(pages), [by], "body").withColumnRenamed("section", "of_page")
    ranges = F.broadcast(dims.metrics(pages.sparkSession).select("metric", "unit", "low", "high", "tier"))  # 52 rows
    docs, also = docs.select(by, "kind", "fy"), ("fy", "of_page")
    t = C.from_tables(cells, docs, p, (by,), also=also).select(*key, *also, "page", "table_id", "c", "y", "resolved", "label", "score", "value", "is_foreign", "inferred", F.lit(True).alias("in_table"))
    x = C.from_lines(p, docs, (by,), also=also).select(
        *key, *also, "page", F.lit(None).cast("string").alias("table_id"), F.lit(0).alias("c"), F.lit(None).cast("int").alias("y"), F.lit(False).alias("resolved"), F.lit("").alias("label"), F.lit(100.0).alias("score"), "value", F.lit(False).alias("is_foreign"), F.lit(True).alias("inferred"), F.lit(False).alias("in_table")
    )
    c = t.unionByName(x).withColumnRenamed("of_page", "section").where("section is not null").join(ranges, "metric")
    order = Window.partitionBy(*key).orderBy("page", F.col("table_id").asc_nulls_last(), "c", "label", "value")
    year = F.coalesce("y", "fy")
    every = F.collect_list(F.struct(year.alias("y"), F.col("value").alias("value"), F.col("section").alias("section"), F.col("label").alias("label"))).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))  # in the order of cid: one sort serves both
    same = F.filter(every, lambda o: (o["y"] == year) & numbers.same_value(o["value"], F.col("value")))
    places = F.array_remove(F.sort_array(F.array_distinct(F.transform("same", lambda o: o["section"]))), F.col("section"))
    c = c.withColumn("same", same).withColumn("cid", F.row_number().over(order))
    return c.select(
        *key, "fy", "tier", "low", "high", "cid", "value", "page", "section", F.array_join(places, "|").alias("other_sections"), F.greatest(F.lit(1), F.size(F.array_distinct(F.filter(F.transform("same", lambda o: F.lower(o["label"])), lambda x: x != "")))).alias("n_aliases"), "y", "resolved",
        (~F.col("inferred")).alias("unit_printed"), "is_foreign", (F.col("inferred") & (F.col("unit") == "currency")).alias("inferred"), "in_table", (F.col("score") >= 100).alias("exact"), F.col("score").alias("label_score"), F.col("in_table").alias("has_header"), "table_id", F.col("c").alias("col"),
    )


def winners(candidates: DataFrame, by: str = "doc_id", profile: Profile = DOCUMENTED) -> DataFrame:
    """(by, metric, value, confidence, decision, page): the best founded candidate of each metric."""
    key = [by, "metric"]
    kept = ("tier", "n_aliases", "low", "high")
    w = trial.best(trial.trial(candidates, key, kept), key, ("value", *kept))
    source = F.coalesce(*(F.when(F.col("section") == k, F.lit(v)) for k, v in trial.SOURCE.items()), F.lit(0.3))
    sound = F.when(numbers.in_range(F.col("value"), F.col("low"), F.col("high")), 1.0).otherwise(0.5)
    sure = trial.confidence(F.col("court"), source, trial.evidence_score(F.col("tier"), F.col("n_sections"), F.col("n_aliases")), sound, F.lit(0.6), F.lit(1.0), F.lit(False), profile)
    return w.select(*key, "value", sure.alias("confidence"), "page").withColumn("decision", trial.decision(F.col("confidence"), profile))


def decided(pages: DataFrame, cells: DataFrame, docs: DataFrame, by: str = "doc_id", profile: Profile = DOCUMENTED) -> DataFrame:
    """One cell per document and metric: value, or ND, or NA, with confidence and decision.

    docs are the documents, as documents() gives them. They are used in many places: write them first, so that they are found once."""
    return output.cells(winners(pool(pages, cells, docs, by), by, profile), docs, by, profile)
