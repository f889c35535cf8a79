"""Mixing sources to target weights by capped water-filling.

Sources share the total size in proportion to their weights; no target exceeds `epochs` times its source's size, and
what a capped source can't take is shared again by weight among the rest until no target is above its cap. That fixed
point is a water level: with the sources in order of cap / weight, those below the level are capped. A document is
taken as often as the target is a whole multiple of its source's size; the fraction is drawn without replacement in
the order of a seeded hash, up to the exact number of words, so one document of each source is taken in part.

Only (source, hash bucket) sums and the one bucket of each source in which its draw ends are gathered; documents of a
hot source are spread over all tasks.

Rows: null texts and texts without words have size 0 and are taken 0 times; a null source is a source of its own, last
in order; a null id counts as empty text in the hash, which takes the text in; equal rows stand next to one another in the draw; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, discard, written

WEIGHTS = (5, 2, 1)  #: of sources in order of code points, null last, repeating
EPOCHS = 3
SEED = "mix-1"
ROWS = 1 << 16  #: documents that a bucket of the draw holds, about: how many buckets there are grows with the rows


def _sizes(docs: DataFrame, text_col: str, source_col: str, id_col: str, seed: str) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    # by id and text, so that neither a null id nor an id of many rows is one place in the draw
    none = lambda c: F.coalesce(c, F.lit(""))
    drawn = F.concat(F.lit(seed + ":"), none(F.col(id_col).cast("string")), F.lit(":"), none(F.md5(F.col(text_col).cast("string").cast("binary"))))
    draw = F.md5(drawn.cast("binary"))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), draw.alias("draw"))


def targets(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"))
    s = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
    rank = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    s = s.withColumns({
        "total": F.sum("source_size").over(everything).cast("double"), "weights": F.sum("weight").over(everything),
        "caps_to": F.sum("cap").over(rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)), "weights_to": F.sum("weight").over(rank.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    })
    # the level, if all sources before this one are capped and this one isn't; the first source that then stays below its cap gives the true one
    s = s.withColumn("level", (F.col("total") - (F.col("caps_to") - F.col("cap"))) / (F.col("weights") - (F.col("weights_to") - F.col("weight"))))
    s = s.withColumn("place", F.row_number().over(rank))
    s = s.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))).over(everything)["level"])
    return s.select("source", "source_size", F.least("cap", F.col("weight") * F.coalesce("level", F.col("cap") / F.col("weight"))).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every document."""
    sized = written(_sizes(docs, text_col, source_col, id_col, seed), "sizes")
    digits = max(1, math.ceil(math.log(max(sized.count() / ROWS, 1), 16)))  # how the draw is cut; no result depends on it
    bucket: Column = F.substring("draw", 1, digits)
    cells = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
    plan = targets(cells.groupBy("source").agg(F.sum("size").alias("source_size")), epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = written(plan.withColumn("whole", whole).withColumn("rest", (F.floor(F.col("target") + 0.5) - F.col("whole") * F.col("source_size")).cast("long")), "plan")
    # words before each bucket of a source, in the order of the draw
    before = F.sum("size").over(Window.partitionBy("source").orderBy("bucket")) - F.col("size")
    edges = cells.withColumn("before", before).join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    edges = written(edges.select("source", "bucket", "before", F.when(F.col("before") >= F.col("rest"), F.lit("none")).when(F.col("before") + F.col("size") <= F.col("rest"), F.lit("all")).otherwise(F.lit("part")).alias("draws"), "whole", "rest", "source_size", "target"), "edges")
    joined = sized.withColumn("bucket", bucket).alias("d").join(edges.alias("e"), (F.col("d.bucket") == F.col("e.bucket")) & F.col("d.source").eqNullSafe(F.col("e.source"))).select("d.doc_id", "d.source", "d.size", "d.draw", "d.bucket", "before", "draws", "whole", "rest", "source_size", "target")
    out = lambda df, extra: df.select(F.col("doc_id").alias(id_col), "size", "source_size", "target", (F.col("whole") * F.col("size") + extra).cast("long").alias("taken"))
    discard(plan)
    sure = out(joined.where("draws <> 'part'"), F.when(F.col("draws") == "all", F.col("size")).otherwise(F.lit(0)))
    line = Window.partitionBy("source", "bucket").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = joined.where("draws = 'part'").withColumn("ahead", F.col("before") + F.sum("size").over(line) - F.col("size"))
    return sure.union(out(part, F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("ahead")))))


def op9_waterfill(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return mix(table(spark, sf_dir, "documents"))


OP9_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size, md5(concat('{SEED}:', doc_id, ':', md5(text))) AS draw FROM documents),
sources AS (SELECT source, SUM(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM sized GROUP BY source),
weighted AS (SELECT source, source_size, CASE k % 3 WHEN 1 THEN 5.0::DOUBLE WHEN 2 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 3.0::DOUBLE AS cap FROM sources),
summed AS (
  SELECT *, (SUM(source_size) OVER ())::DOUBLE AS total, SUM(weight) OVER () AS weights,
    SUM(cap) OVER r AS caps_to, SUM(weight) OVER r AS weights_to FROM weighted
  WINDOW r AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
levels AS (SELECT *, (total - (caps_to - cap)) / (weights - (weights_to - weight)) AS own, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place FROM summed),
plan AS (
  SELECT source, source_size, LEAST(cap, weight * COALESCE((SELECT own FROM levels WHERE own * weight <= cap ORDER BY place LIMIT 1), cap / weight)) AS target FROM levels),
rested AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM plan),
ahead AS (
  SELECT d.*, p.source_size, p.target, p.whole, CAST(floor(p.target + 0.5) AS BIGINT) - p.whole * p.source_size AS rest,
    SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS ahead
  FROM sized d JOIN rested p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + GREATEST(0, LEAST(size, rest - ahead)) AS BIGINT) AS taken FROM ahead
"""
