"""Readers: tables of the test data, the trade tape mapped onto them, inline rows, files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal(v) -> str:
    """A value in SQL that both engines read alike."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    if isinstance(v, int):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def values_sql(columns: str, rows: list[tuple]) -> str:
    """(VALUES ...) AS t(columns) for a query's FROM clause."""
    return "(VALUES " + ", ".join("(" + ", ".join(literal(v) for v in r) + ")" for r in rows) + f") AS t({columns})"


def inline(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """Inline rows as a local relation; backslashes are kept as they are."""
    text = values_sql(columns, rows).replace("\\", "\\\\")
    return spark.sql(f"SELECT * FROM {text}")


def bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bond terms: one per customer."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("bond_id"), (F.col("c_acctbal") / 100000).alias("coupon"), F.lit(2).alias("frequency"), (F.col("c_nationkey") % 12).alias("months"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade tape: one trade per event, ordered by event id."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        "event_id", F.upper("event_type").alias("desk"), F.concat(F.lit("T"), F.col("user_id") % 5).alias("trader"), F.col("user_id").alias("bond_id"),
        F.when(k % 2 == 0, "BUY").otherwise("SELL").alias("side"), k.alias("quantity"), F.col("value").alias("clean_price"),
    )


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with a header; malformed rows are dropped, a folder is read recursively."""
    return spark.read.csv(path, header=True, mode="DROPMALFORMED", recursiveFileLookup=True)


def read_json(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    df = spark.read.json(path)
    return df if limit is None else df.limit(limit)


def discover(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """Files below a folder, each path once, sorted, with the content hash that keys the parse cache."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256")).dropDuplicates(["sha256"]).orderBy("path")


def new_files(found: DataFrame, cached: DataFrame) -> DataFrame:
    """Discovered files whose content is not in the cache yet."""
    return found.join(cached.select("sha256"), "sha256", "left_anti")
