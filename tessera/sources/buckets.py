"""A keyed state table on plain Parquet that survives a crash at any point.

``data/bucket=b/version=v`` holds the whole of bucket ``b`` (a hash of one key column) as of
version ``v``; ``manifest/version=v`` lists the buckets that version ``v`` wrote, and is written
after them. A reader takes each bucket's latest listed version. An upsert rewrites only
the buckets that have new rows, and repeating a version replaces what it wrote before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import path_exists
from .upsert import upsert_latest

BUCKETS = 64


def _latest(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """(bucket, version): the latest listed version of each bucket, older than ``before``."""
    listed = spark.read.schema("bucket int, version long").parquet(f"{path}/manifest")
    if before is not None:
        listed = listed.where(F.col("version") < before)
    return listed.groupBy("bucket").agg(F.max("version").alias("version"))


def read(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The table with its ``bucket`` and ``version``, or None before the first upsert."""
    if not path_exists(spark, f"{path}/manifest"):
        return None
    return spark.read.parquet(f"{path}/data").join(_latest(spark, path, before), ["bucket", "version"], "left_semi")


def upsert(batch: DataFrame, path: str, keys: list[str], bucket_key: str, version: int, buckets: int = BUCKETS) -> None:
    """Merge ``batch`` as ``version`` (ascending); of equal keys the later version wins."""
    spark = batch.sparkSession
    new = (batch.withColumn("bucket", F.pmod(F.xxhash64(bucket_key), F.lit(buckets)).cast("int"))
           .withColumn("version", F.lit(version).cast("long")).persist())
    touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
    old = read(spark, path, version)
    if touched:
        merged = new
        if old is not None:
            merged = upsert_latest(old.where(F.col("bucket").isin(touched)), new, ["bucket", *keys], ["version"])
        _put(merged.withColumn("version", F.lit(version).cast("long")), f"{path}/data", ["bucket", "version"])
    _put(spark.createDataFrame([(b, version) for b in touched], "bucket int, version long"), f"{path}/manifest", ["version"])
    new.unpersist()


def _put(df: DataFrame, path: str, by: list[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
