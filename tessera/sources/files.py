"""File sources and sinks: CSV, JSON maps and metrics, whole texts, reports, batches, models.

Schemas are given, not inferred, so a scan reads its input once; paths are whatever Spark's
file systems open.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system that Spark uses for it."""
    from pyspark.errors import AnalysisException
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """A CSV table with quoted, possibly multi-line fields; malformed rows fail the read."""
    return (spark.read.schema(schema).option("header", header).option("multiLine", True).option("escape", '"')
            .option("mode", "FAILFAST").csv(path))


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    """Overwrite or append a folder of CSV files, each with a header."""
    (df.write.mode("append" if append else "overwrite").option("header", True).option("escape", '"')
     .option("quoteAll", True).csv(path))


def read_intents(spark: SparkSession, path: str) -> DataFrame:
    """An intents map as rows (intent, examples, responses). A value is an object with
    ``examples`` and ``responses``, or a plain list of examples (then no responses); both forms
    may stand in one file. Anything else fails the read."""
    each = (spark.read.text(path, wholetext=True)
            .select(F.from_json("value", "map<string, string>", {"mode": "FAILFAST"}).alias("m"))
            .select(F.explode("m").alias("intent", "v")))
    full = F.from_json("v", "struct<examples: array<string>, responses: array<string>>")
    plain = F.from_json("v", "array<string>")
    none = F.array().cast("array<string>")
    is_list = F.ltrim("v").startswith("[")
    known = F.when(is_list, plain.isNotNull()).otherwise(full.getField("examples").isNotNull())
    wrong = F.raise_error(F.concat(F.lit("neither a list nor an object with examples: "), F.coalesce("intent", F.lit("null"))))
    return each.select("intent", F.when(~F.coalesce(known, F.lit(False)), wrong).when(is_list, plain)
                       .otherwise(full.getField("examples")).alias("examples"),
                       F.when(is_list, none).otherwise(F.coalesce(full.getField("responses"), none)).alias("responses"))


def write_metrics(spark: SparkSession, metrics: dict[str, float], path: str) -> None:
    """A run's metrics, one number a name, as one JSON line."""
    spark.createDataFrame([Row(value=json.dumps(metrics, sort_keys=True))]).coalesce(1).write.mode("overwrite").text(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(metric, value) rows of a metrics file."""
    return (spark.read.text(path).select(F.from_json("value", "map<string, double>").alias("m"))
            .select(F.explode("m").alias("metric", "value")))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text), one row a file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def write_report(lines: DataFrame, column: str, path: str) -> None:
    """A column as lines of text."""
    lines.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Truncate and load."""
    df.write.mode("overwrite").parquet(path)


def put_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Append a numbered batch; the same number again replaces its rows."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def lookup(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key is in ``keys`` (any number of them)."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def load_or_train(spark: SparkSession, path: str, train: Callable[[], object]):
    """The pipeline model saved at ``path``; trained and saved first if there is none."""
    from pyspark.ml import PipelineModel
    if not path_exists(spark, f"{path}/metadata"):
        train().write().overwrite().save(path)
    return PipelineModel.load(path)
