"""Parquet table access and the mapping of the test tables onto the data model.

The reference works on interaction logs, product catalogues, rating tables and
labelled texts; the test data plays those parts as follows (fixed mapping):

* interactions: ``events`` — user ``user_id``, item ``props.k``, type ``event_type``
* catalogue:    ``part``   — category ``p_type``, price ``p_retailprice``,
  text features ``p_name p_brand p_type``, tags = the words of ``p_name``
* ratings:      ``orders ⋈ lineitem`` — user ``o_custkey``, item ``l_partkey``,
  rating ``ceil(l_quantity / 10)`` (1..5)
* labelled text: ``documents`` (``lang``) and ``documents ⋈ labels``
* chat turns:   ``conversations``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).events`` reads one parquet table."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.read(name)
        raise AttributeError(name)


def interactions(events: DataFrame) -> DataFrame:
    """Interaction log view of ``events``: (event_id, user_id, item_id, interaction_type, ts)."""
    return events.select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.col("event_type").alias("interaction_type"),
        "ts",
    )


def catalog(part: DataFrame) -> DataFrame:
    """Catalogue view of ``part``: (item_id, name, category, price, features, tags)."""
    return part.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("features"),
        F.col("p_name").alias("tags"),
    )


def ratings(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Rating view: (rid, user_id, item_id, rating 1..5, ts) from orders ⋈ lineitem.

    ``rid`` ("orderkey-linenumber") identifies a rating row for hashing splits.

    Both sides are fact tables; the join shuffles on the order key (no broadcast),
    and only the four needed columns are read from parquet.
    """
    o = orders.select(F.col("o_orderkey"), F.col("o_custkey").alias("user_id"),
                      F.col("o_orderdate").alias("ts"))
    li = lineitem.select(F.col("l_orderkey").alias("o_orderkey"),
                         F.concat_ws("-", "l_orderkey", "l_linenumber").alias("rid"),
                         F.col("l_partkey").alias("item_id"),
                         F.ceil(F.col("l_quantity") / 10).cast("int").alias("rating"))
    return li.join(o, "o_orderkey").select("rid", "user_id", "item_id", "rating", "ts")
