"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# functions of this subpackage go to the tasks by value, so executors needn't have it installed
cloudpickle.register_pickle_by_value(sys.modules[__package__])

#: One separator run: space and the characters \x09 to \x0D, no other white space.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The given columns of a Parquet table; only they are read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``, which all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back: the lineage is cut, and a
    lost executor costs a reread of the files, not the work before them."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """``df`` with a broadcast hint if a count finds at most ``max_rows`` rows.

    Beyond the bound ``df`` comes back as it is and Spark shuffles the join: the
    result is the same, only the physical join differs. ``df`` should be narrow
    (ids and hashes) and cheap to count, as a materialised table is.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def words(text: Column) -> Column:
    """Maximal runs of characters that are no separator; null stays null."""
    return F.array_remove(F.split(text, SPACE, -1), "")


def once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row. Catalyst may put the expression of
    a column where the column is read, also inside a lambda, where it would be
    computed for every element; a lambda's own variable can't be replaced so."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def runs(tokens: Column, size: int) -> Column:
    """For every token the struct of it and the ``size - 1`` tokens after it, null past the
    end. Unlike a lambda over positions this is compiled code; ``inline_outer`` makes
    rows of it (the plain form has Catalyst infer a filter that computes the array twice)."""
    parts = [tokens] + [F.slice(tokens, k + 1, F.size(tokens)) for k in range(1, size)]
    return F.arrays_zip(*[p.alias(f"w{k}") for k, p in enumerate(parts)])


def windows(tokens: Column, size: int, of) -> Column:
    """``of([tokens])`` for every window of ``size`` tokens; empty where there are fewer."""
    def body(t: Column) -> Column:
        every = F.transform(t, lambda x, i: of([x] + [F.get(t, i + k) for k in range(1, size)]))
        return F.slice(every, F.lit(1), F.greatest(F.size(t) - size + 1, F.lit(0)))

    return once(tokens, body)


def fresh(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def key_of(value: Column) -> Column:
    """A string that is equal for equal values, never null, and sorts null first, then the
    values as strings by their UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def ranked(df: DataFrame, group: str, order: list, what: str, weight: str | None = None) -> DataFrame:
    """``df`` with ``before``, the number of rows (or the sum of ``weight``) ahead of a row in
    its ``group`` by ``order``, and ``total``, that of the whole group.

    No group is sorted in one task: the rows are dealt by ranges of (group, order, own
    number), each range is sorted and written with its rows' positions, and a small table of
    (group, range) carries the sums over. Rows equal in ``order`` keep the order of the scan.
    """
    own, at, part = fresh("own", df), fresh("at", df), fresh("part", df)
    keys = [F.col(group), *order, F.col(own)]
    dealt = df.withColumn(own, F.monotonically_increasing_id()).repartitionByRange(*keys)
    rows = materialize(dealt.sortWithinPartitions(*keys).withColumn(at, F.monotonically_increasing_id()).drop(own), what)
    rows = rows.withColumn(part, F.shiftright(at, 33))  # the position's upper bits number the range
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    runs = rows.groupBy(group, part).agg(F.min(at).alias("first"), size.alias("size"))
    every = Window.partitionBy(group)
    runs = runs.select(F.col(group).alias("run_group"), F.col(part).alias("run_part"), "first",
                       (F.sum("size").over(every.orderBy(part)) - F.col("size")).alias("start"),
                       F.sum("size").over(every).alias("total"))
    runs = broadcast_if_small(materialize(runs, f"{what}-runs"))
    within = (F.col(at) - F.col("first") if weight is None else
              F.sum(weight).over(Window.partitionBy(group, part).orderBy(at)) - F.col(weight))
    joined = rows.join(runs, (F.col(group) == F.col("run_group")) & (F.col(part) == F.col("run_part")))
    return joined.withColumn("before", F.col("start") + within).drop(at, part, "run_group", "run_part", "first", "start")
