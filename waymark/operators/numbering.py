"""Row numbers in a global order without a single task: ranges, a count for each range, prefix sums joined back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the folder that spark.checkpoint.dir names; in local mode a temporary one where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="waymark-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/waymark-{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str = "table") -> DataFrame:
    """The rows as a Parquet table in the shared folder: what reads them survives lost executors and computes nothing twice."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """The rows dealt to as many tasks as shuffles have, however small they are: for work that is much more than its bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def numbered(df: DataFrame, order: Sequence[Column | str], groups: Sequence[str] = (), name: str = "place", start: int = 1) -> DataFrame:
    """The rows with a bigint place that counts from start in the order, anew in each group (columns of df, nulls being a group).

    Rows are dealt by ranges of groups and order, so a group of any size spreads over tasks; each
    range is sorted, numbered and written once, since its bounds come from a sample and must not be
    drawn again. A table with a row for each range and group then holds what stands before it.
    Rows equal in order have places in no fixed order among each other; an empty table stays empty.
    """
    sort = [*groups, *order]
    spread = df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_row", F.monotonically_increasing_id())
    table = written(spread, "ranges").withColumn("_range", F.shiftright("_row", 33))
    keys = {f"_g{k}": F.col(g) for k, g in enumerate(groups)}
    counts = table.withColumns(keys).groupBy("_range", *keys).agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    ranges = Window.partitionBy(*keys or [F.lit(0)]).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(ranges), F.lit(0))).drop("_n").withColumnRenamed("_range", "_r")
    met = F.col("_range") == F.col("_r")
    for k, g in enumerate(groups):
        met &= F.col(g).eqNullSafe(F.col(f"_g{k}"))
    place = (F.col("_row") - F.col("_first") + F.col("_before") + start).alias(name)
    return table.join(before, met).select(*(table[f"`{c}`"] for c in df.columns), place)
