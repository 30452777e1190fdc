"""Coverage figures, label maps, rankings and gaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coverage(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row of counts, all in one pass."""
    return df.agg(*(F.count_if(c).alias(name) for name, c in conditions.items()))


def by_label(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """(label, n), most first, ties by label; null becomes '?' after grouping."""
    out = df.groupBy(column).agg(F.count("*").alias("n")).select(F.coalesce(F.col(column).cast("string"), F.lit("?")).alias("label"), "n").orderBy(F.col("n").desc(), "label")
    return out if k is None else out.limit(k)


def label_map(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """One row: a map from label to count. The labels are those of a closed vocabulary, or the k most frequent."""
    return by_label(df, column, k).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias("counts"))


def without_children(parents: DataFrame, children: DataFrame, key: str, foreign: str, condition: Column | None = None) -> DataFrame:
    """Parents that no child, or no child of the kind, points to."""
    return parents.join((children if condition is None else children.where(condition)).select(F.col(foreign).alias(key)), key, "left_anti")


def child_counts(parents: DataFrame, children: DataFrame, key: str, foreign: str, name: str = "n_children") -> DataFrame:
    return parents.join(children.groupBy(F.col(foreign).alias(key)).agg(F.count("*").alias(name)), key, "left").na.fill(0, [name])


def first_child(children: DataFrame, foreign: str, order: Sequence[str]) -> DataFrame:
    return children.withColumn("_n", F.row_number().over(Window.partitionBy(foreign).orderBy(*order))).where("_n = 1").drop("_n")


def child_list(children: DataFrame, foreign: str, flag: str, name: str, fields: Sequence[str]) -> DataFrame:
    """(foreign, items): children as structs, flagged ones first, then by name."""
    item = F.struct((-F.col(flag).cast("int")).alias("_f"), F.col(name).alias("_n"), F.struct(*fields).alias("v"))
    return children.groupBy(foreign).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"]).alias("items"))


def deciles(df: DataFrame, score: str) -> DataFrame:
    return df.groupBy((F.floor(F.col(score) / 10) * 10).alias("bucket")).agg(F.count("*").alias("n"))


def bars(labels: DataFrame, k: int) -> DataFrame:
    """(label, n, share): the k greatest, '?' left out, scaled to the first with at least 2 per cent."""
    top = labels.where("label <> '?'").orderBy(F.col("n").desc(), "label").limit(k)
    return top.crossJoin(F.broadcast(top.agg(F.max("n").alias("_m")))).select("label", "n", F.greatest(F.lit(2.0), 100.0 * F.col("n") / F.col("_m")).alias("share"))


def percent(part: Column, whole: Column) -> Column:
    """'12.3 %' with one digit, a dash where the whole is zero."""
    return F.coalesce(F.concat(F.format_number(F.try_divide(100.0 * part, whole), 1), F.lit(" %")), F.lit("—"))


def distance_histogram(df: DataFrame, km: str, limits: Sequence[float]) -> DataFrame:
    """(limit_km, n): rows beyond each limit, in one pass."""
    one = df.agg(*(F.count_if(F.col(km) > v).alias(f"c{k}") for k, v in enumerate(limits)))
    return one.select(F.inline(F.array(*(F.struct(F.lit(float(v)).alias("limit_km"), F.col(f"c{k}").alias("n")) for k, v in enumerate(limits)))))
