"""Merge policies: how a new version of a table takes over an older one, column by column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LATEST, EXISTING, OVERWRITE, KEEP, APPEND = "latest-non-null", "existing-non-null", "overwrite", "keep", "append"


def _value(policy: str, old: Column, new: Column, has_new: Column, has_old: Column) -> Column:
    if policy == LATEST:
        return F.coalesce(new, old)
    if policy == EXISTING:
        return F.coalesce(old, new)
    if policy == OVERWRITE:
        return F.when(has_new, new).otherwise(old)
    if policy == KEEP:
        return F.when(has_old, old).otherwise(new)
    if policy == APPEND:
        return F.when(old.isNull() & new.isNull(), None).otherwise(F.array_union(F.coalesce(old, F.array().cast("array<string>")), F.coalesce(new, F.array().cast("array<string>"))))
    raise ValueError(f"unknown policy {policy!r}")


def merge(old: DataFrame, new: DataFrame, key: Sequence[str], policies: Mapping[str, str] | None = None, default: str = LATEST) -> DataFrame:
    """One full outer join on the key; each other column follows its policy. Keys are unique on either side."""
    policies = policies or {}
    a, b = old.withColumn("_has", F.lit(True)).alias("old"), new.withColumn("_has", F.lit(True)).alias("new")
    joined = a.join(b, reduce(lambda x, y: x & y, (F.col(f"old.{k}") == F.col(f"new.{k}") for k in key)), "full_outer")
    has_old, has_new = F.col("old._has").isNotNull(), F.col("new._has").isNotNull()
    columns = list(dict.fromkeys([*old.columns, *new.columns]))

    def side(name: str, df: DataFrame, alias: str) -> Column:
        return F.col(f"{alias}.{name}") if name in df.columns else F.lit(None)

    rest = [_value(policies.get(c, default), side(c, old, "old"), side(c, new, "new"), has_new, has_old).alias(c) for c in columns if c not in key]
    return joined.select(*(F.coalesce(F.col(f"old.{k}"), F.col(f"new.{k}")).alias(k) for k in key), *rest)


def insert_ignore(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Old rows, and the first new row of each key that is not there yet."""
    first = new.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")
    return old.unionByName(first.join(old.select(*key), list(key), "left_anti").select(*old.columns))


def identity(national: Column, registry: Column) -> Column:
    """The key by which records of one person meet: the national number if there is one, else the registry's."""
    filled = lambda c: F.nullif(F.trim(c.cast("string")), F.lit(""))
    return F.coalesce(F.concat(F.lit("oib:"), filled(national)), F.concat(F.lit("reg:"), filled(registry)))


def resolve_identities(known: DataFrame, rows: DataFrame, order: str, slug: str = "slug", national: str = "oib", registry: str = "registry_id") -> DataFrame:
    """The rows of a load with the slugs that their persons have, or new ones that nobody has.

    A row with a national number is the known person of that number, one without is the known person of
    its registry number; it takes over that person's slug, whatever its own proposal in column slug is.
    Rows of one person get one slug, proposed by the first of them in the order. A proposal that is
    taken, or made for several persons, gets the next free number behind it, in the order of the persons.
    """
    key = identity(F.col(national), F.col(registry))
    had = known.select(F.explode(F.array(F.struct(identity(F.col(national), F.lit(None)).alias("p"), F.col(slug).alias("s")), F.struct(identity(F.lit(None), F.col(registry)).alias("p"), F.col(slug).alias("s")))).alias("k")).select("k.*").where("p is not null")
    had = had.groupBy("p").agg(F.min("s").alias("_had"))
    asked = rows.withColumn("_person", key)
    persons = asked.groupBy("_person").agg(F.min_by(slug, order).alias("_wish"), F.min(order).alias("_order")).join(had, F.col("_person") == F.col("p"), "left").drop("p")
    end = lambda c: F.struct(F.regexp_extract(c, "^(.*)-([0-9]+)$", 1).alias("base"), F.regexp_extract(c, "^(.*)-([0-9]+)$", 2).try_cast("bigint").alias("n"), F.lit(False).alias("whole"))
    whole = F.struct(F.col(slug).alias("base"), F.lit(1).cast("bigint").alias("n"), F.lit(True).alias("whole"))
    fresh = persons.where("_had is null")
    taken = known.select(F.explode(F.array(whole, end(F.col(slug)))).alias("t")).unionByName(fresh.select(end(F.col("_wish")).alias("t"))).select("t.*").where("n is not null").groupBy("base").agg(F.max("n").alias("_last"), F.bool_or("whole").alias("_whole"))
    turn = F.row_number().over(Window.partitionBy("_wish").orderBy("_order", "_person")) - F.when(F.coalesce("_whole", F.lit(False)), 0).otherwise(1)
    fresh = fresh.join(taken, F.col("_wish") == F.col("base"), "left").withColumn("_turn", turn).withColumn("_n", F.when(F.col("_turn") == 0, 1).otherwise(F.coalesce("_last", F.lit(1)) + F.col("_turn")))
    given = fresh.select("_person", F.when(F.col("_n") == 1, F.col("_wish")).otherwise(F.concat("_wish", F.lit("-"), "_n")).alias("_slug")).unionByName(persons.where("_had is not null").select("_person", F.col("_had").alias("_slug")))
    return asked.join(given, "_person").withColumn(slug, F.col("_slug")).select(*rows.columns)


def collapse(rows: DataFrame, key: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """One row a key: of each column the first value, in the given order, that is neither null nor empty."""
    return rows.groupBy(*key).agg(*(F.expr(f"min_by(`{c}`, `{order}`) filter (where `{c}` is not null and cast(`{c}` as string) <> '')").alias(c) for c in columns))


def provenance(old: Column, new: Column) -> Column:
    """A JSON array of source tags with one more appended if absent; malformed text starts anew."""
    known = F.coalesce(F.from_json(old, "array<string>"), F.array().cast("array<string>"))
    return F.to_json(F.array_union(F.filter(known, lambda t: t.isNotNull()), F.array(new)))


def without_consumed(queue: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    """What is left of a queue when the matched rows are taken out."""
    return queue.join(done.select(*key), list(key), "left_anti")


def mark_duplicates(persons: DataFrame) -> DataFrame:
    """Adds duplicate_of: among active persons without a national number that agree in kind, name, city and
    address, all but the earliest registered point to its registry_id. Nulls agree with nulls."""
    active = F.coalesce(F.col("registry_status").ilike("AKTIV%"), F.lit(True)) & F.nullif(F.trim("oib"), F.lit("")).isNull()
    # rows outside the active set are each a group of their own
    own = Window.partitionBy(F.when(active, F.lit(None)).otherwise(F.col("registry_id")), active, "kind", "name", "city", "address")
    order = [F.col(c).asc_nulls_first() for c in ("registered_at", "registry_no", "registry_id")]
    first = F.first_value("registry_id").over(own.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return persons.drop("duplicate_of").withColumn("duplicate_of", F.when(active & (F.col("registry_id") != first), first))


def active_distinct(status: Column, duplicate_of: Column) -> Column:
    return (status.isNull() | status.ilike("AKTIV%")) & duplicate_of.isNull()
