"""A stored inverted index: posting lists in folders by token, document frequencies, loads added one by one.

    postings/bucket=B/  token, load, block, n, ids   sorted ids of one load, at most BLOCK a row
    terms/bucket=B/     token, load, n               documents of the load with the token
    replaced/           id, load                     documents that a later load brings anew

A token's folder follows from its first two letters, so a search for a word, or for the beginning of
words, reads one folder of each table. A search takes the rarest word's documents first and keeps those
that have the others too. Loads only add files; compact writes all anew without what was replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import search
from .numbering import shared_path, written

BUCKETS, BLOCK, LEAD, SPREAD = 64, 4096, 2, 8


def bucket_of(token: Column) -> Column:
    return F.pmod(F.xxhash64(F.left(token, F.lit(LEAD))), F.lit(BUCKETS)).cast("int")


class StoredIndex:
    def __init__(self, spark: SparkSession, path: str, id_: str, id_type: str) -> None:
        self.spark, self.path, self.id, self.id_type = spark, path, id_, id_type

    def _read(self, table: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")

    def postings(self) -> DataFrame:
        return self._read("postings", f"token string, load int, block int, n bigint, ids array<{self.id_type}>, bucket int")

    def terms(self) -> DataFrame:
        return self._read("terms", "token string, load int, n bigint, bucket int")

    def replaced(self) -> DataFrame:
        """id, load: the last load of each document that came more than once; there may be none."""
        return self._read("replaced", f"id {self.id_type}, load int")

    def _loads(self) -> int:
        return (self._read("loads", "load int, n bigint").agg(F.max("load")).first()[0] or 0) if self._exists("loads") else 0

    def _exists(self, table: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def add(self, rows: DataFrame, columns: Sequence[str]) -> int:
        """Adds documents; one that is there already is replaced. Returns the load's number."""
        load = self._loads() + 1
        own = rows.where(F.col(self.id).isNotNull())
        ids = written(own.select(F.col(self.id).cast(self.id_type).alias("id")).distinct(), "ids")
        if load > 1:
            known = self._read("documents", f"id {self.id_type}, load int")
            ids.join(known.select("id").distinct(), "id", "left_semi").select("id", F.lit(load).alias("load")).write.mode("append").parquet(f"{self.path}/replaced")
        words = own.select(F.col(self.id).cast(self.id_type).alias("id"), search.tokens(columns).alias("tokens"))
        pairs = written(words, "tokens").select("id", F.explode("tokens").alias("token"))
        counts = pairs.groupBy("token").agg(F.count("*").alias("n"))
        self._write_lists(pairs, counts, load)
        ids.select("id", F.lit(load).alias("load")).write.mode("append").parquet(f"{self.path}/documents")
        ids.agg(F.lit(load).alias("load"), F.count("*").alias("n")).write.mode("append").parquet(f"{self.path}/loads")
        return load

    def _write_lists(self, pairs: DataFrame, counts: DataFrame, load: int) -> None:
        """Adds the load's postings and terms from (id, token) and (token, n), n being at least the token's documents.

        A common token's list is cut into blocks by the ids' hashes, as many as its frequency asks for, and
        its blocks are written by several tasks. Only common tokens are joined to the pairs, which are
        shuffled once; equal pairs fall together in their block.
        """
        common = written(counts.where(F.col("n") > BLOCK / 2).select("token", F.ceil(F.col("n") / (BLOCK / 2)).cast("int").alias("blocks")), "common")
        block = F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.col("blocks"))).cast("int").alias("block")
        lists = pairs.join(common, "token", "left").select("token", "id", block).groupBy("token", "block").agg(F.array_distinct(F.array_sort(F.collect_list("id"))).alias("ids"))
        out = lists.select("token", F.lit(load).alias("load"), "block", F.size("ids").cast("bigint").alias("n"), "ids", bucket_of(F.col("token")).alias("bucket"))
        out.repartition("bucket", F.col("block") % SPREAD).sortWithinPartitions("token").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/postings")
        terms = self.postings().where(F.col("load") == load).groupBy("bucket", "token").agg(F.sum("n").alias("n"))
        terms.select("token", F.lit(load).alias("load"), "n", "bucket").repartition("bucket").sortWithinPartitions("token").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/terms")

    def _of(self, table: DataFrame, word: str) -> DataFrame:
        """Rows of the tokens that a word means: itself or, with a star, those that it begins."""
        begin = word[:-1] if word.endswith("*") else word
        rows = table.where(F.startswith("token", F.lit(begin)) if word.endswith("*") else F.col("token") == begin)
        if len(begin) < LEAD and word.endswith("*"):
            return rows  # the beginning of words in any folder
        bucket = self.spark.range(1).select(bucket_of(F.lit(begin))).first()[0]
        return rows.where(F.col("bucket") == bucket)

    def _current(self, ids: DataFrame) -> DataFrame:
        """(id) of (id, load) rows without those that a later load replaced."""
        if not self._exists("replaced"):
            return ids.select("id").distinct()
        last = self.replaced().groupBy("id").agg(F.max("load").alias("last"))
        return ids.join(last, "id", "left").where("last is null or load >= last").select("id").distinct()

    def frequencies(self, words: Sequence[str]) -> dict[str, int]:
        """Documents of each word over all loads, an upper bound where documents were replaced."""
        return {w: self._of(self.terms(), w).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for w in words}

    def documents_of(self, word: str) -> DataFrame:
        return self._current(self._of(self.postings(), word).select("load", F.explode("ids").alias("id")))

    def search(self, query: str) -> DataFrame:
        """(id) of documents with all words of the query; a word with a star stands for its beginnings."""
        words = search._words_of(self.spark, query)
        counts = self.frequencies(words)
        if not words or not all(counts.values()):
            return self.spark.createDataFrame([], f"{self.id} {self.id_type}")
        lists = [self.documents_of(w) for w in sorted(words, key=lambda w: (counts[w], w))]
        return reduce(lambda a, b: a.join(b, "id", "left_semi"), lists).withColumnRenamed("id", self.id)

    def compact(self) -> StoredIndex:
        """The same index as one load in a fresh folder, without replaced documents."""
        fresh = StoredIndex(self.spark, shared_path(self.spark, "index"), self.id, self.id_type)
        ids = self.postings().select("token", "load", F.explode("ids").alias("id"))
        if self._exists("replaced"):
            last = self.replaced().groupBy("id").agg(F.max("load").alias("last"))
            ids = ids.join(last, "id", "left").where("last is null or load >= last")
        fresh._write_lists(ids.select("id", "token"), self.terms().groupBy("token").agg(F.sum("n").alias("n")), 1)
        documents = self._read("documents", f"id {self.id_type}, load int").select("id").distinct().select("id", F.lit(1).alias("load"))
        documents.write.parquet(f"{fresh.path}/documents")
        documents.agg(F.lit(1).alias("load"), F.count("*").alias("n")).write.parquet(f"{fresh.path}/loads")
        return fresh


def build(rows: DataFrame, id_: str, columns: Sequence[str], path: str | None = None) -> StoredIndex:
    """An index of the rows' columns, written to the path or to a fresh folder of the shared one."""
    kind = rows.schema[id_].dataType.simpleString()
    index = StoredIndex(rows.sparkSession, path or shared_path(rows.sparkSession, "index"), id_, kind)
    index.add(rows, columns)
    return index
