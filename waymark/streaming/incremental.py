"""Incremental ingest: a stream of landed records merged into versions of a table, batch by batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import LATEST, merge


BUCKETS = 64


def _folders(spark: SparkSession, path: str, before: int | None = None) -> dict[int, list[str]]:
    """The complete folders of each bucket, oldest first; before: of versions below a number only."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    folder = at(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    inside = lambda p, start: sorted(str(s.getPath()) for s in (fs.listStatus(p) if fs.exists(p) else ()) if s.getPath().getName().startswith(start))
    found: dict[int, list[str]] = {}
    for version in inside(folder, "version="):
        if fs.exists(at(version, "_SUCCESS")) and (before is None or int(version.rpartition("=")[2]) < before):
            for bucket in inside(at(version), "bucket="):
                found.setdefault(int(bucket.rpartition("=")[2]), []).append(bucket)
    return found


def _read(spark: SparkSession, folders: Sequence[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def latest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest complete version of every bucket; an empty table before the first."""
    return _read(spark, [own[-1] for own in _folders(spark, path).values()], schema)


def merge_stream(records: DataFrame, path: str, schema: str, key: Sequence[str], order: str, checkpoint: str, policies: Mapping[str, str] | None = None, default: str = LATEST, kept: int = 2, buckets: int = BUCKETS) -> StreamingQuery:
    """Merges each micro-batch into the table at path, whose rows lie in buckets by a hash of the key.

    A batch writes a new version (version=N/bucket=B) of the buckets that it has keys of, and of no
    others. Of several records with one key in a batch the last by `order` counts. A batch that is run
    again after a failure writes the version of its own number again from the ones before it, so every
    record counts once. Of each bucket the last `kept` versions stay, two at least: that of the batch
    and the one it came from. The number of buckets stays what it was when the table began.
    """
    kept = max(kept, 2)

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        kinds = dict(spark.createDataFrame([], schema).dtypes)
        names = list(kinds)
        bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("bucket")
        last = Window.partitionBy(*key).orderBy(F.col(order).desc())
        # the hash of a key depends on its type, so keys have the table's
        new = batch.withColumns({k: F.col(k).cast(kinds[k]) for k in key}).withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n", *([] if order in names else [order])).persist()
        touched = [r.bucket for r in new.select(bucket).distinct().collect()]  # at most as many as there are buckets
        if touched:
            before = _folders(spark, path, number)
            old = _read(spark, [before[b][-1] for b in touched if b in before], schema)
            merged = merge(old, new, key, policies, default).select(*names).withColumn("bucket", bucket)
            merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path.rstrip('/')}/version={number:08d}")
            for own in _folders(spark, path).values():
                for stale in own[:-kept]:
                    at = spark._jvm.org.apache.hadoop.fs.Path(stale)
                    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        new.unpersist()

    return records.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str = "ts", kind: str = "event_type", late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts by window and kind; late rows are taken up to the watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")
