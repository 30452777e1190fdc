"""Folders shared by all executors, and tables written there to cut lineage."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A fresh path in the folder that spark.checkpoint.dir names; in local mode a temporary one where it is unset."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="waymark-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/waymark-{uuid.uuid4().hex}"


def persisted(df: DataFrame, tag: str = "table") -> DataFrame:
    """The rows as a Parquet table in the shared folder: later stages survive lost executors and do not recompute."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one operator in the shared folder, deleted as soon as nothing reads them any more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.root, self.paths = spark, shared_dir(spark), {}

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        path = f"{self.root}/{len(self.paths):03d}-{tag}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[out] = path
        return out

    def sweep(self) -> None:
        """Lets Spark's cleaner delete the shuffle files of steps that are kept as tables and no longer referred to."""
        for _ in range(2):  # what the first round lets go of is found by the second
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.3)

    def drop(self, *frames: DataFrame | None) -> None:
        for df in frames:
            if df is not None and (path := self.paths[df]):
                at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
                self.paths[df] = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow(schema: str, **columns) -> pa.RecordBatch:
    """A batch from name=array pairs, typed by a list like 'doc_id long, text string'."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in list(kinds.items())}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([x if isinstance(x := columns[k], pa.Array) and x.type == kinds[t] else pa.array(x, kinds[t]) if not isinstance(x, pa.Array) else x.cast(kinds[t]) for k, t in fields], names=[k for k, _ in fields])


def id_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.int64())
