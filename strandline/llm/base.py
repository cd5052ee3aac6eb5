"""What the corpus operators share: tables, durable intermediate results, bytes of Arrow text columns."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it. Only a local master may do without one."""
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if held.isEmpty():
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="strandline-checkpoint-"))
        held = sc._jsc.sc().getCheckpointDir()
    return named or held.get()


def passing(spark: SparkSession, path: str) -> str:
    """path, whose files go when the driver's JVM ends."""
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    held.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(held)
    return path


def durable(df: DataFrame) -> DataFrame:
    """df, computed once into the shared folder; its lineage ends there, so a lost executor costs one read."""
    passing(df.sparkSession, shared_dir(df.sparkSession) and df.sparkSession.sparkContext._jsc.sc().getCheckpointDir().get())
    return df.checkpoint(eager=True)


def stored(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """As durable(), as compressed Parquet with only the needed columns read back: for wider intermediate tables."""
    path = passing(df.sparkSession, f"{shared_dir(df.sparkSession)}/strandline-{uuid.uuid4().hex}")
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes the files of stored() tables that no later plan reads, and lets Spark's cleaner drop shuffles of finished plans."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        tables[0].sparkSession._jvm.System.gc()


def stored_in_buckets(df: DataFrame, keys: list[str]) -> DataFrame:
    """As stored(), as a table in buckets of the keys, one for each shuffle partition: joins on the keys don't shuffle it."""
    spark = df.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"strandline_{uuid.uuid4().hex}"
    path = passing(spark, f"{shared_dir(spark)}/{name}")
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).format("parquet").option("path", path).saveAsTable(name)
    atexit.register(_drop, spark, name)
    out = spark.table(name)
    out._stored_at = path
    return out


def _drop(spark: SparkSession, name: str) -> None:
    """The table's entry in the catalog goes too; one that ends with the session needs nothing."""
    with contextlib.suppress(Exception):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def apart(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with columns __0, __1, ... that clash with nothing, and the new name of each."""
    names = {c: f"__{k}" for k, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def restored(df: DataFrame, names: dict[str, str], added: list[str]) -> DataFrame:
    """apart() undone, with the added columns; an own column of the same name gives way to an added one."""
    return df.select(*[df[new].alias(old) for old, new in names.items() if old not in added], *added)


def text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes that name a text (null as empty), by built-in functions."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit("strandline"), F.length(t), t).alias("k2")]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column end to end, and its n + 1 offsets; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, name: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have at most `most` bytes together, or one row each; whole rows always."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        end = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + most, "right"))
        end = max(end, begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end
