"""Shared plumbing of the training-data operators: shared-folder tables and Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper bound of one Arrow batch handed to a Python worker.
ARROW_BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's checkpoint folder.

    Where none is set a new local folder is made in local mode only, as executors
    of a cluster would each see a folder of their own; there it is an error.
    """
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="foliospark-")
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


class Scratch:
    """Intermediate tables in the shared folder.

    Writing a table cuts the lineage: a lost executor costs its running tasks
    only, since every finished step can be read again from shared storage.
    Opening one also bounds the session's Arrow batches, as rows may be long.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
        for key, value in (
            ("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES)),
            ("spark.sql.execution.arrow.maxRecordsPerBatch", "2000"),
        ):
            spark.conf.set(key, value)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        """As ``save``; the shuffle files behind the table go at once, as nothing reads them again."""
        key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "true")
        try:
            return self.save(df, name)
        finally:
            self.spark.conf.set(key, before)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Null text counts as the empty text."""
    return F.coalesce(df[text_col], F.lit(""))


def binary_column(values: list[bytes]) -> pa.Array:
    return pa.array(values, type=pa.binary())


def signed(values: np.ndarray) -> np.ndarray:
    return np.asarray(values, dtype=np.uint64).view(np.int64)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def task_id() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def squeeze(keys: np.ndarray, *arrays: np.ndarray) -> bytes:
    """A block: differences of the sorted keys and further arrays, byte plane by byte plane."""
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in (np.diff(keys, prepend=0), *arrays)]
    return len(keys).to_bytes(8, "little") + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unsqueeze(block: bytes, *types) -> list[np.ndarray]:
    n, types = int.from_bytes(block[:8], "little"), [np.dtype(t) for t in (np.int64, *types)]
    flat = np.frombuffer(pa.decompress(block[8:], n * sum(t.itemsize for t in types), codec="zstd", asbytes=True), dtype=np.uint8)
    out, at = [], 0
    for t in types:
        out.append(np.ascontiguousarray(flat[at : at + n * t.itemsize].reshape(t.itemsize, n).T).view(t).reshape(n))
        at += n * t.itemsize
    return [np.cumsum(out[0]), *out[1:]]


def dealt(keys: np.ndarray, shards: int, *arrays: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(shard, block) of the rows of each shard."""
    order = np.argsort(keys, kind="stable")
    owner = (keys[order] % shards).astype(np.int32)
    order, owner = order[(at := np.argsort(owner, kind="stable"))], owner[at]
    cuts = np.flatnonzero(owner[1:] != owner[:-1]) + 1
    for s, e in zip([0, *cuts], [*cuts, len(owner)] if len(owner) else []):
        part = order[s:e]
        yield int(owner[s]), squeeze(keys[part], *[x[part] for x in arrays])
