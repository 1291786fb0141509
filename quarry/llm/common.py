"""Helpers shared by the corpus operators: table access, shared checkpoints, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

#: Text handed to numpy at once; one longer text makes a piece of its own.
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one made here where it is unset and the master is local, as in tests."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context._jsc.sc().getCheckpointDir().getOrElse(None)
    if not found:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="quarry-checkpoint-")
        context.setCheckpointDir(found)
    return found


def trimmed(spark: SparkSession) -> bool:
    """Hands memory that the driver's JVM has freed outside its heap (compilers, codecs) back to the system; whether this JVM can.

    glibc keeps it in an arena for each thread, where it adds up over many jobs: no limit of the heap bounds it.
    """
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    try:
        name, of = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), jvm.java.lang.Class.forName
        kinds, args = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
        for k, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[k] = of(kind)
        args[0], args[1], args[2], args[3] = name, "systemTrimNativeHeap", array(jvm.java.lang.Object, 0), array(jvm.java.lang.String, 0)
        # by the public interface: the server's own class is closed to reflection
        of("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:  # another C library or an older JVM
        return False
    return True


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder and cut the lineage there; survives the loss of an executor."""
    shared_dir(df.sparkSession)
    done = df.checkpoint(eager=True)
    trimmed(df.sparkSession)
    return done


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    held.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(held)
    return path


def written(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write a compact table to the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.option("compression", compression).parquet(path)
    trimmed(spark)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of fewer rows for what is materialised inside, so that long texts stay small on both sides of the pipe."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of a batch whose texts hold `most` bytes at most, or one row."""
    sizes = batch.column(column).nbytes
    if sizes <= most:
        if batch.num_rows:
            yield 0, batch.num_rows
        return
    import numpy as np
    import pyarrow.compute as pc

    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    ends = np.cumsum(lengths)
    a = 0
    while a < len(lengths):
        floor = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, floor + most, side="right")))
        yield a, b
        a = b


def id_and_text(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "text")
