"""Session settings and the reliable checkpoint folder."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from uuid import uuid4

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Settings the operators assume.  They change plans, never results.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "tamis", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; make one only where none is named."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tamis-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which driver and executors all reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder, so a lost executor costs one re-read."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release_memory(spark: SparkSession) -> None:
    """Give back what finished jobs have left with the driver: garbage, and freed pages that allocators keep.

    Checkpoints, shuffle files and broadcasts that nothing refers to any more are removed with the
    garbage (Spark itself asks for that every half hour only), so the driver's heap does not grow over
    many jobs, and neither does the disk.  Where a Java or C library has no such call, that part is left out.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    jvm.java.lang.System.gc()
    commands = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    nothing = gateway.new_array(jvm.java.lang.Object, 0), gateway.new_array(jvm.java.lang.String, 0)
    try:
        jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer().invoke(commands, "systemTrimNativeHeap", *nothing)
    except Py4JError:
        pass


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread ``df`` when its scan has fewer splits than the cluster has cores.

    A large table arrives in many splits and is returned untouched; only small
    files that Spark would read with one task pay for the exchange.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def pin(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column whose expression later operators cannot take apart.

    A long CASE would be copied into every filter, key and inferred constraint that
    mentions it.  Behind a one-element generator it is computed once per row and all
    that follows sees a plain column.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.inline(F.array(F.struct(column.alias(name)))))
