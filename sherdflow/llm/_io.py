"""Tables, shared storage and numbers of partitions."""

from __future__ import annotations

import gc
import os
import re
import tempfile

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: a table of ids is broadcast up to this many rows (16 bytes each); beyond it the rows are joined by a shuffle
BROADCAST_IDS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def beside(small: DataFrame) -> DataFrame:
    """A table of ids, to be broadcast if it is small enough."""
    return F.broadcast(small) if small.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else small


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with files in the folder that the cluster names in spark.checkpoint.dir.

    Only on one machine (a local master) a temporary folder is set where that is unset; on a cluster it is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        at = spark.conf.get("spark.checkpoint.dir", None)
        if not at and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(at or os.path.join(tempfile.gettempdir(), "sherdflow-checkpoints"))
    return df.checkpoint(eager=True)


#: Settings under which a batch that goes to Python, and the JVM's copies of it, stay at a few MB.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20, "spark.sql.parquet.columnarReaderBatchSize": 1024}


def small_batches(spark: SparkSession) -> None:
    """Lower the session's batch sizes to SMALL_BATCHES; smaller ones that are set already stay."""
    for name, most in SMALL_BATCHES.items():
        now = spark.conf.get(name, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, most)


def tidy(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files and checkpoints of steps that nothing refers to any more.

    It does so when the driver collects garbage, which may be long after; jobs of many steps ask for it. The driver's
    heap shrinks with it, and what its JVM has freed outside of the heap goes back to the system.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trim(spark)


def trim(spark: SparkSession) -> bool:
    """Return native memory that the driver's JVM has freed to the system; False where its JVM can't."""
    sc = spark.sparkContext
    jvm = sc._jvm
    try:
        # by the interface: the server's own class is not open to callers
        (invoke,) = (m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        args = sc._gateway.new_array(jvm.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:  # only newer JVMs on Linux have it
        return False
    return True


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def bytes_of(df: DataFrame) -> int:
    """Spark's estimate of a plan's size (of files: from their sizes); 0 where it has none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def name_beside(df: DataFrame, base: str) -> str:
    """A column name that df does not have (inputs may bring any extra columns)."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name += "_"
    return name
