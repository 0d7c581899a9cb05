"""Session helpers: a local session for tests and bench, and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("statcube")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    # The setting can't be changed in a running session, so the folder is remembered here.
    return _fallback.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="statcube-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, ends a growing plan."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores, for costly work per row on few or unsplittable files.

    ``df`` is a plain file scan.  One with at least as many parts as there are cores
    stays as it is, so a large table is never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


# Largest frame sent to every executor, in bytes of its values.
BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_within(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a checkpointed frame for broadcast when its measured size is within a limit.

    Beyond the limit the frame is returned as it is and the join shuffles.
    """
    width = F.lit(0).cast("long")
    for column in df.schema:
        text = isinstance(column.dataType, (T.StringType, T.BinaryType))
        width = width + (F.coalesce(F.octet_length(column.name), F.lit(0)) + 16 if text else F.lit(16))
    measured = df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]
    return F.broadcast(df) if measured <= limit else df
