"""Session settings and the shared folder used for lineage cuts and sinks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Largest table (rows) that is sent to every executor.
BROADCAST_ROWS = 200_000


def get_session(app: str = "tissueframe", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a missing setting is an error, because a machine-local folder would
    be lost with its executor.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if not sc.getCheckpointDir():
        if sc.master != "local" and not sc.master.startswith("local["):  # local-cluster has executors of its own
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tissueframe-"))
    return sc.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there.

    A written table survives lost executors, is computed once, and tells the
    planner its real size, so small results are broadcast without a hint.
    """
    spark = df.sparkSession
    path = scratch(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` for a join that shuffles both sides, whatever size the planner takes it for.

    The planner knows the bytes of compressed files, not how many rows an explode makes of one: runs of a few
    megabytes of cells, or the nine copies of a site, pass for small and would be collected in the driver to be
    broadcast.  For tables that grow with the data.
    """
    return df.hint("merge")


def deal(df: DataFrame, *cols: str, share: int = 1) -> DataFrame:
    """Rows dealt by ``cols`` to as many tasks as a shuffle has, or a ``share`` of them, before they multiply or gather in hash tables.

    A small file is read by one task, and shuffles of few bytes are put together to few tasks, however many rows an
    explode makes there; the number is fixed, so neither happens.  Later groups that hold ``cols`` need no other shuffle.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, parts // share), *cols)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Materialise a summary once; broadcast it only if it is proven small.

    Beyond ``limit`` rows the plain table is returned and Spark picks a shuffle
    join, where adaptive execution splits hot keys.
    """
    done = cut(df)
    return F.broadcast(done) if done.count() <= limit else done
