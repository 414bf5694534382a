"""Session set-up, table access and scratch space on shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators rely on.

    On a cluster leave both arguments out: the master, the memory and
    ``spark.checkpoint.dir`` come from spark-submit, and AQE sizes the shuffles.
    """
    builder = (
        SparkSession.builder.appName("tallyloom")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master is not None:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.driver.memory", "12g")
            # a small input is not worth one task per 4 MB
            .config("spark.sql.files.openCostInBytes", "1m")
        )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, named by ``spark.checkpoint.dir``.

    Only where it is unset and driver and tasks are one process (tests, bench) is
    a folder of this machine taken instead.
    """
    sc = spark.sparkContext
    shared = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if shared:
        return shared
    app = sc.applicationId
    if app not in _LOCAL_SCRATCH:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="tallyloom-")
        sc.setCheckpointDir(_LOCAL_SCRATCH[app])
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the scratch root; nothing is ever overwritten there."""
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a scratch table and return a scan of it.

    Used where a value that depends on row placement (a range partition's
    number) must not change when a lost task is run again. Parquet rather than
    a checkpoint, so later branches still read only their own columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
