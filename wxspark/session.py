"""Session builder and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_scratch_bases: dict[str, str] = {}


def build_session(app: str = "wxspark", master: str | None = None, hive: bool = False, **conf: str) -> SparkSession:
    """A session with a UTC zone and snappy parquet; the Hive catalog is opt-in.

    The JVM does not compile methods beyond 8,000 bytes of bytecode. A stage whose generated method
    would be larger, as the display texts make it, runs faster as separately compiled operators.
    Tasks may keep a file open for each weather type, so the fan-out by type needs no sort.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.maxConcurrentOutputFileWriters", "16")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def scratch_base(spark: SparkSession) -> str:
    """The folder all executors share, also set as the checkpoint folder.

    It is the one named by ``spark.checkpoint.dir``. Only a local-mode session without that setting
    gets a temporary folder, since there the driver's disk is the executors' disk.
    """
    context = spark.sparkContext
    if context.applicationId not in _scratch_bases:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="wxspark-")
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(base)
        _scratch_bases[context.applicationId] = base.rstrip("/")
    return _scratch_bases[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing is ever overwritten there."""
    return f"{scratch_base(spark)}/wxspark/{label}-{uuid.uuid4().hex}"
