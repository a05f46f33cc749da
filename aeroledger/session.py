"""Session settings and the shared folder used for checkpoints."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Adaptive execution splits skewed join partitions and merges small shuffle
# partitions, so one setting serves both a laptop and a large cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Checkpoint files go once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM compiles no method beyond 8,000 bytes of code: a step that would need one is run operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Where every partition of a join's smaller side is within this, it is hashed, and the larger side is neither sorted nor spilled.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def build_session(app: str = "aeroledger", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the library's settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def compiled_steps(spark: SparkSession) -> None:
    """The same limit of generated methods in a session that was built elsewhere and did not set one."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, SETTINGS[name])


def hashed_joins(spark: SparkSession) -> None:
    """The same bound of hashed join sides in a session that was built elsewhere and did not set one."""
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    if spark.conf.get(name) in ("0", "0b"):
        spark.conf.set(name, SETTINGS[name])


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers once per application.

    Functions that run in Python workers are found by their module, and a worker
    need not have the driver's path or working directory.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="aeroledger-")), "aeroledger.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("aeroledger", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (tests, one machine) a folder of our own is made and remembered.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("aeroledger.shared.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="aeroledger-")
        spark.conf.set("aeroledger.shared.dir", folder)
    return folder.rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def reliable_checkpoint(df):
    """Cut the lineage of ``df`` through files in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, label: str = "stored", file_rows: int = 0):
    """``df`` written once to the shared folder as a compressed columnar table; readers take only the columns they need.

    With ``file_rows`` no file has more rows than that.
    """
    path = run_dir(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def read_in_tasks(spark: SparkSession, tasks: int):
    """Files that are read meanwhile are dealt to about so many tasks, however few bytes they have, and to every core."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(max(tasks, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
