"""Session set-up and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

# Settings every operator relies on; all of them can be changed at run time.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where an aggregate above it needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Arrow batches of long texts stay small; short rows still make few of them.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Commit what a micro-batch changed, not whole state files.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the keys would cost a read before every write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # Shuffle files go with the query that made them, not when the driver happens to collect its plan.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Combine sessions before the shuffle, so that a hot key sends sessions, not rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(name: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; `master` is for local runs only."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    builder = builder.config("spark.python.unix.domain.socket.enabled", "true")
    for key, value in {**RUNTIME, PROVIDER: ROCKSDB, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Put a session someone else built into the state the operators expect."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if spark.conf.get(PROVIDER, None) != ROCKSDB:
        spark.conf.set(PROVIDER, ROCKSDB)
    context = spark.sparkContext
    chosen = context.getConf().contains("spark.sql.shuffle.partitions")
    if context.master.startswith("local") and not chosen and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        # One machine: a partition per core, not one per core of a cluster.
        spark.conf.set("spark.sql.shuffle.partitions", str(context.defaultParallelism))
    # Touching the stream manager starts the state store coordinator, which
    # stateful processors need in batch mode as well.
    spark.streams.active
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for the Python functions that run there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    bundle = Path(tempfile.mkdtemp(prefix="tidemill-code-")) / "tidemill.zip"
    with zipfile.ZipFile(bundle, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(bundle))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, from spark.checkpoint.dir.

    A local session without the setting gets a temporary folder; a cluster
    without it is refused, since a machine-local folder would be lost there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = os.environ.setdefault("TIDEMILL_LOCAL_DIR", tempfile.mkdtemp(prefix="tidemill-"))
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def run_dir(spark: SparkSession, name: str, within: str | None = None) -> str:
    """A new folder for one run, below the shared folder or the folder of another run."""
    return f"{within or f'{shared_dir(spark)}/tidemill'}/{name}-{uuid.uuid4().hex}"
