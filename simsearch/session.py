"""Session settings for running the jobs, and the shared folder for checkpoints."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
REMOVE_EXCHANGES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_shipped: set[str] = set()
_own: dict[str, str] = {}


def build_session(app_name: str = "simsearch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive planning on; a cluster's own settings win over these."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``. Only a local session without one (a test,
    a laptop) gets a temporary folder."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        folder = _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="simsearch-shared-"))
    return folder.rstrip("/")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, for tables that a job writes and reads again."""
    return f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the cluster's shared folder; a lost executor cannot lose the result."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_base(df.sparkSession))
    return df.checkpoint(eager=True)


@contextlib.contextmanager
def exchanges_removed(spark: SparkSession) -> Iterator[None]:
    """What is run here leaves no exchange's files behind; otherwise they lie on the executors' disks until the driver collects its garbage."""
    before = spark.conf.get(REMOVE_EXCHANGES)
    spark.conf.set(REMOVE_EXCHANGES, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVE_EXCHANGES, before)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they can import it
    wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="simsearch-package-")) / "simsearch.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, str(Path(package.name) / source.relative_to(package)))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)
