"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pixelchange", checkpoints: str | None = None) -> SparkSession:
    """Session used by tests and bench; a cluster brings its own.

    ``checkpoints`` becomes ``spark.checkpoint.dir`` (default: a fresh folder,
    which is enough for the one machine that a local session runs on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config(CHECKPOINT_CONF, checkpoints or tempfile.mkdtemp(prefix="pixelchange-ckpt-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system path); we never
    invent a machine-local folder there.  In local mode (tests, bench) an
    unset value is replaced by a fresh temporary folder.
    """
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="pixelchange-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub folder of the checkpoint folder for staged tables."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/staging/{name}-{uuid.uuid4().hex}"


# The settings below hold for a whole session meanwhile; other threads of the driver wait.
_SETTINGS = threading.RLock()


@contextmanager
def settings(spark: SparkSession, given: dict):
    """Some of the session's settings changed, for what is set up meanwhile."""
    with _SETTINGS:
        old = {k: spark.conf.get(k, None) for k in given}
        for k, v in given.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
