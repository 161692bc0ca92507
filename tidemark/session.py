"""Session settings the package relies on, and where it may write working data."""

import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that right results depend on.

    Zoneless event times are read in the session zone, so it is pinned to UTC.
    Sizing (shuffle partitions, memory, AQE thresholds) stays with the cluster.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(app: str = "tidemark", cores: int | str = "*") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    return configure(builder.getOrCreate())


# Settings in force: how many hold each, and what it was before the first.
_held: dict[tuple[int, str], list] = {}
_lock = threading.Lock()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the statements inside; a stream keeps those it started with.

    They steer how work is cut up, never what comes out. Threads that share a session may
    hold the same ones at a time; the last of them puts back what was there before.
    """
    session = spark._jsparkSession.hashCode()
    with _lock:
        for name, value in values.items():
            held = _held.setdefault((session, name), [0, spark.conf.get(name, None)])
            held[0] += 1
            spark.conf.set(name, value)
    try:
        yield
    finally:
        with _lock:
            for name in values:
                held = _held[session, name]
                held[0] -= 1
                if held[0]:
                    continue
                del _held[session, name]
                if held[1] is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, held[1])


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path on storage that every executor can reach.

    The cluster names that storage in ``spark.checkpoint.dir``. Only a local
    master may go without it, because there every task shares one disk.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
