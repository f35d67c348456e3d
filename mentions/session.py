"""Session helpers.

Library code never creates its own session; it takes the caller's. The
helpers here are for tests, the bench and the command-line entry points,
where a local session is built with settings that mirror a cluster setup
(AQE on, skew-join splitting on, UI off).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: The folder of a local session where that is unset (a running session can't change ``spark.checkpoint.dir``).
LOCAL_KEY = "mentions.scratch.local"
RUN_KEY = "mentions.scratch.run"
#: With it the shuffle files of a write are removed at its end, not some time after, when the driver collects its garbage.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "mentions") -> SparkSession:
    """Local session for tests and the bench.

    ``spark.sql.shuffle.partitions`` is sized to the cores here; on a cluster
    the caller sizes it to the data (AQE coalesces small partitions anyway).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Broadcast only genuinely small sides: in one local JVM, hashing a
        # few-MB side on the driver costs more than a local shuffle join
        # (measured on the sf0.1 bench).
        .config("spark.sql.autoBroadcastJoinThreshold", str(1 << 20))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MENTIONS_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, ``spark.checkpoint.dir``.

    The cluster names it; a folder of the driver's machine would not be seen
    by executors, so on a cluster an unset name is an error. A ``local``
    master has one machine: there, as in tests, a fresh folder below the
    system temp folder is used and remembered in the session.
    """
    current = spark.conf.get(CHECKPOINT_KEY, None) or spark.conf.get(LOCAL_KEY, None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="mentions-ckpt-")
        spark.conf.set(LOCAL_KEY, current)
    return current


def scratch_dir(spark: SparkSession, tag: str = "scratch") -> str:
    """A fresh folder under the shared checkpoint directory.

    Intermediate files go to the cluster's shared folder, never to a
    machine-local temp dir that other executors cannot see. They stay until
    :func:`clear_scratch`, or until the end of the :func:`scratch_run` in
    which the folder was made.
    """
    run = spark.conf.get(RUN_KEY, None) or "session"
    return f"{_application_scratch(spark)}/{run}/{tag}-{uuid.uuid4().hex}"


def _application_scratch(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/mentions-{spark.conf.get('spark.app.id', 'application')}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the block; afterwards they are as before."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def delete_folder(spark: SparkSession, path: str) -> None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(hpath, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all scratch folders of this Spark application; results that are not collected or written are lost."""
    delete_folder(spark, _application_scratch(spark))


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """One scratch folder for all that the block makes, removed at its end (also if it fails).

    DataFrames made inside read from it when they run, so collect or write
    them inside. Runs may be nested; a session has one at a time, so runs of
    several threads need sessions of their own (``spark.newSession()``).
    """
    outer, run = spark.conf.get(RUN_KEY, None), f"run-{uuid.uuid4().hex}"
    spark.conf.set(RUN_KEY, run)
    try:
        yield f"{_application_scratch(spark)}/{run}"
    finally:
        if outer is None:
            spark.conf.unset(RUN_KEY)
        else:
            spark.conf.set(RUN_KEY, outer)
        delete_folder(spark, f"{_application_scratch(spark)}/{run}")
