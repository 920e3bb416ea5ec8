"""Session helpers: local sessions for tests and bench, and the shared work folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """Single-machine session. On a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("remitspark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        # The JVM interprets larger methods instead of compiling them.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="remitspark-")


def new_work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder that the cluster names.

    Only a local session may fall back to this machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A work folder for a result that is read later; it goes when the session's process ends."""
    folder = new_work_folder(spark, label)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def drop_work_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder made by :func:`new_work_folder`."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def qualified(spark: SparkSession, folder: str) -> str:
    """Full name of a folder, with scheme, as file listings show it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString().rstrip("/")


def conf_bytes(spark: SparkSession, key: str) -> int:
    """A size setting such as ``128MB``, ``134217728b`` or ``134217728`` in bytes."""
    text = spark.conf.get(key).strip().lower().removesuffix("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(text[-1:])
    return int(text[:-1]) * unit if unit else int(text)
