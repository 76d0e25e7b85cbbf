"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_dirs: dict[str, str] = {}
_handed: list[str] = []


def local_session(app: str = "millrace", cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="millrace-warehouse-"))
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    that leaves it unset gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="millrace-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the working folder that nothing else uses; ``release_scratch`` removes what was written there."""
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _handed.append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data, wherever Spark keeps it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    if path in _handed:
        _handed.remove(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete all intermediate data of this process; results that still read it end with that."""
    for path in [p for p in _handed if p.startswith(f"{work_dir(spark)}/")]:
        remove_path(spark, path)
