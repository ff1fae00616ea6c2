"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusprep")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


SCRATCH_SETTING = "spark.corpusprep.scratch.dir"
_used: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for intermediate data, below the folder that the cluster shares:
    ``spark.corpusprep.scratch.dir``, or else ``spark.checkpoint.dir``. Only a local
    session may go without both; it uses its warehouse. ``clear_scratch`` deletes
    what an application has used, and so does the end of the program."""
    root = spark.conf.get(SCRATCH_SETTING, None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SCRATCH_SETTING} or spark.checkpoint.dir to a folder that every executor can reach")
        root = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse").removeprefix("file:").rstrip("/") + "/_scratch"
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    application = spark.sparkContext.applicationId
    if application not in _used:
        atexit.register(_clear_at_exit, spark, application)
    _used.setdefault(application, []).append(path)
    return path


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Deletes scratch folders that nothing will read again."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in paths:
        target = hadoop.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes all scratch folders of this application."""
    drop_scratch(spark, *_used.pop(spark.sparkContext.applicationId, []))


def _clear_at_exit(spark: SparkSession, application: str) -> None:
    paths = _used.pop(application, [])
    if spark.sparkContext._jsc is not None:
        drop_scratch(spark, *paths)
    else:  # stopped: only this machine's folders can still be reached
        for path in paths:
            if path.startswith(("/", "file:")):
                shutil.rmtree(path.removeprefix("file:"), ignore_errors=True)
