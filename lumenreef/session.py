"""What the library asks of a Spark session: settings, and a folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SHARED = "spark.checkpoint.dir"
#: Of repeated keys of a proposal the last counts; keyed stream state with timers and lists needs RocksDB.
SETTINGS = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """``spark`` with the settings of the library; call it once, before its functions are used."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; an own one where none is set and Spark is one process.

    On a cluster a folder of this machine would not do: executors would each write to their own disk.
    """
    root = spark.conf.get(_SHARED, None)
    if not root:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError(f"{_SHARED} must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-lumenreef-")
        spark.conf.set(_SHARED, root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_root(spark)}/lumenreef-{tag}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path of any file system that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
