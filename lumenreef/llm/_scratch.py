"""Tables cut from their lineage in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; an own one where none is set and Spark is one process.

    On a cluster a folder of this machine would not do: executors would each write to their own disk.
    """
    root = spark.conf.get(_KEY, None)
    if not root:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError(f"{_KEY} must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-lumenreef-")
        spark.conf.set(_KEY, root)
    return root.rstrip("/")


class Scratch:
    """Tables of one computation, which can be deleted once nothing reads them any more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        """Write ``df`` as Parquet to the shared folder and read it back.

        The result has no lineage, so a lost executor costs a re-read and not a
        recomputation, and later passes can prune columns.
        """
        path = f"{scratch_root(self.spark)}/lumenreef-{tag}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path, out
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of ``keep`` that no later query reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table))[0])
            path.getFileSystem(conf).delete(path, True)

    def clear(self) -> None:
        """Delete all tables of ``keep``."""
        self.drop(*[table for _, table in self.paths.values()])


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """``Scratch.keep`` for a table that stays until the folder is cleared."""
    return Scratch(df.sparkSession).keep(df, tag)
