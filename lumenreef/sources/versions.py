"""Catalogs with a current version: data is written aside, and one atomic rename of a manifest makes it current."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

_DIGITS = 20


class VersionConflict(RuntimeError):
    """Another writer committed the next version first; read the current version and try again."""


def _files(spark: SparkSession, path: str):
    """The JVM's path and file context for ``path``, of any file system that Spark knows."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    uri = target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri()
    return jvm, target, jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, spark._jsc.hadoopConfiguration())


def _manifest(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/manifests/{version:0{_DIGITS}d}.json"


def current_version(spark: SparkSession, root: str) -> int:
    """The number of the last committed version; 0 before the first."""
    jvm, target, files = _files(spark, f"{root.rstrip('/')}/manifests")
    if not files.util().exists(target):
        return 0
    names = [status.getPath().getName() for status in files.util().listStatus(target)]
    return max((int(n[:_DIGITS]) for n in names if n.endswith(".json") and n[:_DIGITS].isdigit()), default=0)


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A committed version, the current one unless another is named. What is not committed is never seen."""
    number = current_version(spark, root) if version is None else version
    rows = spark.read.text(_manifest(root, number)).collect() if number else []
    if not rows:
        raise FileNotFoundError(f"no version of {root} is committed")
    entry = json.loads("".join(r.value for r in rows))
    return spark.read.parquet(f"{root.rstrip('/')}/data/{entry['data']}")


def commit(df: DataFrame, root: str, base: int) -> int:
    """Write ``df`` as the version after ``base`` and make it current; returns its number.

    Data goes to a folder of its own, so ``df`` may read the version that it follows, and a write that fails half way leaves
    only files that no manifest names. Of two writers on one base the second gets ``VersionConflict``.
    """
    spark, name = df.sparkSession, uuid.uuid4().hex
    root = root.rstrip("/")
    df.write.mode("errorifexists").parquet(f"{root}/data/{name}")
    jvm, aside, files = _files(spark, f"{root}/aside/{name}.json")
    _, final, _ = _files(spark, _manifest(root, base + 1))
    system = aside.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in (aside.getParent(), final.getParent()):
        system.mkdirs(folder)
    out = system.create(aside, False)
    out.write(json.dumps({"version": base + 1, "base": base, "data": name}).encode())
    out.close()
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(aside, final, no_options)  # fails where the target exists: it is never overwritten
    except Exception as error:
        if "FileAlreadyExistsException" not in str(error):
            raise
        for left in (aside, jvm.org.apache.hadoop.fs.Path(f"{root}/data/{name}")):
            system.delete(left, True)
        raise VersionConflict(f"version {base + 1} of {root} is there already") from None
    return base + 1
