"""Session settings and folders on the cluster's file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Settings the jobs are written for. Sizes (shuffle partitions, memory) belong to the
# cluster: give each shuffle partition 100 to 200 MB.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "tillwork", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RECOMMENDED, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    Without the setting, as in tests, it lies in the warehouse, which is shared as well.
    """
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if not shared:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove_folder(spark: SparkSession, folder: str) -> None:
    system, path = _path(spark, folder)
    system.delete(path, True)


def make_folder(spark: SparkSession, folder: str) -> None:
    system, path = _path(spark, folder)
    system.mkdirs(path)


def write_file(spark: SparkSession, file: str, text: str) -> None:
    system, path = _path(spark, file)
    stream = system.create(path, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def folder_bytes(spark: SparkSession, folder: str) -> int:
    system, path = _path(spark, folder)
    return system.getContentSummary(path).getLength()


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """One rename; the parent of ``target`` is made if need be."""
    system, path = _path(spark, source)
    to = _path(spark, target)[1]
    system.mkdirs(to.getParent())
    if not system.rename(path, to):
        raise OSError(f"{source} can't be renamed to {target}")


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in ``folder``, in order; none if it is missing."""
    system, path = _path(spark, folder)
    if not system.exists(path):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(path) if s.isDirectory())


def literal_path(path: str) -> str:
    """``path`` for readers that take patterns: signs of patterns stand for themselves."""
    return "".join(f"\\{sign}" if sign in "\\*?[]{}" else sign for sign in path)


def files_in(spark: SparkSession, folder: str, ending: str) -> list[str]:
    """Names of the files in ``folder`` with this ending, in order."""
    system, path = _path(spark, folder)
    names = [s.getPath().getName() for s in system.listStatus(path) if s.isFile()]
    return sorted(n for n in names if n.endswith(ending))
