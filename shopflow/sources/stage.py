"""Cut lineage by writing a table to the shared folder the cluster names.

The folder is ``spark.checkpoint.dir`` (or what ``setCheckpointDir`` set). A written
Parquet table survives lost executors and is read back column-pruned, which a cached or
checkpointed row RDD is not.
"""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    shared = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shopflow-"))
    return spark.sparkContext.getCheckpointDir()


_open_scopes = []


@contextmanager
def scope(spark: SparkSession):
    """Tables staged inside go to one folder, which is deleted at the end."""
    path = f"{folder(spark)}/shopflow/run-{uuid.uuid4().hex}"
    _open_scopes.append(path)
    try:
        yield path
    finally:
        _open_scopes.remove(path)
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _path(spark, path)
    fs.delete(hadoop_path, True)


def replace(spark: SparkSession, path: str, target: str) -> None:
    """Move a folder to where another one may be, which is deleted."""
    (source, fs), (place, _) = _path(spark, path), _path(spark, target)
    fs.delete(place, True)
    if not fs.rename(source, place):
        raise OSError(f"{path} was not moved to {target}")


def _path(spark, path):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Paths right below a folder; none when there is no such folder."""
    hadoop_path, fs = _path(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used, below the shared folder or the open scope's."""
    base = _open_scopes[-1] if _open_scopes else f"{folder(spark)}/shopflow"
    return f"{base}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the stored table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
