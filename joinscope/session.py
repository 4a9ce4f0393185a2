"""Cutting lineage through the cluster's shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, tuple[SparkSession, str]] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the session's ``spark.checkpoint.dir``; a private folder only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="joinscope-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the cluster's file system, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def _remove_all() -> None:
    for spark, folder in _folders.values():
        if spark.sparkContext._jsc is not None:  # not stopped
            remove(spark, folder)
    _folders.clear()


def kept_folder(spark: SparkSession) -> str:
    """This application's folder for written tables in the checkpoint folder; deleted when the program ends."""
    ensure_checkpoint_dir(spark)
    app = spark.sparkContext.applicationId
    if app not in _folders:
        if not _folders:
            atexit.register(_remove_all)
        _folders[app] = (spark, f"{spark.sparkContext.getCheckpointDir()}/tables-{app}")
    return _folders[app][1]


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet to the shared checkpoint folder; later reads start from there."""
    spark = df.sparkSession
    path = f"{kept_folder(spark)}/{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
