"""Tables that a job writes once and reads again, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir.

    Only a local session (tests, a notebook) may lack it: a folder is made and set.
    """
    sc = spark.sparkContext
    given = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if given:
        return given
    if not (sc.master.startswith("local") and not sc.master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="gridloom-"))
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that is used by nothing else."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read back.

    It cuts the lineage and is computed once; a lost executor takes nothing
    with it, as the files lie in the shared folder.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made._stored_path = path
    return made


def discard(*frames: DataFrame) -> None:
    """Delete the files of stored() frames that no result yet to be computed reads."""
    for frame in frames:
        sc = frame.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(frame._stored_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
