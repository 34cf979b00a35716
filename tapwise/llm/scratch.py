"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# The temporary folder of each application that runs in one process and names no other.
_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a temporary folder only where Spark runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="tapwise-")
    return _own_folders[application]


def new_path(spark: SparkSession) -> str:
    """A fresh path in the shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored(rows: DataFrame) -> DataFrame:
    """`rows`, written once to the shared folder and read from there.

    What follows survives lost executors without computing `rows` again, reads only the columns it
    needs, and knows the table's real size when it plans joins.
    """
    spark = rows.sparkSession
    path = new_path(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def fresh(rows: DataFrame, name: str) -> str:
    """`name`, with underscores before it until no column of `rows` is called that."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
