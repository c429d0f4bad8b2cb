"""Written intermediate tables whose shuffle files go when the write is done."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame

from .. import session

CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Folder of each table that ``materialise`` returned.
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def materialise(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back, without leaving its shuffle files behind.

    The written table replaces them, also where an executor is lost later. The
    session's own setting holds again afterwards.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEAN, None)
    conf.set(CLEAN, "true")
    path = session.scratch_folder(df.sparkSession)
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(CLEAN)
        else:
            conf.set(CLEAN, before)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove the folders of tables from ``materialise`` when all that reads them is written itself."""
    for table in tables:
        path = _folders.pop(table)
        spark = table.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
