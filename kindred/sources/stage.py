"""Tables written between the steps of a job, in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_own_dirs: dict[str, str] = {}
#: Folders of the tables written so far, by application.
_tables: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. In local mode alone, a temporary one where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        own = tempfile.mkdtemp(prefix="kindred-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _own_dirs[app] = f"file://{own}"
    return _own_dirs[app]


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: its lineage ends there.

    Lost executors cost only the tasks that read the table, and a table that several branches read
    is computed once. Tables go when the driver's Python ends.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/kindred/{uuid.uuid4().hex}"
    app = spark.sparkContext.applicationId
    if app not in _tables:
        _tables[app] = []
        atexit.register(_remove, spark, _tables[app])
    _tables[app].append(folder)
    df.write.parquet(f"{folder}/{label}")
    return spark.read.schema(df.schema).parquet(f"{folder}/{label}")


def _remove(spark: SparkSession, folders: list[str]) -> None:
    """Deletes folders, as far as the application is still there."""
    with contextlib.suppress(Exception):
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        while folders:
            path = jvm.org.apache.hadoop.fs.Path(folders.pop())
            path.getFileSystem(conf).delete(path, True)


def finished(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """``make()`` written; the tables that were written on the way to it are removed."""
    app = spark.sparkContext.applicationId
    before = len(_tables.get(app, []))
    out = written(make(), label)
    between = _tables[app][before:-1]
    del _tables[app][before:-1]
    _remove(spark, between)
    return out
