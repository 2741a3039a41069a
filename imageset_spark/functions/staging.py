"""Written intermediate tables: they cut lineage and survive lost executors.

Results are lazy scans of staged tables, so these stay until :func:`clear_staged` is
called, once the results have been written or are no longer wanted.
"""

import re
import tempfile
from functools import cache
from uuid import uuid4


#: Spark removes the shuffle files of a query when it ends; else they stay until the driver collects garbage.
_FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths handed out by this process and not cleared yet.
_STAGED = []


@cache
def _local_folder():
    return tempfile.mkdtemp(prefix="imageset-")


def staging_dir(spark):
    """Shared folder named by ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode, where it is the one machine
    there is; on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    return _local_folder()


def staged_path(spark, name):
    path = f"{staging_dir(spark)}/imageset/{name}-{uuid4().hex}"
    _STAGED.append(path)
    return path


def stage(df, name):
    """Write ``df`` once and return a scan of the written table; the shuffle files of the write are removed."""
    spark = df.sparkSession
    path = staged_path(spark, name)
    before = spark.conf.get(_FREES_SHUFFLES, None)
    spark.conf.set(_FREES_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_FREES_SHUFFLES)
        else:
            spark.conf.set(_FREES_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def clear_staged(spark):
    """Remove every table that this process staged so far; returns how many there were.

    Frames that still read them fail afterwards, so write the results first.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed
