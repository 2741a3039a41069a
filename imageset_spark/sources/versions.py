"""Published tables: a new version appears whole, after it was checked, or not at all.

A table's folder holds hidden versions and a log of commits. A version is written
beside the others, its part files are listed with their lengths and digests, it is
checked as it was written, and only then one row is added to the log. Readers take
the version of the last commit and the files that its list names, so they never
see a half-written or refused version, nor files of a failed task. Adding the row
is one file that Spark moves into place, which works on every store it can write to.

Versions that are not current stay until the owner of the folder removes them.
"""

from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HIDDEN = "_published"
COMMIT_SCHEMA = "seq bigint, version string, n_files bigint, n_bytes bigint"
MANIFEST_SCHEMA = "name string, length bigint, sha256 string"


def _commits(spark, path):
    """The commits of a table in their order, or None if nothing was published there."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(f"{path.rstrip('/')}/{_HIDDEN}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def last_commit(spark, path):
    """The row of the last commit, or None."""
    commits = _commits(spark, path)
    return commits.orderBy(F.desc("seq"), F.desc("version")).first() if commits is not None else None


def _files(spark, folder):
    """Part files below a folder: name, length and digest. Tasks read the files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.substring_index("path", f"{folder}/", -1)
    return files.select(name.alias("name"), "length", F.sha2("content", 256).alias("sha256"))


@dataclass(frozen=True)
class Draft:
    """A version that is written and listed, but not yet to be seen by readers."""

    path: str
    version: str
    schema: T.StructType
    format: str

    @property
    def _folder(self):
        return f"{self.path}/{_HIDDEN}/{self.version}"

    def _manifest(self, spark):
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self._folder}/files")

    def read(self, spark):
        """The version's rows, from the files of its list."""
        # As many names as Spark itself holds to plan a scan of the files.
        names = [r.name for r in self._manifest(spark).select("name").collect()]
        if not names:
            return spark.createDataFrame([], self.schema)
        reader = spark.read.schema(self.schema).option("basePath", f"{self._folder}/data").format(self.format)
        if self.format == "csv":
            reader = reader.option("header", True)
        return reader.load(sorted(f"{self._folder}/data/{name}" for name in names)).select(self.schema.names)

    def commit(self, spark):
        """Make this the version that readers see."""
        whole = self._manifest(spark).agg(F.count("*").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"))
        last = last_commit(spark, self.path)
        row = whole.select(
            F.lit(last.seq + 1 if last else 1).cast("bigint").alias("seq"), F.lit(self.version).alias("version"),
            "n_files", "n_bytes",
        )
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/{_HIDDEN}/commits")


def prepare(df: DataFrame, path, format="parquet", partition_by=(), check=None):
    """Write ``df`` as a hidden version and check it; returns the :class:`Draft` to commit.

    ``check`` is given the rows as they were written, and raises to refuse them.
    """
    spark = df.sparkSession
    draft = Draft(path.rstrip("/"), uuid4().hex, df.schema, format)
    writer = df.write.format(format)
    if format == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{draft._folder}/data")
    _files(spark, f"{draft._folder}/data").write.parquet(f"{draft._folder}/files")
    if check is not None:
        check(draft.read(spark))
    return draft


def publish(df, path, format="parquet", partition_by=(), check=None):
    """Write, check and commit a new version of the table at ``path``."""
    prepare(df, path, format, partition_by, check).commit(df.sparkSession)


def _current(spark, path, schema, format):
    last = last_commit(spark, path)
    if last is None:
        raise ValueError(f"nothing was published at {path}")
    draft = Draft(path.rstrip("/"), last.version, schema, format)
    listed = draft._manifest(spark).agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()
    if (listed.n, listed.b) != (last.n_files, last.n_bytes):
        raise ValueError(f"the list of files of version {last.version} at {path} is not the one that was committed")
    return draft


def read_published(spark, path, schema, format="parquet"):
    """The rows of the last committed version."""
    return _current(spark, path, schema, format).read(spark)


def published_paths(spark, path):
    """Files of the last committed version, or None where nothing was published."""
    if last_commit(spark, path) is None:
        return None
    draft = _current(spark, path, T.StructType(), "")
    return sorted(f"{draft._folder}/data/{r.name}" for r in draft._manifest(spark).select("name").collect())


def verify_published(spark, path):
    """Digests of the current version's files against its list: name, expected, actual, matches.

    A file that is gone has no actual digest; one that is not listed has no expected digest.
    """
    from .files import verify_checksums

    draft = _current(spark, path, T.StructType(), "")
    return verify_checksums(_files(spark, f"{draft._folder}/data"), draft._manifest(spark))
