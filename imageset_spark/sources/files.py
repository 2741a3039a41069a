"""Image and artifact files: decoding audit and checksums."""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import stem
from .folders import open_path


def read_files(spark, folder, suffix=S.IMAGE_SUFFIX, recursive=False):
    """Files of a folder as path, length and content; unused columns are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
    )


def listed_paths(paths, path_col="path", suffix=S.IMAGE_SUFFIX):
    """Of a table of paths, those with the suffix, with the id that the file name gives."""
    named = paths.where(F.col(path_col).endswith(suffix))
    return named.withColumn("sample_id", stem(path_col, suffix))


def _look(decoder, content):
    """What decoding some bytes gave: readable, dimensions, width, height. No bytes are unreadable."""
    try:
        shape = decoder(bytes(content)).shape
    except Exception:
        return False, None, None, None
    if len(shape) == 2:
        return True, 2, int(shape[1]), int(shape[0])
    return True, len(shape), None, None


def _audit_rows(ids, seen):
    out = pd.DataFrame(seen, columns=["readable", "ndim", "width", "height"])
    out = out.astype({"readable": "bool", "ndim": "Int32", "width": "Int32", "height": "Int32"})
    out.insert(0, "sample_id", np.array(list(ids), dtype=object))
    return out


def audit_paths(images, decoder, opener=open_path, path_col="image_path", tasks=None):
    """Read and decode the file of every image record inside the task.

    Only ids and paths are moved between executors, and only files that a record
    names are opened. A path without a file, or with a folder in its place, gives
    no row; a file that cannot be read or decoded, an empty one too, is unreadable. ``opener(path, "rb")`` opens a
    file that every executor can reach; rows are spread over ``tasks`` by path,
    by default one per shuffle partition.
    """
    tasks = tasks or int(images.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def attempt(path):
        try:
            with opener(path, "rb") as handle:
                content = handle.read()
        except (FileNotFoundError, IsADirectoryError, NotADirectoryError):
            return None
        except OSError:
            return False, None, None, None
        return _look(decoder, content)

    def audit(batches):
        for batch in batches:
            seen = [(i, attempt(path)) for i, path in zip(batch["sample_id"], batch[path_col])]
            found = [(i, s) for i, s in seen if s is not None]
            yield _audit_rows([i for i, _ in found], [s for _, s in found])

    return images.select("sample_id", path_col).repartition(tasks, path_col).mapInPandas(audit, S.AUDIT_SCHEMA)


def audit_images(files, decoder):
    """Decode every file and report what came out.

    ``files`` has ``sample_id`` and ``content`` (NULL for a file that could not be
    read); ``decoder`` turns bytes into an array and may raise. Works scan-side, so
    contents are not shuffled.
    """

    def audit(batches):
        for batch in batches:
            yield _audit_rows(batch["sample_id"], [_look(decoder, c) for c in batch["content"]])

    return files.select("sample_id", "content").mapInPandas(audit, S.AUDIT_SCHEMA)


def checksum_files(files, root=None):
    """SHA-256 of each file read by :func:`read_files`.

    Names are base names, or with ``root`` the paths below that folder, which
    tell apart files of one name in several folders.
    """
    base = F.regexp_extract("path", r"([^/]+)$", 1)
    if root is not None:
        top = root.rstrip("/") + "/"
        base = F.when(F.instr("path", top) > 0, F.substring_index("path", top, -1)).otherwise(base)
    return files.select(
        base.alias("name"),
        F.sha2("content", 256).alias("sha256"),
    )


def checksum_lines(checksums):
    """Manifest lines: digest, two spaces, name."""
    return checksums.select(
        "name", "sha256", F.concat_ws("  ", "sha256", "name").alias("line")
    )


def checksum_paths(paths, opener=open_path, chunk_bytes=8 * 1024 * 1024, tasks=None):
    """SHA-256 of files too large for one row, read in chunks inside the task.

    ``paths`` has ``name`` and ``path``; ``opener(path, "rb")`` opens a file
    that every executor can reach. Paths are spread over ``tasks``, by default
    one per shuffle partition.
    """
    tasks = tasks or int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def digest(path):
        state = hashlib.sha256()
        with opener(path, "rb") as handle:
            while chunk := handle.read(chunk_bytes):
                state.update(chunk)
        return state.hexdigest()

    def run(batches):
        for batch in batches:
            yield pd.DataFrame(
                {"name": batch["name"], "sha256": [digest(path) for path in batch["path"]]}
            )

    spread = paths.select("name", "path").repartition(tasks, "path")
    return spread.mapInPandas(run, "name string, sha256 string")


def verify_checksums(checksums, manifest):
    """Compare digests with a stored manifest (name, sha256), both ways."""
    stored = manifest.select("name", F.col("sha256").alias("expected"))
    return (
        checksums.select("name", F.col("sha256").alias("actual"))
        .join(stored, "name", "full_outer")
        .select("name", "expected", "actual",
                F.coalesce(F.col("actual") == F.col("expected"), F.lit(False)).alias("matches"))
    )
