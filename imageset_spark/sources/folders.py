"""Image folders as a Spark data source, and files on any file system.

``image_folder`` is a data source whose tasks list the folders themselves. While
planning, only the names of subfolders are looked up; no file status is held by the
driver. A file's bytes are read only if the schema asks for ``content``, so a listing
reads none. Folders with very many files can be dealt to several tasks (``slices``).

Only regular files are rows: a folder with an image's name is no image file. Empty
files are rows of length 0. A file that vanishes between listing and reading
gives no row; one that cannot be read has NULL content.
"""

import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import schemas as S

FORMAT = "image_folder"
FILE_SCHEMA = "sample_id string, path string, length bigint, content binary"
#: Bytes of content, or number of files, in one batch of rows.
BATCH_BYTES, BATCH_FILES = 16 << 20, 10_000


def file_system(path):
    """The file system of a path or address, and the path within it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def open_path(path, mode="rb"):
    """Open a file by path or address; usable in every task.

    Raises ``FileNotFoundError`` for what is not there and ``IsADirectoryError`` for a folder.
    """
    system, inner = file_system(path)
    if isinstance(system, fs.LocalFileSystem):
        return open(inner, mode)
    kind = system.get_file_info(inner).type
    if kind == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if kind == fs.FileType.Directory:
        raise IsADirectoryError(path)
    return system.open_input_stream(inner)


class Folder(InputPartition):
    """A folder, whether its subfolders belong to it, and which slice of its files."""

    def __init__(self, name, recursive, number, slices):
        self.name, self.recursive, self.number, self.slices = name, recursive, number, slices


class ImageFolderReader(DataSourceReader):
    def __init__(self, options, columns):
        self.folder = options["path"].rstrip("/") or "/"
        self.suffix = options.get("suffix", S.IMAGE_SUFFIX)
        self.recursive = options.get("recursive", "false").lower() == "true"
        self.slices = max(1, int(options.get("slices", "1")))
        self.columns = columns

    def partitions(self):
        found = [Folder("", False, i, self.slices) for i in range(self.slices)]
        if self.recursive:
            system, root = file_system(self.folder)
            below = [e.base_name for e in system.get_file_info(fs.FileSelector(root)) if e.type == fs.FileType.Directory]
            found += [Folder(f"/{name}", True, i, self.slices) for name in sorted(below) for i in range(self.slices)]
        return found

    def _files(self, partition):
        """(address, path in the file system, size) of the partition's files."""
        system, root = file_system(self.folder)
        selector = fs.FileSelector(root.rstrip("/") + partition.name, recursive=partition.recursive)
        for entry in system.get_file_info(selector):
            if entry.type != fs.FileType.File or not entry.base_name.endswith(self.suffix):
                continue
            below = entry.path[len(root.rstrip("/")) :]
            if partition.slices == 1 or zlib.crc32(below.encode()) % partition.slices == partition.number:
                yield system, self.folder + below, entry.path, entry.size

    def read(self, partition):
        rows, held = [], 0
        for system, address, inner, size in self._files(partition):
            row = {"sample_id": inner.rsplit("/", 1)[-1][: -len(self.suffix) or None], "path": address, "length": size}
            if "content" in self.columns:
                try:
                    with system.open_input_stream(inner) as handle:
                        row["content"] = handle.read()
                except FileNotFoundError:
                    continue
                except OSError:
                    row["content"] = None
                held += size
            rows.append(row)
            if held >= BATCH_BYTES or len(rows) >= BATCH_FILES:
                yield self._batch(rows)
                rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows):
        types = {"sample_id": pa.string(), "path": pa.string(), "length": pa.int64(), "content": pa.binary()}
        return pa.RecordBatch.from_arrays(
            [pa.array([row[c] for row in rows], types[c]) for c in self.columns], list(self.columns)
        )


class ImageFolder(DataSource):
    """``spark.read.format("image_folder")``; options ``suffix``, ``recursive`` and ``slices``."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return FILE_SCHEMA

    def reader(self, schema):
        unknown = sorted(set(schema.names) - {"sample_id", "path", "length", "content"})
        if unknown:
            raise ValueError(f"{FORMAT} has no columns {', '.join(unknown)}")
        return ImageFolderReader(dict(self.options), schema.names)


def read_images(spark, folder, suffix=S.IMAGE_SUFFIX, recursive=False, slices=1, content=True):
    """Image files as sample_id, path, length and, if wanted, content.

    ``recursive`` takes in subfolders, a task or more each. Every folder's files are
    dealt to ``slices`` tasks.
    """
    spark.dataSource.register(ImageFolder)
    columns = [c for c in FILE_SCHEMA.split(", ") if content or not c.startswith("content")]
    return (
        spark.read.format(FORMAT).schema(", ".join(columns)).option("suffix", suffix)
        .option("recursive", str(recursive).lower()).option("slices", slices).load(folder)
    )


def list_images(spark, folder, suffix=S.IMAGE_SUFFIX, recursive=False, slices=1):
    """Image files with their id, which is the file name without its suffix. No file is opened."""
    return read_images(spark, folder, suffix, recursive, slices, content=False)
