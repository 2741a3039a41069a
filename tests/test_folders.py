import numpy as np
import pytest
from conftest import rows

from imageset_spark import schemas as S
from imageset_spark import sources
from imageset_spark.operators import validation
from imageset_spark.sources import folders


@pytest.fixture
def folder(tmp_path):
    for name, content in {
        "a.dcm": b"12345", "empty.dcm": b"", "note.txt": b"x", "sub/b.c.dcm": b"123", "sub/deep/d.dcm": b"1", "other/e.dcm": b"22",
    }.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    (tmp_path / "dir.dcm").mkdir()
    (tmp_path / "dir.dcm" / "inside").write_bytes(b"x")
    return str(tmp_path)


def reader(folder, columns, **options):
    return folders.ImageFolderReader({"path": folder, **options}, columns)


def read(source):
    out = []
    for partition in source.partitions():
        for batch in source.read(partition):
            out += batch.to_pylist()
    return out


def test_folders_are_listed_by_tasks(spark, folder):
    flat = sources.list_images(spark, folder)
    assert rows(flat, "sample_id", "length") == [("a", 5), ("empty", 0)]
    deep = sources.list_images(spark, folder, recursive=True)
    assert rows(deep, "sample_id", "length") == [("a", 5), ("b.c", 3), ("d", 1), ("e", 2), ("empty", 0)]
    assert {r.path for r in deep.collect()} == {
        f"{folder}/{p}" for p in ("a.dcm", "empty.dcm", "sub/b.c.dcm", "sub/deep/d.dcm", "other/e.dcm")
    }
    assert rows(sources.list_images(spark, f"file:{folder}/sub"), "sample_id") == [("b.c",)]


def test_planning_holds_folders_only(folder):
    planned = reader(folder, ["sample_id"], recursive="true", slices="3").partitions()
    assert sorted({p.name for p in planned}) == ["", "/dir.dcm", "/other", "/sub"] and len(planned) == 12


@pytest.mark.parametrize("slices", [1, 2, 5])
def test_slices_part_the_files(folder, slices):
    found = read(reader(folder, ["path"], recursive="true", slices=str(slices), suffix=""))
    assert sorted(f["path"][len(folder) :] for f in found) == sorted([
        "/a.dcm", "/empty.dcm", "/note.txt", "/sub/b.c.dcm", "/sub/deep/d.dcm", "/other/e.dcm", "/dir.dcm/inside"])


def test_content_is_read_only_when_asked_for(folder, monkeypatch):
    class Closed:
        def __init__(self, system):
            self.system = system

        def get_file_info(self, selector):
            return self.system.get_file_info(selector)

        def open_input_stream(self, path):
            raise PermissionError(path)

    whole = folders.file_system
    assert {f["sample_id"]: f["content"] for f in read(reader(folder, ["sample_id", "content"]))} == {"a": b"12345", "empty": b""}
    monkeypatch.setattr(folders, "file_system", lambda path: (Closed(whole(path)[0]), whole(path)[1]))
    assert len(read(reader(folder, ["sample_id", "path", "length"]))) == 2
    # A file that cannot be read keeps its row.
    assert [f["content"] for f in read(reader(folder, ["content"]))] == [None, None]


def test_batches_are_bounded(folder, monkeypatch):
    monkeypatch.setattr(folders, "BATCH_BYTES", 3)
    source = reader(folder, ["sample_id", "content"], recursive="true")
    held = [[len(c) for c in b.column(1).to_pylist()] for p in source.partitions() for b in source.read(p)]
    assert sum(map(len, held)) == 5 and all(sum(sizes[:-1]) < 3 for sizes in held)


def test_missing_folder_and_unknown_column(spark, tmp_path):
    with pytest.raises(Exception, match="gone"):
        sources.list_images(spark, str(tmp_path / "gone")).collect()
    spark.dataSource.register(folders.ImageFolder)
    with pytest.raises(Exception, match="has no columns size"):
        spark.read.format("image_folder").schema("size bigint").load(str(tmp_path)).collect()


def test_every_kind_of_file_gets_its_reason(spark, tmp_path):
    contents = {"good": b"\1\2", "cube": b"cube", "broken": b"??", "empty": b"", "inside/x": b"\1"}
    table = spark.createDataFrame(
        [(f"{tmp_path}/{n}{'' if '/' in n else '.dcm'}".replace("inside", "folder.dcm"), bytearray(c)) for n, c in contents.items()],
        "path string, content binary",
    )
    written = sources.write_files(table)
    assert sorted(r.length for r in written.collect()) == [0, 1, 2, 2, 4]
    # Writing again leaves the same files and no parts of files.
    written.collect()
    assert {p.name for p in tmp_path.iterdir()} == {"good.dcm", "cube.dcm", "broken.dcm", "empty.dcm", "folder.dcm"}

    def decode(content):
        if content == b"cube":
            return np.zeros((1, 1, 1))
        if content in (b"??", b""):
            raise ValueError
        return np.frombuffer(content, "uint8").reshape(1, -1)

    names = ["good", "cube", "broken", "empty", "folder", "absent"]
    images = spark.createDataFrame([(n, f"{tmp_path}/{n}.dcm", 1) for n in names], "sample_id string, image_path string, label int")
    expected = {
        "good": None, "cube": S.INVALID_IMAGE_DIMENSIONS, "broken": S.UNREADABLE_IMAGE, "empty": S.UNREADABLE_IMAGE,
        "folder": S.IMAGE_FILE_NOT_FOUND, "absent": S.IMAGE_FILE_NOT_FOUND,
    }
    no_boxes = spark.createDataFrame([], S.BOX_SCHEMA)
    by_path = sources.audit_paths(images, decode)
    by_folder = sources.audit_images(sources.read_images(spark, str(tmp_path)), decode)
    by_address = sources.audit_paths(
        images.selectExpr("sample_id", "concat('file://', image_path) AS image_path", "label"), decode)
    for audit in (by_path, by_folder, by_address):
        state = validation.image_state(images, no_boxes, audit).withColumn("reason", validation.image_reason())
        assert {r.sample_id: r.reason for r in state.collect()} == expected


def test_opening_what_is_no_file(tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.open_path(str(tmp_path / "gone"))
    with pytest.raises(IsADirectoryError):
        sources.open_path(f"file:{tmp_path}")
