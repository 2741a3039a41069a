import hashlib
import json

import numpy as np
import pytest
from conftest import rows

from imageset_spark import schemas as S
from imageset_spark import sources
from imageset_spark.sources.annotations import unparsed_cells

INF = float("inf")


def write(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_labels_are_found_by_name_and_missing_texts_become_null(spark, tmp_path):
    path = write(
        tmp_path, "labels.csv",
        "Target,extra,patientId,x,y,width,height\n"
        "1,q,0001,1.5,inf,-inf,4\n0,q,0002,,NA,nan,null\n0.0,q,NULL,#N/A,-NaN,None,\n",
    )
    found = sources.read_labels(spark, path).orderBy("row_seq").drop("row_seq").collect()
    assert [tuple(r) for r in found] == [
        ("0001", 1.5, INF, -INF, 4.0, 1.0),
        ("0002", None, None, None, None, 0.0),
        (None, None, None, None, None, 0.0),
    ]


def test_cells_that_are_no_numbers(spark, tmp_path):
    path = write(tmp_path, "l.csv", "patientId,x,y,width,height,Target\na,1,oops,3,4,1\n")
    assert sources.read_labels(spark, path).first().y is None
    assert unparsed_cells(spark, path).first().asDict() == {
        "x": 0, "y": 1, "width": 0, "height": 0, "Target": 0
    }
    with pytest.raises(Exception, match="not a number in column y"):
        sources.read_labels(spark, path, strict=True).collect()


def test_missing_columns_are_named(spark, tmp_path):
    path = write(tmp_path, "l.csv", "patientId,x,y\na,1,2\n")
    with pytest.raises(ValueError, match="Target, height, width"):
        sources.read_labels(spark, path)


def test_source_order_over_several_files(spark, tmp_path):
    head = "patientId,x,y,width,height,Target\n"
    sizes = {"b.csv": 400, "a.csv": 3, "c.csv": 50}
    for name, count in sizes.items():
        write(tmp_path, name, head + "".join(f"{name}-{i:04d},1,1,1,1,1\n" for i in range(count)))
    ordered = sources.read_labels(spark, str(tmp_path)).orderBy("row_seq").collect()
    ids = [r.patientId for r in ordered]
    assert ids == sorted(ids) and len(ids) == 453
    one = sources.read_labels(spark, str(tmp_path / "a.csv"))
    assert one.schema == sources.read_labels(spark, str(tmp_path)).schema


@pytest.mark.parametrize("read, columns", [
    (sources.read_labels, S.LABELS_SCHEMA.names), (sources.read_classes, S.CLASSES_SCHEMA.names),
    (sources.read_manifest, S.IMAGE_SCHEMA.names),
])
def test_files_of_other_column_order_are_refused(spark, tmp_path, read, columns):
    cells = [str(i) for i in range(len(columns))]
    for name, order in (("a.csv", 1), ("b.csv", -1)):
        write(tmp_path, name, ",".join(columns[::order]) + "\n" + ",".join(cells[::order]) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read(spark, str(tmp_path)).collect()
    assert read(spark, str(tmp_path / "b.csv")).first()[0] == "0"


def test_source_order_within_a_file_cut_in_many_splits(spark, tmp_path):
    body = "".join(f"{i:06d},1,1,1,1,1\n" for i in range(20000))
    path = write(tmp_path, "l.csv", "patientId,x,y,width,height,Target\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = sources.read_labels(spark, path)
        assert found.rdd.getNumPartitions() > 8
        ids = [r.patientId for r in found.orderBy("row_seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ids == sorted(ids)


def test_classes_keep_duplicates_and_null_missing(spark, tmp_path):
    path = write(tmp_path, "c.csv", "patientId,class\na,Normal\na,Normal\nb,NA\n")
    found = rows(sources.read_classes(spark, path))
    assert found == [("a", "Normal"), ("a", "Normal"), ("b", None)]


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_canonical_tables_round_trip(spark, tmp_path, format):
    path = str(tmp_path / "images")
    images = spark.createDataFrame(
        [("007", "/i/007.dcm", 1, "d", "Lung Opacity", "dropped")],
        S.IMAGE_SCHEMA.names + ["extra"],
    )
    sources.write_canonical(images, path, S.IMAGE_SCHEMA, format)
    back = sources.read_manifest(spark, path, format=format)
    assert back.columns == S.IMAGE_SCHEMA.names
    assert rows(back) == [("007", "/i/007.dcm", 1, "d", "Lung Opacity")]


def test_empty_table_still_has_a_header(spark, tmp_path):
    path = tmp_path / "boxes"
    sources.write_canonical(spark.createDataFrame([], S.BOX_SCHEMA), str(path), S.BOX_SCHEMA)
    (part,) = path.glob("_published/*/data/part-*.csv")
    assert part.read_text().strip() == "sample_id,x,y,width,height"
    assert sources.read_manifest(spark, str(path), S.BOX_SCHEMA).collect() == []


def test_listing_uses_stems_and_suffix(spark, tmp_path):
    for name in ("a.dcm", "b.c.dcm", "note.txt"):
        (tmp_path / name).write_bytes(b"12345")
    listing = sources.list_images(spark, str(tmp_path))
    assert rows(listing, "sample_id", "length") == [("a", 5), ("b.c", 5)]


def test_checksum_names_below_a_root(spark):
    files = spark.createDataFrame(
        [("file:/x/run/a/part-0", bytearray(b"1")), ("file:/x/run/b/part-0", bytearray(b"2"))],
        "path string, content binary",
    )
    assert [r[0] for r in rows(sources.checksum_files(files, root="/x/run/"))] == ["a/part-0", "b/part-0"]
    assert [r[0] for r in rows(sources.checksum_files(files))] == ["part-0", "part-0"]


def test_audit_of_real_files(spark, tmp_path):
    grids = {"flat": [[1, 2, 3]], "deep": [[[1]]], "empty": [[], []]}
    for name, grid in grids.items():
        (tmp_path / f"{name}.dcm").write_text(json.dumps(grid))
    (tmp_path / "broken.dcm").write_bytes(b"\xff\x00")
    files = sources.read_files(spark, str(tmp_path))
    files = files.select(sources.files.stem("path", ".dcm").alias("sample_id"), "content")
    audit = sources.audit_images(files, lambda content: np.array(json.loads(content)))
    assert rows(audit) == [
        ("broken", False, None, None, None), ("deep", True, 3, None, None),
        ("empty", True, 2, 0, 2), ("flat", True, 2, 3, 1),
    ]


def test_checksums(spark, tmp_path):
    payload = {"m.pt": b"model" * 1000, "n.pt": b"other"}
    for name, content in payload.items():
        (tmp_path / name).write_bytes(content)
    expected = {name: hashlib.sha256(content).hexdigest() for name, content in payload.items()}
    files = sources.read_files(spark, str(tmp_path), suffix=".pt")
    found = sources.checksum_files(files)
    assert dict(rows(found)) == expected
    lines = sources.checksum_lines(found).collect()
    assert {r.line for r in lines} == {f"{v}  {k}" for k, v in expected.items()}
    paths = spark.createDataFrame([(n, str(tmp_path / n)) for n in payload], "name string, path string")
    assert dict(rows(sources.checksum_paths(paths, chunk_bytes=64))) == expected
    stored = spark.createDataFrame(
        [("m.pt", expected["m.pt"]), ("gone.pt", "00")], "name string, sha256 string"
    )
    verdict = {r.name: r.matches for r in sources.verify_checksums(found, stored).collect()}
    assert verdict == {"m.pt": True, "n.pt": False, "gone.pt": False}


def test_report_json_sorts_fields(spark):
    report = spark.createDataFrame([(2, 1, {"x": 1})], "b int, a int, c map<string,bigint>")
    assert sources.report_json(report).first()[0] == '{"a":1,"b":2,"c":{"x":1}}'


def test_report_is_written_as_json(spark, tmp_path):
    path = tmp_path / "report"
    sources.write_report(spark.createDataFrame([(1, 0.5)], "a int, b double"), str(path))
    (part,) = path.glob("part-*.json")
    assert json.loads(part.read_text()) == {"a": 1, "b": 0.5}


def test_a_batch_sent_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "history")
    schema = "run string, epoch int, val_loss double"

    def epochs(*numbers):
        return spark.createDataFrame([("run", n, 0.5) for n in numbers], schema)

    for batch, numbers in (("a", (1, 2)), ("b/2", (3,)), ("a", (1, 2)), ("b/2", (3, 4))):
        sources.append_history(epochs(*numbers), path, batch)
    found = sources.read_batches(spark, path, epochs(1).schema)
    assert found.columns == ["run", "epoch", "val_loss"]
    assert rows(found, "epoch") == [(1,), (2,), (3,), (4,)]
    one = sources.read_batches(spark, path, epochs(1).schema, "b/2")
    assert rows(one, "epoch") == [(3,), (4,)]
    for wrong in ("", " "):
        with pytest.raises(ValueError, match="name"):
            sources.append_history(epochs(1), path, wrong)
    with pytest.raises(ValueError, match="batch"):
        sources.append_batch(epochs(1).withColumnRenamed("run", "Batch"), path, "a")
