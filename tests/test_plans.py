import json
import sys
from types import SimpleNamespace

import numpy as np
import pytest
from conftest import rows

from imageset_spark import schemas as S
from imageset_spark import sources
from imageset_spark.functions import staging_dir
from imageset_spark.operators import images, splits
from imageset_spark.plans import evaluate_predictions, ingest_files, score_files, score_planes


def test_ingestion_from_files(spark, tmp_path):
    (tmp_path / "labels.csv").write_text(
        "patientId,x,y,width,height,Target\n"
        "ok,10,20,30,40,1\nok,10,20,30,40,1\nok,1,2,3,4,1\n"
        "plain,,,,,0\noutside,90,20,30,40,1\nnofile,,,,,0\nbroken,,,,,0\n"
        "noclass,,,,,0\n,,,,,0\n"
    )
    (tmp_path / "classes.csv").write_text(
        "patientId,class\nok,Lung Opacity\nok,Lung Opacity\nplain,Normal\n"
        "outside,Lung Opacity\nnofile,Normal\nbroken,Normal\ntwo,Normal\ntwo,Lung Opacity\n"
    )
    folder = tmp_path / "images"
    folder.mkdir()
    for name in ("ok", "plain", "outside", "extra"):
        (folder / f"{name}.dcm").write_text(json.dumps([100, 100]))
    (folder / "broken.dcm").write_text("")
    opened = tmp_path / "opened"
    opened.mkdir()

    def count(path, mode):
        (opened / path.rsplit("/", 1)[-1]).touch()
        return open(path, mode)

    report = ingest_files(
        spark, str(tmp_path / "labels.csv"), str(tmp_path / "classes.csv"), str(folder),
        str(tmp_path / "out_images"), str(tmp_path / "out_boxes"),
        decoder=lambda content: np.zeros(json.loads(content)), opener=count,
    ).first().asDict()
    assert report == {
        "source_rows": 9, "accepted_images": 2, "positive_images": 1, "negative_images": 1,
        "bounding_boxes": 2, "duplicate_boxes_removed": 1, "rejected_records": 5,
        "rejection_reasons": {
            "box_outside_image": 1, "conflicting_classes": 1, "image_file_not_found": 1,
            "missing_class": 1, "unreadable_dicom": 1,
        },
    }
    # Only mapped images are opened: not the extra file, nor images that mapping refused.
    names = {p.name for p in opened.iterdir()}
    assert names == {"ok.dcm", "plain.dcm", "outside.dcm", "nofile.dcm", "broken.dcm"}
    written = sources.read_manifest(spark, str(tmp_path / "out_images"))
    assert rows(written, "sample_id", "label") == [("ok", 1), ("plain", 0)]
    boxes = sources.read_manifest(spark, str(tmp_path / "out_boxes"), S.BOX_SCHEMA)
    assert rows(boxes) == [("ok", 1.0, 2.0, 3.0, 4.0), ("ok", 10.0, 20.0, 30.0, 40.0)]


def test_the_report_reads_labels_twice_and_classes_once(spark, tmp_path):
    labels = [("a", 1.0, 2.0, 3.0, 4.0, 1.0, 1), ("b", None, None, None, None, 0.0, 2), (None, None, None, None, None, 0.0, 3)]
    tables = {
        "labels": spark.createDataFrame(labels, "patientId string, x double, y double, width double, height double, Target double, row_seq bigint"),
        "classes": spark.createDataFrame([("a", "Lung Opacity"), ("b", "Normal")], S.CLASSES_SCHEMA),
        "audit": spark.createDataFrame([("a", True, 2, 9, 9), ("b", True, 2, 9, 9)], S.AUDIT_SCHEMA),
    }
    for name, table in tables.items():
        table.write.parquet(str(tmp_path / name))
    scans, ingest_job = [], sys.modules["imageset_spark.plans.ingest"]
    read = {name: spark.read.parquet(str(tmp_path / name)) for name in tables}
    whole = ingest_job.stage

    def counted(df, name):
        scans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return whole(df, name)

    ingest_job.stage = counted
    try:
        result = ingest_job.ingest(read["labels"], read["classes"], read["audit"], "/images")
    finally:
        ingest_job.stage = whole
    plans = [plan for _, plan in scans] + [result.report._jdf.queryExecution().executedPlan().toString()]
    lines = [line for plan in plans for line in plan.split("\n") if "FileScan" in line]
    assert sum("[patientId#" in line and ",Target#" in line for line in lines) == 2
    assert sum("[patientId#" in line and ",class#" in line for line in lines) == 1
    assert [name for name, _ in scans] == ["mapping-verdict", "unique-boxes", "image-state", "judged-boxes", "image-verdict"]
    assert result.report.first().source_rows == 3


def small_corpus(spark, folder):
    data = [(f"s{i:03d}", [0, 255, 255 * (i % 2), 0]) for i in range(80)]
    for name, codes in data:
        (folder / f"{name}.bin").write_bytes(bytes(codes))
    table = spark.createDataFrame(
        [(name, 2, 2, 255, "MONOCHROME2", codes) for name, codes in data],
        "sample_id string, rows int, cols int, code_max bigint, photometric string, pixels array<int>",
    )
    manifest = spark.createDataFrame(
        [(name, str(folder / f"{name}.bin"), i % 2) for i, (name, _) in enumerate(data)],
        "sample_id string, image_path string, label int",
    )
    return table, splits.create_splits(manifest).where("split <> 'train'")


def test_evaluation_from_pixels_to_report(spark, tmp_path):
    spec = images.ImageSpec(height=2, width=2)
    table, manifest = small_corpus(spark, tmp_path)

    def model():
        return lambda batch: batch.reshape(len(batch), -1).sum(axis=1)

    def decode(content):
        return np.frombuffer(content, "uint8").reshape(2, 2), "MONOCHROME2"

    stored = score_planes(manifest, images.preprocess_images(table, spec), spec, model)
    direct = score_files(manifest, decode, spec, model, tasks=3)
    assert rows(stored, *manifest.columns, "score") == rows(direct, *manifest.columns, "score")
    found = evaluate_predictions(direct, model="sum").first()
    assert (found.model, found.test_auc, found.f1) == ("sum", 1.0, 1.0)
    assert tuple(found.confusion_matrix) == (6, 6, 0, 0)


def test_staging_needs_a_shared_folder_on_a_cluster():
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)))

    with pytest.raises(ValueError, match="shared"):
        staging_dir(session(**{"spark.master": "yarn"}))
    shared = {"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///stage/"}
    assert staging_dir(session(**shared)) == "hdfs:///stage"
    assert staging_dir(session(**{"spark.master": "local[2]"})).startswith("/")


def test_scoring_fails_on_a_manifest_row_without_its_plane(spark, tmp_path):
    table, manifest = small_corpus(spark, tmp_path)
    spec = images.ImageSpec(height=2, width=2)
    planes = images.preprocess_images(table.where("sample_id <> 's003'"), spec)
    with pytest.raises(Exception, match="no preprocessed image for s003"):
        score_planes(manifest, planes, spec, lambda: lambda x: x.reshape(len(x), -1).sum(1))
