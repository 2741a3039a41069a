"""The evaluation job: score two splits, choose the threshold, report on test."""

import numpy as np

from ..functions import stage
from ..operators import evaluation
from ..operators.evaluation import eval_report
from ..operators.images import decoded_plane, stored_planes, with_planes
from ..sources import open_path


def score_planes(manifest, planes, spec, make_predictor):
    """Predictions for manifest rows whose preprocessed planes are stored.

    A row without a plane fails the job.
    """
    joined = with_planes(manifest, planes.select("sample_id", "plane"))
    scored = evaluation.score_planes(joined, lambda batch: stored_planes(batch, spec), spec, make_predictor, drop=["plane"])
    return stage(scored.select(*manifest.columns, "logit", "score"), "predictions")


def score_files(manifest, decoder, spec, make_predictor, opener=open_path, path_col="image_path", tasks=None):
    """Predictions for manifest rows straight from their image files.

    One pass of Python from file to logit: no pixel leaves the task that reads
    it. Rows are spread over ``tasks`` by path, by default one per shuffle
    partition.
    """
    tasks = tasks or int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def plane_of(path):
        with opener(path, "rb") as handle:
            return decoded_plane(*decoder(handle.read()), spec)

    def planes_of(batch):
        return np.stack([plane_of(path) for path in batch.column(path_col).to_pylist()])

    scored = evaluation.score_planes(manifest.repartition(tasks, path_col), planes_of, spec, make_predictor)
    return stage(scored.select(*manifest.columns, "logit", "score"), "predictions")


def evaluate_predictions(predictions, n_buckets=None, **facts):
    """Threshold from the validation rows, report on the test rows.

    ``predictions`` are written once by the scoring step, so the model runs once
    per image however many metrics are taken.
    """
    return eval_report(
        predictions.where("split = 'validation'"), predictions.where("split = 'test'"),
        n_buckets, **facts,
    )
