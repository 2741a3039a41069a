import math
import random

import numpy as np
import pytest
from conftest import rows

from imageset_spark.functions import range_buckets, running_total
from imageset_spark.operators import evaluation, history


def scored(spark, pairs, parts=3):
    data = [(f"s{i:05d}", label, float(score)) for i, (label, score) in enumerate(pairs)]
    frame = spark.createDataFrame(data, "sample_id string, label bigint, score double")
    return frame.repartition(parts)


def random_pairs(seed, n=400):
    pick = random.Random(seed)
    # A third of all rows share one score.
    return [
        (int(pick.random() < 0.3), 0.5 if pick.random() < 0.33 else round(pick.random(), 2))
        for _ in range(n)
    ]


def brute_auc(pairs):
    pos = [s for y, s in pairs if y]
    neg = [s for y, s in pairs if not y]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


def brute_points(pairs):
    out = {(math.inf, 0, 0)}
    for t in {s for _, s in pairs}:
        out.add((t, sum(y for y, s in pairs if s >= t), sum(1 - y for y, s in pairs if s >= t)))
    return out


@pytest.mark.parametrize("seed, n_buckets", [(1, 1), (2, 5), (3, 64)])
def test_curve_area_and_threshold(spark, seed, n_buckets):
    pairs = random_pairs(seed)
    frame = scored(spark, pairs, parts=seed * 3)
    points = evaluation.roc_points(frame, n_buckets).collect()
    assert {(r.threshold, r.tp, r.fp) for r in points} == brute_points(pairs)
    assert evaluation.roc_auc(frame, n_buckets).first().auc == pytest.approx(brute_auc(pairs))
    n_pos = sum(y for y, _ in pairs)
    gains = [(tp / n_pos - fp / (len(pairs) - n_pos), t) for t, tp, fp in brute_points(pairs)]
    best = evaluation.youden_threshold(frame, n_buckets).first()
    assert (best.j, best.threshold) == max(gains)


def test_threshold_is_infinite_when_scores_are_no_help(spark):
    worse = scored(spark, [(1, 0.1), (0, 0.9)])
    assert evaluation.youden_threshold(worse).first().threshold == math.inf


def test_area_needs_both_classes(spark):
    assert evaluation.roc_auc(scored(spark, [(1, 0.1), (1, 0.9)])).first().auc is None


def test_metrics_of_the_published_matrix(spark):
    matrix = spark.createDataFrame([(671, 2532, 569, 231)], "tp bigint, tn bigint, fp bigint, fn bigint")
    found = evaluation.binary_metrics(matrix).first()
    assert found.sensitivity == found.recall == 0.7439024390243902
    assert found.specificity == 0.8165108029667849
    assert found.precision == 0.5411290322580645
    assert found.f1 == 0.6265172735760971


def test_empty_denominators(spark):
    matrix = spark.createDataFrame([(0, 0, 0, 0)], "tp bigint, tn bigint, fp bigint, fn bigint")
    found = evaluation.binary_metrics(matrix).first()
    assert (found.precision, found.recall, found.f1, found.specificity) == (0.0, 0.0, 0.0, None)


def test_confusion_counts_the_threshold_as_positive(spark):
    frame = scored(spark, [(1, 0.5), (0, 0.5), (1, 0.49), (0, 0.2)])
    assert tuple(evaluation.confusion(frame, 0.5).first()) == (1, 1, 1, 1)


def test_report_takes_threshold_from_validation_and_metrics_from_test(spark):
    valid = scored(spark, [(1, 0.8), (1, 0.6), (0, 0.4), (0, 0.2)])
    test = scored(spark, [(1, 0.7), (1, 0.5), (0, 0.65), (0, 0.1)])
    found = evaluation.eval_report(valid, test, model="m").first()
    assert (found.model, found.threshold, found.test_auc) == ("m", 0.6, 0.75)
    assert tuple(found.confusion_matrix) == (1, 1, 1, 1)


@pytest.mark.parametrize("n", [1, 31, 32, 33, 64, 75])
def test_loss_is_the_mean_of_batch_means(spark, n):
    pick = random.Random(n)
    data = [(f"s{i:03d}", pick.randint(0, 1), pick.uniform(-40, 40)) for i in range(n)]
    frame = spark.createDataFrame(data, "sample_id string, label bigint, logit double")
    losses = [max(z, 0) - z * y + math.log1p(math.exp(-abs(z))) for _, y, z in data]
    batch_means = [np.mean(losses[i:i + 32]) for i in range(0, n, 32)]
    found = evaluation.loss_accuracy(frame.repartition(5)).first()
    assert found.batch_mean_loss == pytest.approx(np.mean(batch_means))
    assert found.row_mean_loss == pytest.approx(np.mean(losses))
    assert found.accuracy == sum((z > 0) == (y == 1) for _, y, z in data) / n


def test_batches_cut_rows_in_id_order(spark):
    frame = spark.createDataFrame([(f"s{i:03d}",) for i in range(70)], "sample_id string")
    found = evaluation.batches(frame.repartition(6), 32)
    assert rows(found) == [(f"s{i:03d}", i // 32) for i in range(70)]


def test_scores_of_a_supplied_model(spark):
    data = [("a", [1.0, 2.0]), ("b", [0.0, -1.0])]
    frame = spark.createDataFrame(data, "sample_id string, tensor array<double>")

    def make():
        return lambda inputs: inputs @ np.array([1.0, 0.5])

    found = evaluation.batch_score(frame, make, input_shape=(2,))
    assert {r.sample_id: r.logit for r in found.collect()} == {"a": 2.0, "b": -0.5}
    assert found.where("sample_id = 'a'").first().score == pytest.approx(1 / (1 + math.exp(-2)))


@pytest.mark.parametrize("n_buckets", [1, 4, 50])
def test_running_totals_within_groups(spark, n_buckets):
    pick = random.Random(n_buckets)
    data = [("ab"[i % 3 == 0], i, pick.randint(0, 9)) for i in range(200)]
    frame = spark.createDataFrame(data, "g string, at bigint, v bigint").repartition(5)
    ranges = range_buckets(frame, "at", n_buckets)
    found = {r.at: r.run_v for r in running_total(ranges, "at", ["v"], group=["g"]).collect()}
    for g, at, _ in data:
        assert found[at] == sum(v for h, a, v in data if h == g and a <= at)


def test_saved_epochs_and_run_summary(spark):
    losses = {"a": [0.9, 0.7, 0.7, 0.8, 0.6], "b": [0.5, 0.6]}
    data = [(run, i + 1, loss, 1 - loss) for run, all_ in losses.items() for i, loss in enumerate(all_)]
    frame = spark.createDataFrame(data, "run string, epoch bigint, val_loss double, val_acc double")
    saves = history.checkpoint_saves(frame, n_buckets=3)
    assert rows(saves.where("saved"), "run", "epoch") == [("a", 1), ("a", 2), ("a", 5), ("b", 1)]
    assert rows(history.run_summary(frame)) == [
        ("a", 0.6, 5, 5, 0.4), ("b", 0.5, 1, 2, 0.4)
    ]


@pytest.mark.parametrize("score, label", [(None, 1), (float("nan"), 0), (0.5, None), (0.5, 2)])
def test_rows_that_cannot_be_judged_fail(spark, score, label):
    frame = spark.createDataFrame(
        [("good", 0.25, 0), ("odd", score, label)], "sample_id string, score double, label int"
    )
    for metric in (lambda f: evaluation.confusion(f, 0.5), evaluation.roc_auc, evaluation.roc_points):
        with pytest.raises(Exception, match="label 0 or 1: odd"):
            metric(frame).collect()


def test_scoring_from_plane_to_logit_is_one_pass(spark):
    from imageset_spark.operators.images import ImageSpec, stored_planes, to_tensor

    spec = ImageSpec(height=2, width=2)
    planes = spark.createDataFrame(
        [(f"s{i}", 2, 2, [i / 10, 0.5, 1.0, 0.0]) for i in range(10)],
        "sample_id string, height int, width int, plane array<float>",
    )
    found = evaluation.score_planes(
        planes, lambda batch: stored_planes(batch, spec), spec, lambda: lambda x: x.reshape(len(x), -1).sum(1), batch_size=3,
        drop=["plane"],
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "transform(" not in plan and "plane" not in found.columns
    expected = {r.sample_id: sum(r.tensor) for r in to_tensor(planes, spec).collect()}
    for row in found.collect():
        assert row.logit == pytest.approx(expected[row.sample_id], abs=1e-4)
        assert row.score == pytest.approx(1 / (1 + 2.718281828459045 ** -row.logit))
