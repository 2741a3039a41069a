import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from imageset_spark.functions import shuffles
from imageset_spark.operators import splits


def model(x, n, key):
    a, b = shuffles.halves(n)

    def hashed(step, half):
        return int(hashlib.md5(f"{key}:{step}:{half}".encode()).hexdigest()[:8], 16)

    while True:
        left, right = divmod(x, b)
        for step in range(shuffles.ROUNDS):
            if step % 2 == 0:
                left = (left + hashed(step, right)) % a
            else:
                right = (right + hashed(step, left)) % b
        x = left * b + right
        if x < n:
            return x


def test_a_bijection_for_every_number_of_rows(spark):
    sizes = [(n, *shuffles.halves(n)) for n in range(1, 301)]
    table = spark.createDataFrame(sizes, "n bigint, a bigint, b bigint").withColumn("x", F.explode(F.expr("sequence(0, n - 1)")))
    placed = table.withColumn("place", shuffles.shuffled_place("x", F.col("n"), "k", (F.col("a"), F.col("b"))))
    found = {}
    for r in placed.collect():
        found.setdefault(r.n, {})[r.x] = r.place
    for n in range(1, 301):
        assert sorted(found[n].values()) == list(range(n))
    for n in (1, 2, 7, 97, 300):
        assert found[n] == {x: model(x, n, "k") for x in range(n)}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 1000, 10_007, 1_000_003, 10**9 + 7, 10**12, 10**12 + 39])
def test_few_numbers_lie_beyond(n):
    a, b = shuffles.halves(n)
    assert n <= a * b and a * b - n <= 64 and b <= 2 * (shuffles._NARROWEST + 1) * a + 1


def test_epochs_differ_and_no_row_is_moved(spark):
    examples = spark.range(1000).select(F.format_string("s%04d", "id").alias("sample_id"))
    numbered = splits.number_examples(examples.repartition(5))
    assert rows(numbered, "sample_id", "number") == [(f"s{i:04d}", i) for i in range(1000)]
    first, second = (splits.epoch_places(numbered, epoch, batch_size=64) for epoch in (1, 2))
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    a, b = ({r.sample_id: r.place for r in f.collect()} for f in (first, second))
    assert sorted(a.values()) == sorted(b.values()) == list(range(1000))
    assert sum(a[s] == b[s] for s in a) < 20
    # Neighbours are spread: about half of all steps go up.
    ups = sum(a[f"s{i:04d}"] < a[f"s{i + 1:04d}"] for i in range(999))
    assert 420 < ups < 580
    sizes = {r.batch_no: r["count"] for r in first.groupBy("batch_no").count().collect()}
    assert sizes == {**{i: 64 for i in range(15)}, 15: 40}
    assert {r.sample_id: r.place for r in splits.epoch_places(numbered.repartition(9), 1).collect()} == a


def test_no_examples(spark):
    none = splits.number_examples(spark.createDataFrame([], "sample_id string"))
    assert splits.epoch_places(none, 1).collect() == []
