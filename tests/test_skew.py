import pytest
from conftest import rows
from pyspark.sql import functions as F

from imageset_spark.functions import hot_keys, salted_join


@pytest.fixture(scope="module")
def sides(spark):
    many = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97))
        .alias("key"),
        F.col("id").alias("value"),
    )
    one = spark.createDataFrame(
        [("hot", 1), *[(f"k{i}", i) for i in range(0, 97, 2)], ("alone", 0)],
        "key string, payload int",
    )
    return many, one, many.groupBy("key").agg(F.count("*").alias("n"))


@pytest.mark.parametrize("hot_rows, most_keys", [(100, 1000), (5, 30), (5, 1)])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(sides, how, hot_rows, most_keys):
    many, one, counts = sides
    expected = rows(many.join(one, "key", how))
    limits = {"hot_rows": hot_rows, "most_keys": most_keys}
    assert rows(salted_join(many, one, "key", how, counts=counts, **limits)) == expected
    sized = one.join(counts, "key", "left").fillna(0, "n")
    assert rows(salted_join(many, sized, "key", how, **limits).drop("n")) == expected


def test_hot_rows_are_spread_over_slices(sides):
    many, _, counts = sides
    hot = hot_keys(counts, "key", "n", hot_rows=100)
    assert rows(hot) == [("hot", 10)]


def test_no_partition_gets_the_whole_hot_key(spark, sides):
    many, one, counts = sides
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = salted_join(many, one, "key", "inner", counts=counts, hot_rows=50)
        place = F.spark_partition_id().alias("p")
        found = [r.n for r in joined.where("key = 'hot'").groupBy(place).agg(
            F.count("*").alias("n")).collect()]
    finally:
        for name in settings:
            spark.conf.unset(name)
    # Twenty slices of about 50 rows, dealt over four partitions.
    assert sum(found) == 1000 and max(found) <= 10 * 50


def test_every_key_above_the_threshold_is_cut(spark):
    counts = spark.range(3000).select(F.col("id").cast("string").alias("key"), F.lit(10).alias("n"))
    assert hot_keys(counts, "key", "n", hot_rows=9).count() == 3000
    # No more than most_keys keys can hold more than 1 / most_keys of the rows.
    assert hot_keys(counts, "key", "n", hot_rows=1, most_keys=2999).count() == 0


def test_rows_without_a_key_are_spread(spark):
    many = spark.range(2000).select(F.lit(None).cast("string").alias("key"), "id")
    one = spark.createDataFrame([("a", 1)], "key string, n int")
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
        spark.conf.set(name, "-1" if name.endswith("Threshold") else "false")
    try:
        joined = salted_join(many, one, "key", "left", salt_cols=["id"])
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(name)
    assert sum(sizes) == 2000 and max(sizes) < 1000


def test_outer_join_is_refused(sides):
    many, one, counts = sides
    with pytest.raises(ValueError):
        salted_join(many, one, "key", "full_outer", counts=counts)
