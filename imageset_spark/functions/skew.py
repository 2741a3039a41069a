"""Joins between many rows per key and one row per key, safe for hot keys.

AQE splits a skewed join partition only when both inputs come straight from a
shuffle. Here the one-row-per-key side is usually an aggregate, so hot keys are
salted explicitly: every key with more rows than a threshold is cut in slices,
and the single row on the other side is repeated once per slice. No row is
dropped. The threshold is ``HOT_ROWS``, or ``1 / MOST_KEYS`` of all rows if that
is more, so at most ``MOST_KEYS`` keys can lie above it however large the table.
"""

from pyspark.sql import functions as F

HOT_ROWS = 500_000
MOST_KEYS = 100_000


def _threshold(counts, n, hot_rows, most_keys):
    """Rows above which a key is cut up: exceeded by ``most_keys`` keys at most."""
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0)).alias("total")).scalar()
    return F.greatest(F.lit(float(hot_rows)), total / F.lit(float(most_keys)))


def _slices(n, threshold):
    return F.ceil(F.col(n) / threshold).cast("int")


def hot_keys(counts, key, n, hot_rows=HOT_ROWS, most_keys=MOST_KEYS):
    """Every key above the threshold with its slice count, ``most_keys`` rows at most."""
    threshold = _threshold(counts, n, hot_rows, most_keys)
    return counts.where(F.col(n) > threshold).select(
        F.col(key), _slices(n, threshold).alias("_slices")
    )


def salted_join(many, one, key, how, n="n", counts=None, hot_rows=HOT_ROWS, salt_cols=None,
                most_keys=MOST_KEYS):
    """Join ``many`` (any number of rows per key) to ``one`` (unique per key).

    Column ``n`` of ``counts`` holds the number of rows of ``many`` per key; it
    is looked for in ``one`` unless ``counts`` is given. ``salt_cols`` picks the
    slice; together they should tell rows of one key apart. The slice depends on
    row content only, so a retried task puts every row in the same slice again.
    Rows without a key match nothing and are spread over all tasks.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join does not support how={how!r}")
    sized = one if counts is None else counts
    hot = F.broadcast(hot_keys(sized, key, n, hot_rows, most_keys))
    salt_cols = salt_cols or [name for name in many.columns if name != key]
    spread = F.xxhash64(*salt_cols)
    salted = (
        many.join(hot, key, "left")
        .withColumn(
            "_salt",
            F.when(F.col(key).isNull(), F.pmod(spread, F.lit(1 << 20)).cast("int"))
            .when(F.col("_slices").isNull(), F.lit(0))
            .otherwise(F.pmod(spread, F.col("_slices").cast("bigint")).cast("int")),
        )
        .drop("_slices")
    )
    if counts is None:
        threshold = _threshold(sized, n, hot_rows, most_keys)
        slices = F.when(F.col(n) > threshold, _slices(n, threshold)).otherwise(F.lit(1))
        repeated = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), slices - 1)))
        repeated = repeated.drop(*([n] if n in many.columns else []))
    else:
        slices = F.coalesce("_slices", F.lit(1))
        repeated = (
            one.join(hot, key, "left")
            .withColumn("_salt", F.explode(F.sequence(F.lit(0), slices - 1)))
            .drop("_slices")
        )
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
