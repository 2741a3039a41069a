"""Small DataFrame helpers shared by the operators."""

from pyspark.sql import functions as F

#: Bytes of text in one Arrow batch handed to a Python worker.
BATCH_BYTES = 8 << 20
#: Bits of a broadcast bitmap: 2,048 pieces of 4 KB, 8 MB.
BITMAP_BITS = 1 << 26
_PIECE_BITS = 1 << 15


def fresh(df, *names):
    """Column names that ``df`` does not use yet, derived from ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(col):
    """The text, with null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def text_key(col):
    """Hash that tells texts of one id apart; equal rows share it."""
    return F.xxhash64(text_of(col))


def group_key(col):
    """A text key without null: null gets a key of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit("-"))


def let(value, then):
    """``then(value)`` with the value computed once, also where a lambda uses it for each element."""
    return F.element_at(F.transform(F.array(value), then), 1)


def left_join(left, right, names):
    """Left join on ``names``, null equal to null; ``right`` adds its other columns."""
    renamed = right.select(
        *[F.col(c).alias(f"__r_{c}" if c in names else c) for c in right.columns]
    )
    on = F.lit(True)
    for name in names:
        on = on & left[name].eqNullSafe(renamed[f"__r_{name}"])
    return left.join(renamed, on, "left").drop(*[f"__r_{c}" for c in names])


def may_be_among(rows, found, column):
    """Rows whose ``column`` may be among the values of ``found``: all that are, and few others.

    The values' hashes fill a bitmap of a fixed size (``BITMAP_BITS``, 8 MB), which is
    broadcast, so rows that a join would drop are not moved to meet it.
    """
    bit, piece, bits = fresh(rows, "_bit", "_piece", "_bits")
    hashed = F.pmod(F.xxhash64(column), F.lit(BITMAP_BITS))
    pieces = found.select(hashed.alias(bit)).groupBy(F.expr(f"{bit} div {_PIECE_BITS}").alias(piece)).agg(
        F.bitmap_construct_agg(F.col(bit) % _PIECE_BITS).alias(bits)
    )
    byte = F.conv(F.hex(F.substring(bits, F.expr(f"int(({bit} % {_PIECE_BITS}) div 8) + 1"), F.lit(1))), 16, 10)
    marked = F.getbit(byte.cast("int"), (F.col(bit) % 8).cast("int"))
    return (
        rows.withColumn(bit, hashed)
        .withColumn(piece, F.expr(f"{bit} div {_PIECE_BITS}"))
        .join(F.broadcast(pieces), piece)
        .where(marked == 1)
        .select(*rows.columns)
    )


def bound_batches(spark):
    """Bound an Arrow batch by bytes as well as rows, so that long texts fit in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
