"""Input shapes of the operators, derived from the given tables.

An order is an image: its line items are the label rows, its key decides class
and faults. Every row of the tables takes part.
"""

from pyspark.sql import functions as F

from imageset_spark import sources


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(key, n):
    return F.col(key) % n == 0


def _row_seq():
    """Source order within an order as one number: line, part, supplier, quantity."""
    wide = "decimal(38,0)"

    def placed(name, digits):
        return F.col(name).cast(wide) * F.lit(str(10**digits)).cast(wide)

    order = (
        placed("l_linenumber", 26) + placed("l_partkey", 14) + placed("l_suppkey", 2)
        + F.col("l_quantity").cast(wide)
    )
    return order.cast(wide).alias("row_seq")


def labels(spark, sf_dir):
    """patientId, x, y, width, height, Target, row_seq"""
    k = "l_orderkey"
    no_box = ~_every(k, 4)
    gap = _every(k, 73) & (F.col("l_partkey") % 2 == 0)
    null = F.lit(None).cast("double")

    def number(value):
        return F.lit(float(value))

    x = (
        F.when(no_box & ~_every(k, 79), null).when(gap, null)
        .when(_every(k, 61), number(-1)).when(_every(k, 59), number(1000))
        .when(_every(k, 47), number(10)).otherwise((F.col("l_partkey") % 500).cast("double"))
    )
    y = (
        F.when(no_box, null).when(gap, null).when(_every(k, 53), number("inf"))
        .when(_every(k, 47), number(20)).otherwise((F.col("l_suppkey") % 400).cast("double"))
    )
    width = (
        F.when(no_box, null).when(gap, null).when(_every(k, 71), null)
        .when(_every(k, 47), number(30)).otherwise(F.lit(50.0) + F.col("l_quantity"))
    )
    height = (
        F.when(no_box, null).when(gap, null).when(_every(k, 67), number(0))
        .when(_every(k, 47), number(40)).otherwise(F.lit(60.0) + F.col("l_quantity"))
    )
    target = (
        F.when(_every(k, 97), null)
        .when(_every(k, 89), (F.col("l_partkey") % 2).cast("double"))
        .when(_every(k, 83), number(2)).when(_every(k, 4), number(1)).otherwise(number(0))
    )
    return read(spark, sf_dir, "lineitem").select(
        F.col(k).cast("string").alias("patientId"),
        x.alias("x"), y.alias("y"), width.alias("width"), height.alias("height"),
        target.alias("Target"), _row_seq(),
    )


def classes(spark, sf_dir):
    """patientId, class: with exact duplicates, conflicts, an unsupported class and gaps."""
    k = "o_orderkey"
    orders = read(spark, sf_dir, "orders").select(k).where(~_every(k, 43))
    name = (
        F.when(_every(k, 37), "Unsupported").when(_every(k, 4), "Lung Opacity")
        .when(F.col(k) % 4 == 1, "Normal").otherwise("No Lung Opacity / Not Normal")
    )
    other = F.when(_every(k, 4), "Normal").otherwise("Lung Opacity")
    key = F.col(k).cast("string").alias("patientId")
    copies = F.explode(
        F.array_compact(
            F.array(name, F.when(_every(k, 5), name), F.when(_every(k, 41), other))
        )
    ).alias("class")
    return orders.select(key, copies)


def headers(spark, sf_dir):
    """sample_id, readable, ndim, width, height: the result of an image audit."""
    k = "o_orderkey"
    return read(spark, sf_dir, "orders").where(~_every(k, 31)).select(
        F.col(k).cast("string").alias("sample_id"),
        (~_every(k, 29)).alias("readable"),
        F.when(_every(k, 23), 3).otherwise(2).alias("ndim"),
        F.lit(1024).alias("width"), F.lit(1024).alias("height"),
    )


def direct_images(spark, sf_dir):
    """Image records that never went through mapping; some orders come twice."""
    k = "o_orderkey"
    copies = F.explode(
        F.when(_every(k, 19), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    )
    key = F.col(k).cast("string")
    return read(spark, sf_dir, "orders").select(k, copies.alias("copy")).select(
        key.alias("sample_id"),
        F.concat(F.lit("/data/"), key, F.lit(".dcm")).alias("image_path"),
        F.when(_every(k, 13), 0).otherwise(1).alias("label"),
        F.lit("direct").alias("source_dataset"),
        F.lit("Lung Opacity").alias("raw_class"),
    )


def direct_boxes(spark, sf_dir):
    """Boxes that never went through mapping, with faults of every kind."""
    k = "l_orderkey"
    key = F.col(k).cast("string")
    odd_line = F.col("l_linenumber") % 2 == 1

    def number(value):
        return F.lit(float(value))

    x = (
        F.when(_every(k, 59) & odd_line, number(-1)).when(_every(k, 47), number(10))
        .otherwise((F.col("l_partkey") % 500).cast("double"))
    )
    y = (
        F.when(_every(k, 53), number("inf")).when(_every(k, 47), number(20))
        .otherwise((F.col("l_suppkey") % 400).cast("double"))
    )
    width = (
        F.when(_every(k, 59) & ~odd_line, number(0)).when(_every(k, 61), number(2000))
        .when(_every(k, 47), number(30)).otherwise(F.lit(50.0) + F.col("l_quantity"))
    )
    height = (
        F.when(_every(k, 61) & odd_line, number(0)).when(_every(k, 47), number(40))
        .otherwise(F.lit(60.0) + F.col("l_quantity"))
    )
    return read(spark, sf_dir, "lineitem").select(
        F.when(_every(k, 17), F.concat(F.lit("u"), key)).otherwise(key).alias("sample_id"),
        x.alias("x"), y.alias("y"), width.alias("width"), height.alias("height"), _row_seq(),
    )


def split_input(spark, sf_dir):
    return read(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("sample_id"), F.col("quality").alias("label")
    )


def predictions(spark, sf_dir):
    """sample_id, label, logit, score"""
    rated = read(spark, sf_dir, "labels").select("doc_id", "quality")
    sizes = read(spark, sf_dir, "documents").select("doc_id", "n_chars")
    logit = (F.lit(2000) - F.col("n_chars")) / F.lit(1000.0).cast("double")
    return rated.join(sizes, "doc_id").select(
        F.col("doc_id").cast("string").alias("sample_id"),
        F.col("quality").cast("bigint").alias("label"),
        logit.cast("double").alias("logit"),
    )


def history(spark, sf_dir):
    """run, epoch, val_loss, val_acc: an event type is a run, its events are epochs."""
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"), F.col("event_id").alias("epoch"),
        F.col("value").alias("val_loss"),
        (F.lit(1.0) / (F.lit(1.0) + F.abs("value"))).alias("val_acc"),
    )


def pixels(spark, sf_dir):
    """8 x 8 images out of embeddings: each component as a 16-bit code."""
    code = F.transform(
        "embedding",
        lambda v: F.least(
            F.greatest(F.floor((v.cast("double") + 1.0) * 32767.0), F.lit(0)), F.lit(65535)
        ).cast("int"),
    )
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("sample_id"),
        F.lit(8).alias("rows"), F.lit(8).alias("cols"), F.lit(65535).alias("code_max"),
        F.when(_every("vec_id", 3), "MONOCHROME1").otherwise("MONOCHROME2").alias("photometric"),
        code.alias("pixels"), "label",
    )


def paths(spark, sf_dir):
    """page_id, image_path: page addresses as file paths, some below the old mount."""
    folder = F.replace("url", F.lit("http://"), F.lit("/mnt/c/"))
    file = F.concat(F.lit("/mnt/c/"), F.col("page_id").cast("string"), F.lit(".dcm"))
    return read(spark, sf_dir, "pages").select(
        "page_id", F.concat(folder, file).alias("image_path")
    )


def grid_files(spark, sf_dir, folder):
    """Write every 8 x 8 image as a file below ``folder``; returns its records: sample_id, image_path, label.

    A file is a line of text (photometric type and dimensions) and the codes as 16-bit
    numbers. Some files are broken, empty or absent, some have three dimensions, and some
    are folders.
    """
    k = F.col("sample_id").cast("bigint")
    path = F.concat(F.lit(f"{folder}/p"), (k % 8).cast("string"), F.lit("/"), F.col("sample_id"), F.lit(".grid"))
    shape = F.when(k % 23 == 0, " 2 4 8").otherwise(" 8 8")
    codes = F.transform("pixels", lambda v: F.concat(F.lpad(F.hex(v % 256), 2, "0"), F.lpad(F.hex(F.floor(v / 256)), 2, "0")))
    whole = F.concat(
        F.encode(F.concat("photometric", shape, F.lit("\n")), "UTF-8"), F.unhex(F.array_join(codes, ""))
    )
    content = (
        F.when(k % 31 == 0, F.encode(F.lit(""), "UTF-8")).when(k % 29 == 0, F.encode(F.lit("no image"), "UTF-8"))
        .otherwise(whole)
    )
    records = pixels(spark, sf_dir).select("sample_id", path.alias("image_path"), F.lit(1).alias("label"), content.alias("content"))
    place = F.when(k % 41 == 0, F.concat("image_path", F.lit("/inside"))).otherwise(F.col("image_path"))
    sources.write_files(records.where(k % 37 != 0).withColumn("path", place)).agg(F.sum("length")).collect()
    return records.drop("content")


def decode_grid(content):
    """Codes and photometric type of a file that :func:`grid_files` wrote."""
    import numpy as np

    line, codes = content.split(b"\n", 1)
    photometric, *shape = line.decode().split(" ")
    return np.frombuffer(codes, "<u2").reshape([int(n) for n in shape]), photometric
