"""Connected components of a table of links, by repeated contraction.

Each round every node points to its smallest neighbour (or itself), two steps of
pointers are followed, and links are rewritten to where their ends point. The
image of a component stays connected and its smallest node never moves, so the
rounds end with each node at the smallest node of its component. Stars, the
usual case here, take two rounds. Every table is written, so joins on nodes with
very many links can be split by adaptive execution.
"""

from pyspark.sql import functions as F

from imageset_spark.functions import stage


def _moved(frame, column, pointers, name="_to"):
    """``frame`` with ``column`` replaced by where it points."""
    to = pointers.select(F.col("v").alias(column), F.col("p").alias(name))
    return frame.join(to, column, "left").withColumn(column, F.coalesce(name, column)).drop(name)


def components(links):
    """(``node``, ``component``) for all nodes of ``links`` (``a``, ``b``)."""
    links = stage(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    place = stage(nodes.withColumn("component", F.col("node")), "components")
    while not links.isEmpty():
        # Only a larger end can find a smaller neighbour.
        pointers = stage(links.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p")), "pointers")
        pointers = stage(_moved(pointers, "p", pointers), "pointers")
        place = stage(_moved(place, "component", pointers), "components")
        moved = _moved(_moved(links, "a", pointers), "b", pointers).where("a <> b")
        links = stage(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return place
