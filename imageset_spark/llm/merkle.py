"""Merkle manifest of a table, stored only every few levels.

A row's leaf is the SHA-256 of its columns, each written with its length. Leaves of
a group, in the order of their ids, are hashed in runs of ``FANOUT``, and the results
again, until one is left; the groups' results, in the order of the groups, are hashed
in the same way up to one root.

Checkpoint and recompute: only every ``EVERY``-th level is written, as one row
for each aligned subtree (``FANOUT ** EVERY`` stored nodes of that level, 64 here), and
so the levels above the leaves take 1/64 of their room. Proofs go from the root
down: each subtree meets the proof of its own top, works out its missing interior nodes
from the stored ones, gives each stored node the siblings on its way up, and
forgets the interior again. No task holds more than one subtree, and a proof is
joined once for 64 leaves.

Leaves get their places by range partitioning (``ordering.py``), so a group of any
size is spread over all tasks.

Defined results: a null value is written as ``-``; a null group comes first; rows
without id come first in their group; rows of one id follow their leaves, equal rows are
interchangeable; texts are hashed whole; an empty table has no root and no proofs; other
columns of the table are left out.
"""

from typing import NamedTuple

from pyspark.sql import functions as F

from imageset_spark.functions import stage

from .ordering import in_order
from .rows import group_key

FANOUT = 8
#: Levels from one stored level to the next.
EVERY = 2


class Manifest(NamedTuple):
    """Stored subtrees by level, lowest first: ``group_levels`` of the rows, ``top_levels`` of the groups."""

    group_levels: list
    top_levels: list
    fanout: int
    every: int


def leaf_digest(columns):
    """Digest of the columns (names or expressions): ``-`` for null, else byte count, colon and value."""

    def field(column):
        text = (F.col(column) if isinstance(column, str) else column).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def _joined(digests):
    return F.array_join(digests, "")


def _parents(nodes, fanout):
    """Digests of the runs of an array of digests."""
    last = ((F.size(nodes) - 1) / fanout).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda run: F.sha2(_joined(F.slice(nodes, run * fanout + 1, fanout)), 256)
    )


def _subtrees(nodes, fanout, every):
    """One row for each aligned subtree: ``grp``, ``block`` and its ``members`` in order."""
    width = fanout**every
    member = F.struct("place", *[c for c in nodes.columns if c not in ("grp", "place")])
    found = nodes.groupBy("grp", F.expr(f"place div {width}").alias("block")).agg(
        F.sort_array(F.collect_list(member)).alias("members")
    )
    return stage(found, "subtrees")


def _interior(subtrees, fanout, every):
    """Add ``level_0`` to ``level_<every>``, and ``alone``: the subtree is all there is of its group.

    A tree ends at one node, so a level of a lone subtree that has one node is its last.
    """
    out = subtrees.withColumns({
        "alone": (F.col("block") == 0) & (F.size("members") < fanout**every),
        "level_0": F.col("members.digest"),
    })
    for k in range(every):
        nodes = F.col(f"level_{k}")
        out = out.withColumn(
            f"level_{k + 1}", F.when(F.col("alone") & (F.size(nodes) == 1), nodes).otherwise(_parents(nodes, fanout))
        )
    return out


def _levels(nodes, fanout, every):
    """Stored subtrees of all levels of trees given by (``grp``, ``place``, ``digest``, ...), and the trees' tops."""
    levels = []
    while True:
        levels.append(_subtrees(nodes, fanout, every))
        tops = _interior(levels[-1], fanout, every).select(
            "grp", F.col("block").alias("place"), F.element_at(f"level_{every}", 1).alias("digest")
        )
        if levels[-1].where("block > 0").isEmpty():
            return levels, tops
        nodes = tops


def build_manifest(docs, columns=("doc_id", "source", "lang", "n_chars", "text"), group_col="lang", id_col="doc_id",
                   fanout=FANOUT, every=EVERY, **more):
    """Hash the rows and store the trees. ``more`` are expressions kept beside each leaf under their names."""
    rows = docs.select(
        group_key(group_col).alias("grp"), leaf_digest(columns).alias("digest"), F.col(id_col).alias("id"),
        *[value.alias(name) for name, value in more.items()],
    )
    leaves = in_order(stage(rows, "leaves"), [F.col("id").asc_nulls_first(), F.col("digest")], "grp")
    group_levels, tops = _levels(leaves, fanout, every)
    tops = stage(tops.select(F.col("grp").alias("of"), "digest"), "group-roots")
    top_nodes = in_order(tops, [F.col("of")]).withColumn("grp", F.lit(""))
    top_levels, _ = _levels(top_nodes, fanout, every)
    return Manifest(group_levels, top_levels, fanout, every)


def root(manifest):
    """One row with the ``root``; none for an empty table."""
    top = _interior(manifest.top_levels[-1], manifest.fanout, manifest.every)
    return top.select(F.element_at(f"level_{manifest.every}", 1).alias("root"))


def _no_siblings():
    return F.array().cast("array<struct<left:string,right:string>>")


def _siblings(k, fanout):
    """The others of the run that holds the node above member ``i``, ``k`` levels up."""
    at = F.expr(f"int(i div {fanout**k})")
    within = at % fanout
    nodes = F.col(f"level_{k}")
    return F.struct(
        _joined(F.slice(nodes, at - within + 1, within)).alias("left"),
        _joined(F.slice(nodes, at + 2, fanout - 1 - within)).alias("right"),
    )


def _descend(levels, above, fanout, every):
    """Members of the lowest subtrees with the siblings on their whole way up, from those of the trees' tops.

    Without ``above`` the one top is the root.
    """
    carried = [c for c in above.columns if c not in ("grp", "block", "siblings")] if above is not None else ["root"]
    for subtrees in reversed(levels):
        nodes = [f"level_{k}" for k in range(every)]
        met = _interior(subtrees, fanout, every)
        if above is None:
            met = met.withColumns({"root": F.element_at(f"level_{every}", 1), "siblings": _no_siblings()})
        else:
            met = met.join(above, ["grp", "block"])
        rows = met.select(
            "grp", "siblings", *carried, "alone", *nodes, F.posexplode("members").alias("i", "member")
        )
        own = [
            F.when(F.col("alone") & (F.size(f"level_{k}") == 1), _no_siblings()).otherwise(F.array(_siblings(k, fanout)))
            for k in range(every)
        ]
        found = rows.select(
            "grp", F.col("member.place").alias("block"), "member", F.concat(*own, F.col("siblings")).alias("siblings"),
            *carried,
        )
        above = found.drop("member")
    return found


def proofs(manifest):
    """One row for each row of the table: ``id``, ``leaf``, what was kept beside it, ``subroot``, ``root`` and
    ``siblings``: for each level up to the root, the digests ``left`` and ``right`` of it in its run.
    """
    groups = _descend(manifest.top_levels, None, manifest.fanout, manifest.every).select(
        F.col("member.of").alias("grp"), F.lit(0).cast("bigint").alias("block"), "siblings", "root",
        F.col("member.digest").alias("subroot"),
    )
    leaves = _descend(manifest.group_levels, groups, manifest.fanout, manifest.every)
    kept = [f.name for f in leaves.schema["member"].dataType.fields if f.name not in ("place", "digest")]
    return leaves.select(
        *[F.col(f"member.{c}").alias(c) for c in kept], F.col("member.digest").alias("leaf"), "subroot", "root", "siblings"
    )


def fold(leaf, siblings):
    """Root that a leaf and its siblings lead to."""
    return F.aggregate(
        siblings, leaf, lambda digest, run: F.sha2(F.concat(run["left"], digest, run["right"]), 256)
    )


def proof_digest(siblings):
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(_joined(F.transform(siblings, lambda run: F.concat(run["left"], run["right"]))), 256)
