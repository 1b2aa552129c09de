"""Merkle manifest of a dataset: digests of documents, of groups of them and of all, with a proof for every document.

The leaves of a group (here: a language) are numbered in the order of their ids by places that are counted per range of the
order, so that no task holds a group. A step groups nodes by their number divided by BLOCK and sorts the children; runs of
``fanout`` of them are hashed into parents, and these again, as many levels as the block has, so that a step takes one
shuffle for several levels. Steps go on until each group has one node; groups that are done wait. The groups' nodes, in the
order of the groups, are the leaves of one more tree of the same kind. Then the steps go down again: a join hands each
block's path to its children, who put their own siblings before it. A step has a BLOCK-th of the nodes of the one before,
so that all together cost two shuffles of the leaves, with 32 bytes a digest.

H is the lower-case hex SHA-256 of its inputs one after the other, digests as hex text. A path is an array of (before,
after), the siblings on either side within a run, from the leaf up.

Defined results: nulls are hashed as ``-`` and all else as its length in bytes, ``:`` and the value, so that null, empty and
the text ``-`` differ; a null group is a group, the first one; rows without an id come first in their group; rows
with the same id are leaves each, in the order of their digests; an empty table gives no rows; columns other than the
fields are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.llm import store
from innkeep.operators.positions import with_places


#: Nodes of a step's block, at most.
BLOCK = 256
#: Groups whose sizes and roots (a row each) are broadcast; more of them are joined.
MAX_GROUPS = 100_000


def hashed(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def hex_text(c: Column) -> Column:
    """Binary digests (one or several, joined) as hex text."""
    return F.lower(F.hex(c))


def field(c: Column) -> Column:
    """A value as it goes into a leaf."""
    text = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*fields: Column) -> Column:
    """The digest of a row's fields, in hex."""
    return hashed(F.concat(*[field(c) for c in fields]))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest (hex) gives with a path."""
    return F.aggregate(path, start, lambda acc, s: hashed(F.concat(hex_text(s["before"]), acc, hex_text(s["after"]))))


def proof(path: Column) -> Column:
    """H of all siblings of a path, level by level, left to right."""
    return hashed(F.array_join(F.transform(path, lambda s: F.concat(hex_text(s["before"]), hex_text(s["after"]))), ""))


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda s, x: F.concat(s, x))


def _parents(nodes: Column, fanout: int) -> Column:
    """The digests above an array of them."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int"))
    return F.transform(runs, lambda i: F.unhex(hashed(hex_text(_joined(F.slice(nodes, i * fanout + 1, F.lit(fanout)))))))


def _tree(nodes: DataFrame, fanout: int, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """(key, height, digest) of each group's last node, and the written steps: blocks (key, at) with the levels inside them.

    nodes: key, at (place in the group), n (nodes of the group), digest (binary). height: the steps of the group.
    """
    deep = max(1, int(math.log(BLOCK, fanout) + 1e-9))
    most = nodes.agg(F.max("n")).first()[0] or 0
    tops, steps = nodes.where("n = 1").withColumn("height", F.lit(0)), []
    while most > 1:
        # a group of few nodes is done within the step; in all others, every block goes up by as many levels
        up = F.lit(deep)
        for k in reversed(range(1, deep)):
            up = F.when(F.col("n") <= fanout**k, k).otherwise(up)
        blocks = nodes.where("n > 1").withColumn("block", F.floor(F.col("at") / fanout**deep)).groupBy("key", F.col("block").alias("at")).agg(F.first("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"]).alias("kids"))
        inside = F.aggregate(F.sequence(F.lit(1), up), F.array("kids"), lambda s, _: F.concat(s, F.array(_parents(F.element_at(s, -1), fanout))))
        steps.append(store.cut(blocks.select("key", "at", F.ceil(F.col("n") / fanout**deep).alias("n"), inside.alias("levels")), f"{name}-step"))
        nodes = steps[-1].select("key", "at", "n", F.element_at(F.element_at("levels", -1), 1).alias("digest"))
        tops = tops.unionByName(nodes.where("n = 1").withColumn("height", F.lit(len(steps))))
        most = math.ceil(most / fanout**deep)
    return store.cut(tops.select("key", "height", "digest"), f"{name}-tops"), steps


_PATH = "array<struct<before:binary,after:binary>>"


def _paths(tops: DataFrame, steps: list[DataFrame], fanout: int, name: str) -> DataFrame:
    """key, at and path of the first nodes. tops: key, height and path of each group's last node."""
    top = lambda h: tops.where(F.col("height") == h).select("key", F.lit(0).cast("long").alias("at"), "path")
    deep = max(1, int(math.log(BLOCK, fanout) + 1e-9))
    paths = top(len(steps))
    for k in reversed(range(len(steps))):
        each = steps[k].join(paths, ["key", "at"]).select("key", "at", "levels", "path", F.posexplode(F.element_at("levels", 1)).alias("i", "kid"))

        def siblings(level: Column) -> Column:
            nodes, own = F.element_at("levels", level + 1), F.floor(F.col("i") / F.pow(F.lit(fanout), level)).cast("int")
            first = F.floor(own / fanout).cast("int") * fanout
            return F.struct(_joined(F.slice(nodes, first + 1, own - first)).alias("before"), _joined(F.slice(nodes, own + 2, first + fanout - own - 1)).alias("after"))

        inside = F.transform(F.sequence(F.lit(0), F.size("levels") - 2), siblings)
        down = each.select("key", (F.col("at") * fanout**deep + F.col("i")).alias("at"), F.concat(inside, "path").cast(_PATH).alias("path"))
        paths = down.unionByName(top(k))
        if k:
            paths = store.cut(paths, f"{name}-paths")
    return paths


def manifest(docs: DataFrame, id_col: str, group_col: str, fields: list[Column], tampered: list[Column] | None = None, fanout: int = 2) -> DataFrame:
    """id, key (the group, ``0`` if null, else ``1`` and its name), leaf, tampered (leaf of the other fields), subroot, root, path.

    ``fields`` go into the leaves; ``tampered`` (as many) into leaves that are only carried along, to be verified. ``fanout``
    is at least two. Tables are written in the caller's scratch.
    """
    if fanout < 2:
        raise ValueError("a run needs at least two nodes")
    key = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    leaves = docs.select(F.col(id_col).alias("id"), key.alias("key"), leaf(*fields).alias("leaf"), leaf(*(tampered or fields)).alias("tampered"))
    leaves = with_places(store.cut(leaves, "leaves"), [F.col("id").asc_nulls_first(), F.col("leaf").asc()], ["key"], "at")
    leaves = store.cut(leaves, "numbered")
    sizes = store.cut(leaves.groupBy("key").agg(F.max("at").alias("last")).withColumn("n", F.col("last") + 1), "sizes")
    # groups may hold a third of all rows each, but their sizes are a row per group
    sized = leaves.join(F.broadcast(sizes) if sizes.count() <= MAX_GROUPS else sizes, "key")
    subroots, levels = _tree(sized.select("key", "at", "n", F.unhex("leaf").alias("digest")), fanout, "group")
    ordered = with_places(subroots, [F.col("key").asc()], None, "at")
    upper = store.cut(ordered.select("key", "digest", "height", F.lit("").alias("all"), "at"), "subroots")
    nodes = upper.select(F.col("all").alias("key"), "at", F.lit(upper.count()).cast("long").alias("n"), "digest")
    root, over = _tree(nodes, fanout, "root")
    whole = _paths(root.select("key", "height", F.array().cast(_PATH).alias("path")), over, fanout, "root").select("at", "path")
    tops = upper.join(whole, "at").crossJoin(F.broadcast(root.select(hex_text(F.col("digest")).alias("root"))))  # the root is one row
    tops = store.cut(tops.select("key", "height", "path", hex_text(F.col("digest")).alias("subroot"), "root"), "group-tops")
    paths = _paths(tops, levels, fanout, "group")
    named = tops.select("key", "subroot", "root")
    return leaves.join(paths, ["key", "at"]).join(F.broadcast(named) if sizes.count() <= MAX_GROUPS else named, "key").select("id", "key", "leaf", "tampered", "subroot", "root", "path")
