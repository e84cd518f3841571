"""Merkle manifest of a table: a tree per group of rows, a tree of the groups' roots, proofs and their check.

A leaf is the SHA-256 of a row's fields, each `-` if null, else its UTF-8 byte count, `:` and the value.
All digests are lower-case hex text.  A group's leaves ascend by ID; while several nodes are left, every ``arity``
consecutive ones (the last run may have fewer, even one) become the digest of their concatenation.  What is left is
the group's subroot; the subroots, by group (null first, then bytewise), make the root in the same way.

Method.  The leaves of a group are numbered by ranges of their order and dealt into aligned blocks of at most 256.
A block keeps each of its levels as one string of digests side by side, so a parent is the digest of a substring of
fixed width, and a node's siblings are the substrings on either side of it.  A block gives one node; the nodes of
a group's blocks are the leaves of the next tier, and so on: three tiers hold 16 million leaves, and
one row per 256 of them moves up.  On the way down a block's path is handed to its members, so a row's proof
is its own siblings followed by those above.  No task sees more than one block of a group at a time.

Null fields are `-` in a leaf; a null ID comes first in its group, a null group is a group of its own.  Rows of equal
ID are ordered by leaf; equal rows have equal leaves, so which comes first changes nothing but whose
proof is whose.  Empty and very long texts are hashed like any other.  An empty table gives no rows.  Columns that are
not named are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexigrid.session import written

ARITY = 2
BLOCK = 256  # leaves of a block, at most
HEX = 64  # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left: string, right: string>>"


def leaf_of(*fields: Column) -> Column:
    """The leaf of a row with these fields."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def proof_of(path: Column) -> Column:
    """The digest of all siblings of a path, from the leaf's to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def manifest(docs: DataFrame, id: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS,
             carried: dict[str, Column] | None = None, arity: int = ARITY) -> DataFrame:
    """``id, group, leaf, subroot, root, path`` of every row, and what ``carried`` names.

    ``path`` has the siblings ``left`` and ``right`` of the row's node on every level up to the root.
    """
    carried = carried or {}
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))  # "-" sorts before "="
    leaves = docs.select(
        tree.alias("tree"), F.col(id).alias("id"), F.unhex(leaf_of(*[F.col(f) for f in fields])).alias("node"),
        *[c.alias(f"_{name}") for name, c in carried.items()],
    )
    kept = ["id", *[f"_{name}" for name in carried]]
    tiers = _tiers(_numbered(written(leaves, "merkle-leaves"), ["id", "node"]), kept, arity)
    subroots = written(tiers[-1].select("tree", F.element_at("levels", -1).alias("subroot")), "merkle-subroots")
    above = _tiers(_numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.unhex("subroot").alias("node")), ["group"]), ["group"], arity)
    root = above[-1].select(F.element_at("levels", -1)).first()  # one row, or none
    of_group = _paths(above, None, arity).select(F.col("kept.group").alias("tree"), "path")
    of_group = of_group.join(subroots, "tree").withColumn("root", F.lit(root and root[0]).cast("string"))
    rows = _paths(tiers, written(of_group, "merkle-groups"), arity)
    return rows.select(
        "kept.id", F.when(F.col("tree") != "-", F.substr("tree", F.lit(2))).alias("group"),
        F.lower(F.hex("node")).alias("leaf"), "subroot", "root", "path",
        *[F.col(f"kept._{name}").alias(name) for name in carried],
    )


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """With ``pos``, the place in the tree from 0, and ``n``, the tree's nodes; no tree in one task."""
    # what ties are broken by makes ranges of equal rows no larger than others
    dealt = nodes.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "_tie")
    dealt = dealt.sortWithinPartitions("tree", *order, "_tie").select(
        *nodes.columns, F.monotonically_increasing_id().alias("_nth"), F.spark_partition_id().alias("_part")
    )
    dealt = written(dealt, "merkle-ordered")
    parts = dealt.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_nth").alias("_first"))
    tree = Window.partitionBy("tree")
    before = F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("tree", "_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(tree).alias("n"))
    return dealt.join(parts, ["tree", "_part"]).select(
        *nodes.columns, (F.col("_nth") - F.col("_first") + F.col("_before")).alias("pos"), "n"
    )


def _levels_of_block(arity: int) -> int:
    depth = 1
    while arity ** (depth + 1) <= BLOCK:
        depth += 1
    return depth


def _tiers(nodes: DataFrame, kept: list[str], arity: int) -> list[DataFrame]:
    """The blocks of each tier, ``tree, block, n, members, levels``, from leaves ``tree, pos, n, node, *kept``."""
    depth = _levels_of_block(arity)
    span = arity**depth

    def up(level: Column) -> Column:
        runs = F.ceil(F.length(level) / (HEX * arity)).cast("int")
        parent = lambda i: F.sha2(F.substr(level, i * HEX * arity + 1, F.lit(HEX * arity)), 256)
        return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), parent), "")

    def blocks(rows: DataFrame, kept: list[str]) -> DataFrame:
        members = F.sort_array(F.collect_list(F.struct("pos", "node", F.struct(*kept).alias("kept"))))
        made = rows.groupBy("tree", F.floor(F.col("pos") / span).alias("block")).agg(F.first("n").alias("n"), members.alias("members"))
        first = F.array_join(F.transform("members", lambda m: F.lower(F.hex(m["node"]))), "")
        # a tree with several nodes left goes on, whatever is left in its last block
        steps = sum((F.col("n") > arity**d).cast("int") for d in range(depth))
        raised = F.aggregate(
            F.slice(F.array(*map(F.lit, range(depth))), F.lit(1), steps), F.array(first),
            lambda levels, _: F.concat(levels, F.array(up(F.element_at(levels, -1)))),
        )
        return written(made.withColumn("levels", raised), "merkle-blocks")

    tiers = [blocks(nodes, kept)]
    left = tiers[0].agg(F.max("n")).first()[0] or 0
    while left > span:
        left = -(-left // span)
        rows = tiers[-1].select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / span).alias("n"), F.unhex(F.element_at("levels", -1)).alias("node")
        )
        tiers.append(blocks(rows.withColumn("none", F.lit(None).cast("int")), ["none"]))
    return tiers


def _paths(tiers: list[DataFrame], above: DataFrame | None, arity: int) -> DataFrame:
    """The leaves ``tree, node, kept`` with their ``path``; ``above`` has that of each tree's root and columns to add."""
    depth = _levels_of_block(arity)

    def siblings(place: Column, levels: Column) -> Column:
        def on(d: int) -> Column:
            i = F.floor(place / arity**d).cast("int")
            run = F.floor(i / arity).cast("int") * arity
            left = F.substr(F.get(levels, F.lit(d)), run * HEX + 1, (i - run) * HEX)
            right = F.substr(F.get(levels, F.lit(d)), (i + 1) * HEX + 1, (run + arity - 1 - i) * HEX)
            return F.struct(left.alias("left"), right.alias("right"))

        return F.slice(F.array(*map(on, range(depth))), F.lit(1), F.size(levels) - 1)

    extra: list[str] = []
    if above is not None:
        extra = [c for c in above.columns if c not in ("tree", "path")]
        above = above.withColumn("block", F.lit(0).cast("bigint"))
    for blocks in reversed(tiers):
        if above is None:
            joined = blocks.withColumn("path", F.array().cast(_PATH))
        else:
            joined = blocks.join(above, ["tree", "block"])
        # place in the block by number, so that levels beyond the last are not read
        member = joined.select("tree", "path", *extra, "levels", F.posexplode("members").alias("place", "m"))
        own = siblings(F.col("place"), F.col("levels"))
        rows = member.select("tree", F.col("m.pos").alias("block"), F.col("m.node").alias("node"), F.col("m.kept").alias("kept"),
                             F.concat(own, F.col("path")).alias("path"), *extra)
        above = rows.drop("node", "kept")
    return rows
