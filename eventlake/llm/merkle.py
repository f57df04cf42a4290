"""A manifest of a dataset as a Merkle tree, with a proof for every row.

Rows of a group (a source) are ranked by their key. The rank's digits, in base `FAN`, are grouped away one
after another: a group of the last digit becomes a node that nests its children as structs, then the next
digit is grouped away, up to a block of `BLOCK` rows. A block is one row of bounded size that holds its
whole subtree. Blocks are the leaves of the next tier, in which only their hashes stand, so every tier is
`BLOCK` times smaller than the one below. The groups' own nodes are rolled up in the same way.

Proofs are emitted by taking the nested structs apart: each explode of a node gives a child and the hashes
beside it, so no row meets another one for the part of its path inside its block. One small row per block
brings the path from there to the root.

Defined results: a null field counts as `-`; rows ascend by key, nulls first, equal keys by their leaf, and
equal leaves are interchangeable; a group of one row has that row's leaf as its node; with one group its
node is the root; an empty table gives no row. Null, empty and blank group names are groups of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import written

FAN = 16
DEPTH = 3  # levels of nodes in a block
BLOCK = FAN**DEPTH

PATH = "array<struct<left:string,right:string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one behind the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """The value's length in bytes and the value, `-` for null; no two different rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The hash of a document's fields; `changed` puts another column in the place of one."""
    return digest(*(field(changed.get(name, F.col(name))) for name in FIELDS))


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and the hashes beside its path."""
    return F.aggregate(path, start, lambda node, run: digest(run["left"], node, run["right"]))


def proof(path: Column) -> Column:
    """The hashes beside a path, level by level, left to right, in one text."""
    return F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), "")


@dataclass
class Settings:
    # Up to so many (partition, group) counts are broadcast to the rows they number; more are joined by a shuffle.
    broadcast_rows: int = 200_000


def ranked(rows: DataFrame, group: str, order: list[str], settings: Settings) -> DataFrame:
    """The rows with `rank`, their place in their group from 0, and `total`, the size of the group.

    Rows are range partitioned and sorted, so a group of any size lies in many partitions. A rank is the
    place in the partition plus what stands in the partitions before it: one count per partition and group.
    Rows that are equal in all of `order` are dealt by their place in the input.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)] + [F.col("dealt")]
    placed = written(
        rows.withColumn("dealt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .drop("dealt").withColumn("at", F.monotonically_increasing_id()),
        "ranked",
    )
    placed = placed.withColumn("part", F.shiftright("at", 33))
    sums = placed.groupBy("part", group).agg(F.count("*").alias("many"), F.min("at").alias("first"))
    in_group = Window.partitionBy(group)
    until = in_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(
        sums.select(
            F.col("part").alias("of_part"), F.col(group).alias("of_group"), "first",
            F.coalesce(F.sum("many").over(until), F.lit(0)).alias("before"), F.sum("many").over(in_group).alias("total"),
        ),
        "offsets",
    )
    if offsets.count() <= settings.broadcast_rows:
        offsets = F.broadcast(offsets)
    here = (F.col("part") == F.col("of_part")) & F.col(group).eqNullSafe(F.col("of_group"))
    return placed.join(offsets, here).withColumn("rank", F.col("at") - F.col("first") + F.col("before")).drop(
        "at", "part", "of_part", "of_group", "first", "before"
    )


def nodes_at(level: int) -> Column:
    """How many nodes a group of `total` leaves has on a level."""
    return F.ceil(F.col("total") / F.lit(FAN**level)).cast("long")


def blocks(leaves: DataFrame) -> DataFrame:
    """group, total, block, hash, kids: subtrees of up to `BLOCK` leaves (group, total, rank, hash, load).

    One shuffle by block; the digits are grouped away inside its partitions.
    """
    level = leaves.select(
        "group", "total", F.shiftright("rank", 4 * DEPTH).alias("block"), "hash", F.col("load").alias("kids"),
        *(F.shiftright("rank", 4 * k).bitwiseAND(FAN - 1).alias(f"digit_{k}") for k in range(DEPTH)),
    ).repartition("group", "block")
    for k in range(DEPTH):
        higher = [f"digit_{j}" for j in range(k + 1, DEPTH)]
        kids = F.sort_array(F.collect_list(F.struct(F.col(f"digit_{k}").alias("at"), "hash", "kids")))
        level = level.groupBy("group", "total", "block", *higher).agg(kids.alias("kids"))
        # where one node is left, it is the group's own
        whole = F.when(nodes_at(k) > 1, digest(F.array_join("kids.hash", ""))).otherwise(F.col("kids")[0]["hash"])
        level = level.withColumn("hash", whole)
    return level


def climb(leaves: DataFrame) -> list[DataFrame]:
    """The tiers of blocks, lowest first. The last holds no group of more than one block."""
    tiers = []
    while True:
        tiers.append(written(blocks(leaves), "blocks"))
        many = tiers[-1].where(F.col("total") > BLOCK)
        if many.isEmpty():
            return tiers
        leaves = many.select(
            "group", nodes_at(DEPTH).alias("total"), F.col("block").alias("rank"), "hash", F.lit(None).cast("string").alias("load")
        )


def group_nodes(tiers: list[DataFrame]) -> DataFrame:
    """group and hash, the node of every group: each is whole in one block of one tier."""
    found = [t.where(F.col("total") <= BLOCK).select("group", "hash") for t in tiers]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def descend(tiers: list[DataFrame], tops: DataFrame | str) -> DataFrame:
    """group, rank, hash, load, path, node of every leaf; `tops` has the path (group, node, path) above each group.

    A text for `tops` is the node of the only group there is, with nothing above it.
    """
    above = None
    for tier in reversed(tiers):
        starts = tier.where(F.col("total") <= BLOCK).select("group", "block")
        if isinstance(tops, DataFrame):
            starts = starts.join(tops, "group")
        else:
            starts = starts.select("*", F.lit(tops).alias("node"), F.array().cast(PATH).alias("path"))
        above = starts if above is None else starts.unionByName(above.select("group", F.col("rank").alias("block"), "node", "path"))
        above = _taken_apart(tier.join(above, ["group", "block"]))
    return above


def _taken_apart(found: DataFrame) -> DataFrame:
    """Leaves of blocks with their paths, by an explode per level."""
    kept = ["group", "total", "node", "path"]
    found = found.select(*kept, F.col("block").alias("rank"), "kids")
    for k in reversed(range(DEPTH)):
        found = found.withColumn("hashes", F.col("kids.hash")).select(*kept, "rank", "hashes", F.posexplode("kids").alias("place", "kid"))
        left = F.array_join(F.slice("hashes", F.lit(1), F.col("place")), "")
        right = F.array_join(F.slice("hashes", F.col("place") + 2, F.lit(FAN)), "")
        run = F.array(F.struct(left.alias("left"), right.alias("right")))
        found = found.select(
            "group", "total", "node", F.when(nodes_at(k) > 1, F.concat(run, F.col("path"))).otherwise(F.col("path")).alias("path"),
            (F.col("rank") * FAN + F.col("kid")["at"]).alias("rank"), F.col("kid")["hash"].alias("hash"), F.col("kid")["kids"].alias("kids"),
        )
    return found.select("group", "rank", "hash", F.col("kids").alias("load"), "path", "node")


def manifest(documents: DataFrame, also: dict[str, Column] | None = None, settings: Settings = Settings()) -> DataFrame:
    """doc_id, source, rank, leaf, subroot, root and path, with a column for each of `also`.

    `path` holds, level by level from the leaf up, the hashes left and right of the node: `fold(leaf, path)` is
    the root, and `proof(path)` the bare list. `also` names columns made from the documents' own, such as the
    leaf of a changed copy, to be judged against the same path.
    """
    also = also or {}
    hashed = written(
        documents.select("doc_id", "source", leaf().alias("leaf"), F.struct("doc_id", *(c.alias(f"also_{k}") for k, c in also.items())).alias("load")),
        "leaves",
    )
    leaves = ranked(hashed, "source", ["doc_id", "leaf"], settings)
    # a name for null that no text has
    named = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("source")))
    tiers = climb(leaves.select(named.alias("group"), "total", "rank", F.col("leaf").alias("hash"), "load"))
    sources = group_nodes(tiers).select("group", "hash", F.expr("if(group = '-', null, substring(group, 2))").alias("source"), F.lit("").alias("all"))
    ordered = ranked(sources, "all", ["source"], settings)
    above = climb(ordered.select(F.lit("").alias("group"), "total", "rank", "hash", F.struct("group").alias("load")))
    top = group_nodes(above).first()  # one row, none for an empty table
    root = top["hash"] if top else ""
    tops = written(
        descend(above, root).select(F.col("load")["group"].alias("group"), F.col("hash").alias("node"), "path"), "tops"
    )
    return descend(tiers, tops).select(
        F.col("load")["doc_id"].alias("doc_id"), F.expr("if(group = '-', null, substring(group, 2))").alias("source"), "rank",
        F.col("hash").alias("leaf"), F.col("node").alias("subroot"), F.lit(root).alias("root"), "path",
        *(F.col("load")[f"also_{k}"].alias(k) for k in also),
    )
