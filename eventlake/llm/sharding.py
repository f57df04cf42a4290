"""Shards of near equal bytes by a k-d tree over text metadata.

The table of metadata is split again and again at a weighted median (or, for an odd number of shards,
the matching quantile) of its widest dimension, until every leaf is one shard and so holds the target
bytes. Medians are found for all nodes of a level at once: weights are added up per node and bin of
its dimension, the bin with the median is binned again, and only these few sums reach the driver.
Where one value of a dimension is heavier than the tolerance, rows with that value are cut by a hash
of the text, so that equal texts stay together; a group of equal texts is cut, by a hash of the number
that each row is written with, only where it alone would throw the shards out of balance by more than
`group_tolerance`. So rows that are equal in everything can be cut too.

Defined results: a null text has the size of its overhead alone and the checksum of the empty text;
null and repeated doc_ids are dealt like any others; an empty table gives no row; with fewer rows
than shards some shards stay empty. Only `doc_id` and `text` are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import written

OVERHEAD = 8
DIMENSIONS = ("log_size", "bytes_per_char", "spaces")
TOP = float(1 << 53)


@dataclass
class Cut:
    """Left of it: first key smaller, or equal and the next key smaller, ..., the last at most `value`."""

    prefix: list[tuple[str, float]]
    key: str
    value: float
    inclusive: bool = True

    def left(self) -> Column:
        test = F.col(self.key) <= self.value if self.inclusive else F.col(self.key) < self.value
        for key, value in reversed(self.prefix):
            test = (F.col(key) < value) | ((F.col(key) == value) & test)
        return test


@dataclass
class Node:
    first: int  # its first shard
    shards: int
    cut: Cut | None = None
    children: tuple[Node, Node] | None = None
    # the search for the cut
    keys: list[str] = field(default_factory=list)
    prefix: list[tuple[str, float]] = field(default_factory=list)
    low: float = 0.0
    high: float = 0.0
    before: float = 0.0
    target: float = 0.0

    def number(self) -> Column:
        """The first shard of the node of this tree that a row is in."""
        if not self.children:
            return F.lit(self.first)
        return F.when(self.cut.left(), self.children[0].number()).otherwise(self.children[1].number())

    def leaves(self) -> list[Node]:
        return [n for c in self.children for n in c.leaves()] if self.children else [self]


def metadata(documents: DataFrame) -> DataFrame:
    """doc_id, size, checksum, the dimensions of the tree, a number per row and two hashes that break ties."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text)
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    return documents.withColumn("row", F.monotonically_increasing_id()).select(
        "doc_id", "row", (size + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.log2(size + OVERHEAD).alias("log_size"),
        (size / F.greatest(F.length(text), F.lit(1))).alias("bytes_per_char"),
        (spaces / F.greatest(size, F.lit(1))).alias("spaces"),
        F.shiftrightunsigned(F.xxhash64(text), 11).cast("double").alias("text_hash"),
        F.shiftrightunsigned(F.xxhash64("row"), 11).cast("double").alias("row_hash"),
    )


def tree(rows: DataFrame, shards: int, tolerance: float = 0.001, group_tolerance: float = 0.01, bins: int = 2048) -> Node:
    """The k-d tree whose leaves are the shards. Tolerances are shares of a shard's target bytes."""
    root = Node(0, shards)
    extent = None
    while open_ := [n for n in root.leaves() if n.shards > 1]:
        placed = rows.withColumn("node", root.number())
        sums = placed.groupBy("node").agg(
            F.sum("size").alias("total"), *(f(d).alias(f"{f.__name__}_{d}") for d in DIMENSIONS for f in (F.min, F.max))
        ).collect()  # a row per node
        found = {r["node"]: r for r in sums}
        if extent is None:
            leaf = sum(r["total"] for r in sums) / shards
            extent = {d: max((r[f"max_{d}"] - r[f"min_{d}"] for r in sums), default=0) or 1 for d in DIMENSIONS}
        for node in open_:
            half = node.shards // 2
            row = found.get(node.first)
            if row is None:  # no row is left for this node
                node.cut = Cut([], DIMENSIONS[0], 0.0)
            else:
                widest = max(DIMENSIONS, key=lambda d: (row[f"max_{d}"] - row[f"min_{d}"]) / extent[d])
                node.keys = [widest, "text_hash", "row_hash"]
                node.low, node.high = row[f"min_{widest}"], row[f"max_{widest}"]
                node.target = row["total"] * half / node.shards
        while active := [n for n in open_ if n.cut is None]:
            _narrow(placed, active, leaf * tolerance, leaf * group_tolerance, bins)
        for node in open_:
            half = node.shards // 2
            node.children = (Node(node.first, half), Node(node.first + half, node.shards - half))
    return root


def _narrow(placed: DataFrame, active: list[Node], tolerance: float, group_tolerance: float, bins: int) -> None:
    """One pass: add up weights in bins, then set each node's cut or its next, narrower interval."""
    x, scope, place = F.lit(None).cast("double"), F.lit(False), F.lit(0)
    for n in active:
        here, key = F.col("node") == n.first, F.col(n.keys[0])
        inside = here & key.between(n.low, n.high)
        for name, value in n.prefix:
            inside = inside & (F.col(name) == value)
        x = F.when(here, key).otherwise(x)
        scope = scope | inside
        width = (n.high - n.low) or 1.0
        place = F.when(here, F.least(F.floor((key - n.low) / width * bins), F.lit(bins - 1)).cast("int")).otherwise(place)
    sums = (
        placed.where(scope).select("node", "size", x.alias("x"), place.alias("bin")).groupBy("node", "bin")
        .agg(F.sum("size").alias("w"), F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        .collect()  # at most `bins` rows per open node
    )
    for n in active:
        steps = sorted((r for r in sums if r["node"] == n.first), key=lambda r: r["bin"])
        weight, last = n.before, None
        for at, step in enumerate(steps):
            if weight + step["w"] >= n.target or at == len(steps) - 1:
                break
            weight, last = weight + step["w"], step
        under, over = n.target - weight, weight + step["w"] - n.target
        best = min(abs(under), abs(over))
        key = n.keys[0]
        tied = step["low"] == step["high"]
        # rows of one text are kept together while the shards stay near equal
        whole = tied and key == "text_hash" and best <= group_tolerance
        if best <= tolerance or step["n"] == 1 or whole or (tied and len(n.keys) == 1):
            if abs(over) <= abs(under):
                n.cut = Cut(n.prefix, key, step["high"])
            elif last is not None:
                n.cut = Cut(n.prefix, key, last["high"])
            else:
                n.cut = Cut(n.prefix, key, step["low"], inclusive=False)
            continue
        n.before = weight
        if tied:
            n.prefix, n.keys = [*n.prefix, (key, step["low"])], n.keys[1:]
            n.low, n.high = 0.0, TOP
        else:
            n.low, n.high = step["low"], step["high"]


def shard(documents: DataFrame, shards: int = 24, tolerance: float = 0.001, group_tolerance: float = 0.01, slot_rows: int = 4000) -> DataFrame:
    """doc_id, size, text_crc32, shard, and slot: the place in its shard, without gaps from 0.

    Slots are numbered in parts of about `slot_rows` rows, each of which starts where the parts
    before it in the shard end, so no task holds a shard.
    """
    rows = written(metadata(documents.select("doc_id", "text")), "metadata")
    total = rows.count()
    parts = max(1, -(-total // (shards * slot_rows)))
    placed = rows.select(
        "doc_id", "row", "size", "text_crc32", tree(rows, shards, tolerance, group_tolerance).number().cast("int").alias("shard"),
        F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part"),
    )
    counts = placed.groupBy("shard", "part").count()
    until = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("shard", "part", F.coalesce(F.sum("count").over(until), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size", "row")
    numbered = placed.withColumn("at", F.row_number().over(inside) - 1)
    return numbered.join(begins, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("begin") + F.col("at")).cast("long").alias("slot")
    )
