"""Near-duplicates by SimHash fingerprints and multi-index hashing.

Every text gets a 64-bit fingerprint of its word shingles. Fingerprints are cut into segments; two of
them within `radius` bits have a segment in which they differ in at most radius // segments bits.
So each distinct fingerprint is kept in one table per segment, and looks up every key of the Hamming
ball around its own segment. Matches are verified on all 64 bits. A flipped bit is looked up only by
the side that has a 0 there: the other side has the same key in its table.

Copies meet only once, as one fingerprint. A segment key with more than `crowd` fingerprints is not
matched pair by pair: its fingerprints, and those that look it up, are dealt into blocks, every two blocks are compared in one
task with numpy, and only links of a spanning forest leave it, which is all that groups need.

Defined results: null and empty texts and texts without words have fingerprint 0, which is linked
like any other; rows with a null doc_id get the group of their text, whose id is the smallest doc_id
in it that is not null; repeated rows give repeated results. Only `doc_id` and `text` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import free_names, small_batches, written
from eventlake.llm.components import components

BITS = 64
SEED = 42


def fingerprint(text: str | None, words: int = 3) -> int:
    """The fingerprint of one text as an unsigned number.

    A bit is set if it is set in over half of the shingle hashes. A-Z are lower-cased; words end at
    ASCII white space; a text of fewer words is one shingle.
    """
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    count = max(len(tokens) - words + 1, 1)
    stops = ends[words - 1 :].tolist() if len(tokens) >= words else [len(joined)]
    begins = [0, *(ends[: count - 1] + 1).tolist()]
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, 65_536):
        pairs = zip(begins[at : at + 65_536], stops[at : at + 65_536])
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), "<u8", len(stops[at : at + 65_536]))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            found = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def _segment_bounds(segments: int) -> list[tuple[int, int]]:
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _key(shift: int, width: int):
    mask = (1 << width) - 1
    return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(mask if mask < 1 << 63 else -1).cast("long"))


def links(distinct: DataFrame, radius: int = 3, segments: int = 2, crowd: int = 512) -> DataFrame:
    """Links (a < b) between the distinct fingerprints of column fp, enough to connect all groups.

    All links of up to `radius` bits, but for those inside a crowded segment key, of which a spanning
    forest is left.
    """
    if radius // segments > 1:
        raise ValueError("take more segments: balls of one bit are enumerated")
    bounds = _segment_bounds(segments)
    ball = radius // segments
    tables = F.array(*(F.struct(F.lit(i).alias("segment"), _key(*b).alias("key")) for i, b in enumerate(bounds)))
    rows = distinct.select("fp", F.inline(tables))
    crowded = written(rows.groupBy("segment", "key").count().where(F.col("count") > crowd).drop("count"), "crowds")

    def flips(i: int, shift: int, width: int):
        own = _key(shift, width)
        keys = [own] if not ball else [own, *(F.when(own.bitwiseAND(F.lit(1 << n).cast("long")) == 0, own.bitwiseOR(F.lit(1 << n).cast("long"))) for n in range(width))]
        return F.transform(F.filter(F.array(*keys), lambda k: k.isNotNull()), lambda k: F.struct(F.lit(i).alias("segment"), k.alias("key"), (k == own).alias("own")))

    probes = distinct.select("fp", F.inline(F.concat(*(flips(i, *b) for i, b in enumerate(bounds)))))
    inside = None
    if not crowded.isEmpty():
        # all that looks up a crowded key is compared in blocks, which find every link to that key
        marked = probes.join(crowded.withColumn("crowd", F.lit(True)), ["segment", "key"], "left")
        inside = marked.where("crowd").select("segment", "key", "fp")
        probes = marked.where("crowd IS NULL").drop("crowd")
    near = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("t.fp"))) <= radius
    found = probes.alias("p").join(rows.alias("t"), ["segment", "key"])
    pairs = found.where(near & (~F.col("own") | (F.col("p.fp") < F.col("t.fp")))).select(
        F.least("p.fp", "t.fp").alias("a"), F.greatest("p.fp", "t.fp").alias("b")
    )
    if inside is not None:
        pairs = pairs.unionByName(_crowd_links(inside, radius, 4 * crowd))
    return pairs.distinct()


def _crowd_links(inside: DataFrame, radius: int, size: int) -> DataFrame:
    """Spanning forests of every two blocks, of about `size` rows each, of the rows of each key."""
    counts = inside.groupBy("segment", "key").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    dealt = inside.join(counts, ["segment", "key"]).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    # block i meets every block j; the pair (i, j) is one task's group
    met = dealt.select("segment", "key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "segment", "key", "fp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(spanning_links(group["fp"].to_numpy(), radius), columns=["a", "b"], dtype=np.int64)

    return met.groupBy("segment", "key", "i", "j").applyInPandas(compare, "a long, b long")


def spanning_links(fps: np.ndarray, radius: int) -> np.ndarray:
    """A spanning forest of the links between these fingerprints, as rows (smaller, larger)."""
    fps = np.unique(fps)
    bits = fps.view(np.uint64)
    left, out = np.ones(len(fps), bool), []
    for first in range(len(fps)):
        if not left[first]:
            continue
        left[first], queue = False, [first]
        while queue and left.any():
            at = queue.pop()
            rest = np.flatnonzero(left)
            near = rest[np.bitwise_count(bits[rest] ^ bits[at]) <= radius]
            left[near] = False
            queue.extend(near.tolist())
            out.extend((min(fps[at], fps[n]), max(fps[at], fps[n])) for n in near)
    return np.array(out, np.int64).reshape(-1, 2)


def groups(prints: DataFrame, radius: int = 3, segments: int = 2, crowd: int = 512) -> DataFrame:
    """fp, root (unique per group) and component_id, the smallest doc_id of all fingerprints reachable from it.

    Groups without a doc_id, or with the same smallest one, share component_id but not root. `prints` holds doc_id and fp and should be a written table, since it is read more than once.
    """
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(links(distinct.select("fp"), radius, segments, crowd))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def near_duplicates(documents: DataFrame, radius: int = 3, segments: int = 2, words: int = 3) -> DataFrame:
    """doc_id, fp and component_id for every row."""
    prints = written(fingerprints(documents, words), "prints")
    return prints.join(groups(prints, radius, segments), "fp").select("doc_id", "fp", "component_id")


def keep_one(documents: DataFrame, radius: int = 5, segments: int = 3, words: int = 3) -> DataFrame:
    """One document of each group, that with the smallest doc_id, with all its columns.

    Of rows of a group that repeat its id, one stays. A group without any doc_id keeps one row. Rows are
    written once with their fingerprint. Groups reach further than those of `near_duplicates`: with three
    segments, balls of one bit find all links of up to five bits for the same number of lookups, each of
    which meets more rows.
    """
    names = documents.schema.names
    fp, known, number = free_names(names, "fp", "known", "number")
    keys = {known: F.col("doc_id").isNotNull(), number: F.coalesce("doc_id", F.lit(0).cast("long"))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 2 << 20):
            found = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found.view(np.int64))], names=[*names, fp])

    marked = written(documents.mapInArrow(run, documents.withColumn(fp, F.lit(0).cast("long")).schema), "marked")
    prints = marked.select("doc_id", F.col(fp).alias("fp"))
    # one fingerprint of each group leads: that of its smallest doc_id, then the smallest
    ids = prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    leads = (
        groups(prints, radius, segments).join(ids, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "doc_id").agg(F.min("fp").alias("fp"))
    )
    chosen = leads.withColumns(keys).select(F.col("fp").alias(fp), known, number)
    # joined and made distinct on the same keys: the texts are shuffled once
    return marked.withColumns(keys).join(chosen, [fp, known, number], "left_semi").dropDuplicates([fp, known, number]).select(*names)
