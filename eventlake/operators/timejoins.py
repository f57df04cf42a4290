"""Joins over time: an event that another follows, the newest event before, events within intervals and their totals.

None of them is a range join in the plan. Time is cut into bins that take part in an equi-join, and the exact
bounds are verified on what meets in a bin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def followed_within(
    first: DataFrame, then: DataFrame, keys: Sequence[str], seconds: int, watermark: str | None = None
) -> DataFrame:
    """Every pair of an event and a later one with the same keys, at most so many seconds after it.

    One definition for batch and stream. Time is binned by the span, and each first event goes to its own bin
    and the next, so a busy key is spread over its bins. In a stream both sides carry the watermark, and the
    bound on time lets Spark drop the state of a first event once no partner can come any more. Rows without
    a key or a time have no partner.
    """
    def side(events: DataFrame, name: str) -> DataFrame:
        found = events.select(*keys, F.col("event_id").alias(f"{name}_id"), F.col("event_timestamp").alias(f"{name}_at"))
        return found.withWatermark(f"{name}_at", watermark) if watermark else found

    def bin_of(name: str) -> Column:
        return F.floor(F.unix_seconds(f"{name}_at") / seconds)

    early = side(first, "first").withColumn("_bin", F.explode(F.array(bin_of("first"), bin_of("first") + 1)))
    late = side(then, "then").withColumn("_bin", bin_of("then"))
    both = early.alias("a").join(late.alias("b"), [
        *(F.col(f"a.{k}") == F.col(f"b.{k}") for k in (*keys, "_bin")),
        F.expr(f"then_at >= first_at AND then_at <= first_at + INTERVAL {int(seconds)} SECONDS"),
    ])
    return both.select(
        *(F.col(f"a.{k}") for k in keys), "first_id", "then_id", "first_at", "then_at",
        (F.unix_micros("then_at") - F.unix_micros("first_at")).alias("micros_between"),
    )


def last_before(facts: DataFrame, marks: DataFrame, key: str, stretch_seconds: int = 3600) -> DataFrame:
    """Each fact with `mark`, the newest row of the other table with its key at its time or before.

    Both tables go into one, cut into stretches of time per key. Within a stretch the newest mark is a running
    value; what a stretch begins with is the newest mark of all stretches before it, a running value over one
    row per key and stretch. So a busy key is as many tasks as it has stretches, and nothing is joined by
    range. Of marks at the same time the one with the highest event_id counts; a fact without a key, a time or
    an earlier mark has none.
    """
    when = F.col("event_timestamp")
    timed = marks.filter(F.col(key).isNotNull() & when.isNotNull())
    kinds = {"_fact": facts.schema, "_mark": marks.schema}
    empty = {name: F.lit(None).cast(kind) for name, kind in kinds.items()}

    def tagged(rows: DataFrame, name: str) -> DataFrame:
        own = {name: F.struct(*(F.col(c) for c in rows.columns))}
        return rows.select(
            F.col(key).alias("_key"), when.alias("_at"), F.col("event_id").alias("_id"),
            F.lit(name == "_fact").alias("_is_fact"), *({**empty, **own}[n].alias(n) for n in kinds),
        )

    both = tagged(timed, "_mark").unionByName(tagged(facts, "_fact")).withColumn(
        "_stretch", F.floor(F.unix_seconds("_at") / stretch_seconds)
    )
    newest = F.max(F.when(~F.col("_is_fact"), F.struct("_at", "_id", "_mark")))
    before = W.partitionBy("_key").orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        both.filter(F.col("_key").isNotNull() & F.col("_at").isNotNull()).groupBy("_key", "_stretch").agg(newest.alias("_newest"))
        .withColumn("_carried", F.last("_newest", ignorenulls=True).over(before)["_mark"])
        .select(F.col("_key").alias("_k"), F.col("_stretch").alias("_s"), "_carried")
    )
    inside = W.partitionBy("_key", "_stretch").orderBy("_at", "_is_fact", "_id").rowsBetween(W.unboundedPreceding, 0)
    here = both.withColumn("_here", F.last("_mark", ignorenulls=True).over(inside)).filter("_is_fact")
    found = here.join(carried, (F.col("_key") == F.col("_k")) & (F.col("_stretch") == F.col("_s")), "left")
    # rows without a key or a time share a window with others of their kind, in which there is no mark
    return found.select("_fact.*", F.coalesce("_here", "_carried").alias("mark"))


def _pieces(low: Column, high: Column, fan: int, levels: int) -> Column:
    """The bins from `low` up to `high` as (level, bin): coarse ones in the middle, finer ones at both ends."""
    none = F.array().cast("array<struct<level:int,bin:bigint>>")
    out = []

    def bins(level: int, start: Column, stop: Column) -> Column:
        listed = F.transform(F.sequence(start, stop - 1), lambda b: F.struct(F.lit(level).alias("level"), b.alias("bin")))
        return F.when(start < stop, listed).otherwise(none)

    for level in range(levels - 1):
        inner_low, inner_high = F.ceil(low / fan), F.floor(high / fan)
        whole = inner_low < inner_high
        out.append(bins(level, low, F.when(whole, inner_low * fan).otherwise(high)))
        out.append(F.when(whole, bins(level, inner_high * fan, high)).otherwise(none))
        low, high = F.when(whole, inner_low).otherwise(F.lit(0)), F.when(whole, inner_high).otherwise(F.lit(0))
    out.append(bins(levels - 1, low, high))
    return F.concat(*out)


def in_intervals(
    events: DataFrame, intervals: DataFrame, start: str, end: str, keys: Sequence[str] = (),
    bin_seconds: int = 3600, fan: int = 16, levels: int = 3,
) -> DataFrame:
    """Every event with each interval (start included, end not) that it lies in, keys being equal.

    An interval is cut into bins of `levels` sizes, each `fan` times the one before, coarse ones in its middle
    and fine ones at its ends: a long interval has few pieces. Every moment of it lies in exactly one piece,
    so an event, which looks for its bin of each size, meets an interval once. Intervals with a null bound,
    or that end before they start, hold no event.
    """
    micros = {name: F.unix_micros(F.col(name)) for name in (start, end)}
    low = F.floor(micros[start] / (bin_seconds * 1_000_000))
    high = F.ceil(micros[end] / (bin_seconds * 1_000_000))
    real = intervals.filter(F.col(start) < F.col(end))
    pieces = real.withColumns({"_low": low, "_high": high}).withColumn(
        "_piece", F.explode(_pieces(F.col("_low"), F.col("_high"), fan, levels))
    ).drop("_low", "_high")
    seconds = F.unix_seconds("event_timestamp")
    own = F.array(*(
        F.struct(F.lit(level).alias("level"), F.floor(seconds / (bin_seconds * fan**level)).alias("bin")) for level in range(levels)
    ))
    placed = events.filter(F.col("event_timestamp").isNotNull()).withColumn("_place", F.explode(own))
    same = [F.col(f"e.{k}") == F.col(f"i.{k}") for k in keys]
    # pieces are far more than Catalyst estimates from the intervals' size: never broadcast them
    met = placed.alias("e").join(pieces.alias("i").hint("merge"), [
        *same, F.col("e._place.level") == F.col("i._piece.level"), F.col("e._place.bin") == F.col("i._piece.bin"),
        F.col("e.event_timestamp") >= F.col(f"i.{start}"), F.col("e.event_timestamp") < F.col(f"i.{end}"),
    ])
    return met.select(
        *(F.col(f"e.{c}") for c in events.columns), *(F.col(f"i.{c}") for c in intervals.columns if c not in keys)
    )


def totals_in_intervals(
    events: DataFrame, intervals: DataFrame, start: str, end: str, keys: Sequence[str], totals: Mapping[str, Column],
    stretch_seconds: int = 3600,
) -> DataFrame:
    """Sums over the events that lie in each interval (start included, end not), keys being equal.

    No event meets an interval: the sum over an interval is the sum over all events before its end less that over
    all before its start. Events are added up per moment and stand in one line of time with the bounds, cut into
    stretches per key. Within a stretch the sum is a running value, and what a stretch begins with is a running
    value over one row per key and stretch. So the work grows with events plus intervals, not with their pairs.
    `totals` are numbers of an event, whole or decimal, as differences of doubles are not exact; nulls add nothing.
    Equal intervals are one row, with their events as often as it occurs; one without events has sums of 0.
    Intervals with a null bound, or that end before they start, are left out.
    """
    own = [f"_{n}" for n in totals]
    added = events.select(*keys, F.col("event_timestamp").alias("_at"), *(v.alias(n) for n, v in zip(own, totals.values())))
    added = added.groupBy(*keys, "_at").agg(*(F.sum(n).alias(n) for n in own))
    row = F.struct(*(F.col(c) for c in intervals.columns))
    bound = F.explode(F.array(*(F.struct(F.col(c).alias("at"), F.lit(sign).alias("sign")) for c, sign in ((start, -1), (end, 1)))))
    bounds = (
        intervals.filter(F.col(start) < F.col(end)).select(*keys, row.alias("_interval"), bound.alias("_bound"))
        .select(*keys, "_interval", F.col("_bound.at").alias("_at"), F.col("_bound.sign").alias("_sign"))
    )
    line = added.unionByName(bounds, allowMissingColumns=True).dropna(subset=[*keys, "_at"]).withColumn(
        "_stretch", F.floor(F.unix_seconds("_at") / stretch_seconds)
    )
    before = W.partitionBy(*keys).orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = line.groupBy(*keys, "_stretch").agg(*(F.sum(n).alias(n) for n in own)).select(
        *keys, "_stretch", *(F.sum(n).over(before).alias(f"{n}_carried") for n in own)
    )
    # bounds stand before the events of their moment
    inside = W.partitionBy(*keys, "_stretch").orderBy("_at", F.col("_sign").isNull()).rowsBetween(W.unboundedPreceding, 0)
    here = line.select(*keys, "_stretch", "_interval", "_sign", *(F.sum(n).over(inside).alias(n) for n in own)).filter("_sign IS NOT NULL")
    none = F.lit(0)

    def signed(n: str) -> Column:
        so_far = F.coalesce(F.col(n), none) + F.coalesce(F.col(f"{n}_carried"), none)
        return F.sum(F.when(F.col("_sign") > 0, so_far).otherwise(-so_far))

    found = here.join(carried, [*keys, "_stretch"]).groupBy("_interval")
    return found.agg(*(signed(n).alias(n) for n in own)).select("_interval.*", *(F.col(f"_{n}").alias(n) for n in totals))
