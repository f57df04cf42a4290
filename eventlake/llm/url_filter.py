"""Accept or reject urls by rules and, where no rule fits, by two character models.

Rules name a host and a path prefix. Urls on which a rule decides are the examples: a variable-order Markov
model of bytes is counted for the accepted and one for the rejected ones. In a model the probability of a
byte after the longest known context is blended with that after the next shorter one, in proportion to how
many different bytes followed (Witten-Bell). The score of a url is the difference of its log-likelihoods,
per byte, and the cut is set on examples that the models have not seen.

Byte counts come from all examples and are added up in Spark. A context is kept while it holds at least
`least_share` of the bytes of a model, so the models have a bounded size whatever the number of urls.

Defined results: a null url, or one without `://`, has an empty host and path, to which no rule fits; a null
or empty url scores 0; where there are examples of one kind only, every url scores 0 and is allowed; equal
urls get equal verdicts; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import free_names, gather_runs, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BEGIN, END = 2, 3  # bytes before and after a url


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    order: int = 5  # bytes of context, 6 at most
    # a byte after a context is kept if it holds this share of all bytes of a model
    least_share: float = 5e-6
    held_back: int = 8  # one in so many urls sets the cut
    steps: int = 400  # steps of the score, per unit, in which the cut is sought
    widest: float = 8.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, in lower case, and path; both empty for a null url or one without `://`."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """rule and verdict of the longest rule that fits; null if none does. Of equal rules the first counts."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)) if rules else []:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def codes(urls: list[str | None], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order k the k bytes before and the byte at every place, as one number, and bytes per url.

    The number has the order in its top byte; the last place of a url is its end.
    """
    raw = [(u or "").encode() for u in urls]
    sizes = np.array([len(r) + 1 if r else 0 for r in raw], np.int64)
    pad = bytes([BEGIN]) * order
    flat = np.frombuffer(b"".join(pad + r + bytes([END]) for r in raw if r), np.uint8).astype(np.uint64)
    whole = sizes[sizes > 0]
    starts = np.cumsum(whole + order) - whole
    places = gather_runs(starts, whole)
    out, value = [], np.zeros(len(places), np.uint64)
    for k in range(order + 1):
        value = value | (flat[places - k] << np.uint64(8 * k))
        out.append(value | (np.uint64(k + 1) << np.uint64(56)))
    return out, sizes


class UrlModel:
    """Two models in one table of codes: how often each was seen among accepted and rejected urls."""

    def __init__(self, order: int, grams: np.ndarray, seen: np.ndarray, cut: float = 0.0):
        """grams: codes, ascending; seen: a row of counts for each of the two models."""
        self.order, self.grams, self.seen, self.cut = order, grams, seen.astype(np.float64), cut
        self.trained = bool(len(grams)) and bool((self.seen.sum(axis=1) > 0).all())
        kind = grams >> np.uint64(56)
        context = (kind << np.uint64(56)) | ((grams & np.uint64((1 << 56) - 1)) >> np.uint64(8))
        # codes ascend by order and then by context, so a context's bytes lie together
        self.contexts, first, owner = np.unique(context, return_index=True, return_inverse=True)
        self.total = np.stack([np.bincount(owner, c, len(self.contexts)) for c in self.seen])
        self.kinds = np.stack([np.bincount(owner, c > 0, len(self.contexts)) for c in self.seen])

    def scores(self, urls: list[str | None]) -> np.ndarray:
        """Log-likelihood as an accepted minus that as a rejected url, per byte."""
        places, sizes = codes(urls, self.order)
        if not self.trained or not sizes.sum():
            return np.zeros(len(urls))
        p = np.full((2, int(sizes.sum())), 1 / 256)
        for k in range(self.order + 1):
            unique, back = np.unique(places[k], return_inverse=True)
            at = np.searchsorted(self.grams, unique)
            known = (at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == unique)
            count = np.where(known, self.seen[:, np.minimum(at, len(self.grams) - 1)], 0.0)[:, back]
            context = (unique >> np.uint64(56) << np.uint64(56)) | ((unique & np.uint64((1 << 56) - 1)) >> np.uint64(8))
            at = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
            met = self.contexts[at] == context
            total = np.where(met, self.total[:, at], 0.0)[:, back]
            kinds = np.where(met, self.kinds[:, at], 0.0)[:, back]
            seen = total > 0
            p = np.where(seen, (count + kinds * p) / np.where(seen, total + kinds, 1.0), p)
        steps = np.log(p[0]) - np.log(p[1])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return np.bincount(owner, steps, len(sizes)) / np.maximum(sizes, 1)


def _examples(urls: DataFrame, rules: list[Rule], settings: Settings) -> DataFrame:
    """url, accepted, held_back of every url on which a rule decides. Equal urls are held back together."""
    host, path = url_parts(F.col("url"))
    return urls.select("url", fitting_rule(host, path, rules).alias("found")).where("found is not null").select(
        "url", (F.col("found")["verdict"] == "allow").alias("accepted"),
        (F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(settings.held_back)) == 0).alias("held_back"),
    )


def counted(examples: DataFrame, settings: Settings) -> DataFrame:
    """gram, accepted, rejected: how often each code occurs among the examples (url, accepted)."""
    order = settings.order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, sizes = codes(batch.column("url").to_pylist(), order)
            accepted = np.repeat(np.array(batch.column("accepted").to_pylist(), bool), sizes)
            for at in places:
                grams, back = np.unique(at, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams.astype(np.int64)),
                        pa.array(np.bincount(back[accepted], minlength=len(grams)).astype(np.int64)),
                        pa.array(np.bincount(back[~accepted], minlength=len(grams)).astype(np.int64)),
                    ],
                    names=["gram", "accepted", "rejected"],
                )

    found = examples.select("url", "accepted").mapInArrow(run, "gram long, accepted long, rejected long")
    return found.groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


def fit(urls: DataFrame, rules: list[Rule], settings: Settings = Settings()) -> UrlModel:
    """The model of all urls (column url) on which a rule decides, and its cut."""
    examples = _examples(urls, rules, settings)
    grams = written(counted(examples.where("not held_back"), settings), "url_grams")
    first = F.shiftright("gram", 56) == 1  # order 0: every byte once
    totals = grams.where(first).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).first()
    kept = grams.where(
        (F.col("accepted") > (totals["a"] or 0) * settings.least_share) | (F.col("rejected") > (totals["r"] or 0) * settings.least_share)
    )
    # at most (order + 1) * 2 / least_share rows
    table = kept.toPandas().sort_values("gram")
    model = UrlModel(settings.order, table["gram"].to_numpy(np.uint64), table[["accepted", "rejected"]].to_numpy().T)
    model.cut = _cut(examples.where("held_back"), model, settings)
    return model


def _cut(examples: DataFrame, model: UrlModel, settings: Settings) -> float:
    """The score that parts held-back examples best, both kinds counting alike; 0 if one kind is missing."""
    if not model.trained:
        return 0.0
    step = F.floor(F.greatest(F.least(F.col("score"), F.lit(settings.widest)), F.lit(-settings.widest)) * settings.steps)
    # a row per step of the score and kind
    rows = scored(examples, model).groupBy(step.alias("step"), "accepted").count().collect()
    good, bad = ({r["step"]: r["count"] for r in rows if r["accepted"] is kind} for kind in (True, False))
    if not good or not bad:
        return 0.0
    n_good, n_bad = sum(good.values()), sum(bad.values())
    best, below = [], [n_good, 0]  # above the cut: all good ones; below it: no bad one
    for at in sorted(good.keys() | bad.keys()):
        best.append((below[0] / n_good + below[1] / n_bad, at))
        below = [below[0] - good.get(at, 0), below[1] + bad.get(at, 0)]
    best.append((below[0] / n_good + below[1] / n_bad, max(good.keys() | bad.keys()) + 1))
    top = max(value for value, _ in best)
    places = sorted(at for value, at in best if value >= top - 1e-12)
    # between two scores the middle; of several such cuts the one nearest to 0
    seen = sorted(good.keys() | bad.keys())
    middles = [(at + max((s for s in seen if s < at), default=at - 1) + 1) / 2 for at in places]
    return min(middles, key=abs) / settings.steps


def scored(urls: DataFrame, model: UrlModel) -> DataFrame:
    """The rows with the column score."""
    names = urls.columns
    (score,) = free_names([n for n in names if n != "score"], "score")
    shared = urls.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.scores(batch.column(batch.schema.get_field_index("url")).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*names, score])

    return urls.mapInArrow(run, f"{_schema(urls)}, `{score}` double")


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def judge(pages: DataFrame, rules: list[Rule], model: UrlModel) -> DataFrame:
    """page_id, url, host, path, rule, score and verdict (allow or block) of every page."""
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    parts = parts.withColumn("found", fitting_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("score") >= model.cut, "allow").otherwise("block")
    return scored(parts, model).select(
        "page_id", "url", "host", "path", F.col("found")["rule"].alias("rule"), "score",
        F.coalesce(F.col("found")["verdict"], own).alias("verdict"),
    )
