"""Toxicity scores by a convolutional text classifier.

Words become sums of hashed embeddings (the word and two of its prefixes, so that inflected forms
share what a stem teaches). Filters of several widths slide over the words, each keeps its highest
answer in the whole text, and a linear layer turns those into a logit. The classifier is trained in
numpy with gradients through the positions that gave the highest answers: first on a sample, then on
all labelled rows, where every task trains on its own rows and the changes are averaged. The cut
between the two classes is set per language on rows held back from training. A text's language is read
from its words, by markers learnt from the labelled rows that name one; a score never uses the column
itself.

Defined results: a null text counts as empty; an empty text has the score of a text without words;
a null or repeated doc_id is scored like any other row; without labels of both classes every score
is the share of positive labels (0 without labels). Only `doc_id` and `text` of the documents are
read, so further columns of any name do no harm. Repeated labels of a document count once: toxic if
any of them is.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import columns, drawn, letter_words, small_batches, written

SCORE_SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


@dataclass(frozen=True)
class Settings:
    """Production parameters.

    `positives` and `negatives` bound the labelled rows of the warm-up (those of lowest key hash),
    `sample_words` leaves longer texts out of it. The pass that follows trains on all labelled rows,
    whole; cuts and markers come from all of them. Scoring has no bound.
    """

    buckets: int = 1 << 18
    size: int = 16
    filters: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    prefixes: tuple[int, ...] = (4, 6)
    epochs: int = 12
    rate: float = 0.15
    batch: int = 32
    positives: int = 3000
    negatives: int = 5000
    sample_words: int = 50_000
    calibration: float = 0.2
    least_calibrated: int = 20
    common: int = 40  # most frequent words of a text, by which its language is told
    markers: int = 20
    marker_share: float = 0.05  # by which a marker is in more texts of its language than of any other
    pass_rate: float = 0.01
    cached_words: int = 300_000
    chunk: int = 4096
    seed: int = 7


def _buckets(word: str, s: Settings) -> tuple[int, ...]:
    parts = [word, *(f"{n}<{word[:n]}" for n in s.prefixes)]
    return tuple(zlib.crc32(p.encode()) % s.buckets for p in parts)


def learn_markers(common: list[list[str]], languages: list[str | None], s: Settings) -> dict[str, list[str]]:
    """For each language of the sample the words by which its texts are told: those that stand among the most
    frequent words of many of its texts and of few texts of any other language."""
    texts = Counter(lang for lang in languages if lang is not None)
    texts = {lang: n for lang, n in texts.items() if n >= s.least_calibrated}
    seen = {lang: Counter() for lang in sorted(texts)}
    for words, lang in zip(common, languages):
        if lang in seen:
            seen[lang].update(words)
    return _told_apart(seen, texts, s)


def _told_apart(seen: dict[str, Counter], texts: dict[str, int], s: Settings) -> dict[str, list[str]]:
    shares = {lang: {w: n / texts[lang] for w, n in counts.items()} for lang, counts in seen.items()}
    markers = {}
    for lang, own in shares.items():
        apart = {w: share - max((other.get(w, 0.0) for name, other in shares.items() if name != lang), default=0.0) for w, share in own.items()}
        markers[lang] = sorted((w for w in apart if apart[w] > s.marker_share), key=lambda w: (-apart[w], w))[: s.markers]
    return markers


def guess_language(words: list[str], markers: dict[str, list[str]]) -> str:
    """The language with most of its markers among the words; `other` if there is none."""
    found = set(words)
    hits = {lang: sum(w in found for w in own) for lang, own in markers.items()}
    best = max(hits, key=lambda lang: hits[lang], default=None)
    return best if best is not None and hits[best] else "other"


@dataclass
class Model:
    settings: Settings
    table: np.ndarray  # buckets x size
    kernels: list[np.ndarray]  # per width: width x size x filters
    bias: np.ndarray  # all filters
    out: np.ndarray
    out_bias: float
    cut: dict[str, float]  # logit at which a language's texts turn positive; "" for all others
    markers: dict[str, list[str]]  # words that tell a language

    def answers(self, x: np.ndarray) -> np.ndarray:
        """Filter answers at every position; the last positions see zeros behind the end."""
        s = self.settings
        reach = max(s.widths) - 1
        padded = np.concatenate([x, np.zeros((reach, s.size), np.float32)])
        parts = []
        for kernel in self.kernels:
            y = padded[: len(x)] @ kernel[0]
            for j in range(1, len(kernel)):
                y += padded[j : j + len(x)] @ kernel[j]
            parts.append(y)
        return np.concatenate(parts, axis=1)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias


class Scorer:
    """Scores batches of texts with bounded memory; keeps a worker's known words."""

    def __init__(self, model: Model):
        self.model, s = model, model.settings
        self.languages = list(model.markers)
        self.marked = [set(words) for words in model.markers.values()]
        self.shift = np.array([model.cut.get(lang, model.cut[""]) for lang in [*self.languages, "other"]])
        self.vectors = np.zeros((s.cached_words + 1, s.size), np.float32)
        self.votes = np.zeros((s.cached_words + 1, len(self.languages) + 1), np.int32)  # the last column stays 0
        self.rows: dict[str, int] = {"": 0}  # no word: zeros

    def _rows(self, words: list[str]) -> np.ndarray:
        known = self.rows
        fresh = set(words).difference(known)
        if fresh:
            if len(known) + len(fresh) > self.model.settings.cached_words:
                known.clear()
                known[""] = 0
                fresh = set(words) - {""}
            fresh = list(fresh)
            ids = np.array([_buckets(w, self.model.settings) for w in fresh])
            new = slice(len(known), len(known) + len(fresh))
            self.vectors[new] = self.model.table[ids].sum(axis=1)
            self.votes[new] = [[*(w in own for own in self.marked), 0] for w in fresh]
            known.update(zip(fresh, range(new.start, new.stop)))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Texts longer than a chunk are pooled chunk by chunk."""
        s = self.model.settings
        reach = max(s.widths) - 1
        pooled = np.full((len(texts), len(self.model.bias)), -np.inf, np.float32)
        votes = np.zeros((len(texts), len(self.languages) + 1), np.int64)
        owners, lengths, beyond, flat = [], [], [], []

        def flush():
            own = np.array(lengths)
            rows = self._rows(flat)
            ends = np.cumsum(own + reach + 1)
            index = np.zeros(int(ends[-1]), np.int64)
            index[np.arange(len(rows)) + np.repeat(np.arange(len(own)) * (reach + 1), own)] = rows
            starts = ends - own - reach - 1
            answers = self.model.answers(self.vectors[index])
            # windows of the last places reach into the next text; a piece with more behind it ends
            # where its next one begins
            extra = [p for end, more in zip(ends, beyond) for p in range(end - reach - (reach + 1) * more, end)]
            answers[extra], index[extra] = -np.inf, 0
            np.maximum.at(pooled, owners, np.maximum.reduceat(answers, starts, axis=0))
            np.add.at(votes, owners, np.add.reduceat(self.votes[index], starts, axis=0))
            owners.clear(), lengths.clear(), beyond.clear(), flat.clear()

        for i, text in enumerate(texts):
            words = letter_words(text)
            for start in range(0, max(len(words), 1), s.chunk):
                more = start + s.chunk < len(words)
                # what follows a piece is read along; the last piece may be shorter than that
                piece = words[start : start + s.chunk + reach] + [""] * max(0, start + s.chunk + reach - len(words)) * more
                if flat and len(flat) + len(piece) > s.chunk:
                    flush()
                owners.append(i), lengths.append(len(piece)), beyond.append(more)
                flat.extend(piece)
        if owners:
            flush()
        most = np.where(votes.max(axis=1) > 0, votes.argmax(axis=1), len(self.languages))
        return 1 / (1 + np.exp(-np.clip(self.model.logits(pooled) - self.shift[most], -40, 40)))


@dataclass
class Trainer:
    """A model on its way: its sums of squared gradients, and how often each bucket was moved."""

    model: Model
    squares: dict
    touched: np.ndarray

    def step(self, docs: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One step on bucket ids (words x parts) per document.

        Gradients run only through the position at which each filter answered highest, so of a text no more is
        held at once than its ids and the answers of a chunk.
        """
        model, squares, s = self.model, self.squares, self.model.settings
        reach = max(s.widths) - 1
        lengths = np.array([len(d) for d in docs]) + reach + 1
        starts = np.cumsum(lengths) - lengths
        ids = np.full((int(lengths.sum()), 1 + len(s.prefixes)), -1, np.int64)
        for own, start in zip(docs, starts):
            ids[start : start + len(own)] = own
        best, pooled = _highest(model, ids, starts, lengths - reach)
        active = np.maximum(pooled + model.bias, 0)
        logit = active @ model.out + model.out_bias
        slope = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) * weight / len(docs)
        back = (slope[:, None] * model.out).astype(np.float32) * (active > 0)
        grads_out, grad_out_bias = slope @ active, float(slope.sum())
        seen_at = [np.minimum(best + j, len(ids) - 1) for j in range(reach + 1)]
        spots, place = np.unique(np.stack(seen_at), return_inverse=True)
        place = place.reshape(reach + 1, *best.shape)
        x = _vectors(model, ids[spots])
        dx = np.zeros_like(x)
        filter_width, column = np.repeat(np.arange(len(s.widths)), s.filters), np.tile(np.arange(s.filters), len(s.widths))
        for w, width in enumerate(s.widths):
            own = filter_width == w
            g, col = back[:, own], column[own]
            for j in range(width):
                seen = place[j][:, own]
                grad = np.einsum("bf,bfd->df", g, x[seen])
                squares["kernels"][w][j] += grad**2
                np.add.at(dx, seen.ravel(), (g[:, :, None] * model.kernels[w][j].T[col]).reshape(-1, s.size))
                model.kernels[w][j] -= rate * 0.3 * grad / np.sqrt(squares["kernels"][w][j])
        moved = np.flatnonzero((ids[spots, 0] >= 0) & (np.abs(dx).sum(axis=1) > 0))
        buckets, into = np.unique(ids[spots[moved]].ravel(), return_inverse=True)
        grad = np.zeros((len(buckets), s.size), np.float32)
        np.add.at(grad, into, np.repeat(dx[moved], ids.shape[1], axis=0))
        squares["table"][buckets] += (grad**2).mean(axis=1)
        model.table[buckets] -= rate * grad / np.sqrt(squares["table"][buckets])[:, None]
        self.touched[buckets] += 1
        for name, grad in (("out", grads_out), ("bias", back.sum(axis=0))):
            squares[name] += grad**2
            setattr(model, name, (getattr(model, name) - rate * 0.3 * grad / np.sqrt(squares[name])).astype(np.float32))
        squares["out_bias"] += grad_out_bias**2
        model.out_bias -= rate * 0.3 * grad_out_bias / np.sqrt(squares["out_bias"])


def _vectors(model: Model, ids: np.ndarray) -> np.ndarray:
    """A vector per word; zeros where there is none."""
    x = np.zeros((len(ids), model.settings.size), np.float32)
    real = np.flatnonzero(ids[:, 0] >= 0)
    x[real] = model.table[ids[real]].sum(axis=1)
    return x


def _highest(model: Model, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chunk: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """For each text the position of every filter's highest answer, and that answer; a chunk of rows at a time."""
    reach = max(model.settings.widths) - 1
    at = np.zeros((len(starts), len(model.bias)), np.int64)
    pooled = np.full(at.shape, -np.inf, np.float32)
    for low in range(0, len(ids), chunk):
        y = model.answers(_vectors(model, ids[low : low + chunk + reach]))[:chunk]
        for i in range(int(np.searchsorted(starts + lengths, low, "right")), int(np.searchsorted(starts, low + len(y)))):
            first, last = max(starts[i] - low, 0), min(starts[i] + lengths[i] - low, len(y))
            if first < last:
                own = y[first:last]
                top = own.argmax(axis=0)
                value = np.take_along_axis(own, top[None], axis=0)[0]
                better = value > pooled[i]
                at[i][better], pooled[i][better] = top[better] + first + low, value[better]
    return at, pooled


def _trainer(s: Settings, rng: np.random.Generator) -> Trainer:
    model = Model(
        s,
        rng.normal(0, 0.05, (s.buckets, s.size)).astype(np.float32),
        [rng.normal(0, 1 / np.sqrt(w * s.size), (w, s.size, s.filters)).astype(np.float32) for w in s.widths],
        np.zeros(s.filters * len(s.widths), np.float32),
        rng.normal(0.3, 0.1, s.filters * len(s.widths)).astype(np.float32) * rng.choice([1, 1, 1, -1], s.filters * len(s.widths)),
        -1.0,
        {"": 0.0},
        {},
    )
    squares = {"table": np.full(s.buckets, 1e-6, np.float32), "out": np.full(len(model.out), 1e-6, np.float32), "bias": np.full(len(model.bias), 1e-6, np.float32), "out_bias": 1e-6, "kernels": [np.full(k.shape, 1e-6, np.float32) for k in model.kernels]}
    return Trainer(model, squares, np.zeros(s.buckets, np.int64))


def _class_weight(labels: np.ndarray, share: float) -> np.ndarray:
    return np.where(labels == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))


def _warm_up(docs: list[np.ndarray], labels: np.ndarray, fit: np.ndarray, s: Settings, rng: np.random.Generator) -> Trainer:
    trainer = _trainer(s, rng)
    weight = _class_weight(labels, labels[fit].mean() if len(fit) else 0.5)
    for epoch in range(s.epochs):
        rate = s.rate * (1 - epoch / s.epochs) + 0.01
        order = rng.permutation(fit)
        for begin in range(0, len(order), s.batch):
            chosen = order[begin : begin + s.batch]
            trainer.step([docs[i] for i in chosen], labels[chosen], weight[chosen], rate)
    return trainer


def train(docs: list[np.ndarray], labels: np.ndarray, languages: list[str], s: Settings) -> Model:
    """Fit on bucket ids (words x parts) per document, in one process."""
    rng = np.random.default_rng(s.seed)
    fold = rng.random(len(docs)) < s.calibration
    trainer = _warm_up(docs, labels, np.flatnonzero(~fold), s, rng)
    model = trainer.model
    model.table[trainer.touched == 0] = 0  # what no text has taught says nothing
    held = np.flatnonzero(fold)
    model.cut = _cuts(_plain_logits(model, [docs[i] for i in held]), labels[held], [languages[i] for i in held], s)
    return model


def _plain_logits(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    reach = max(model.settings.widths) - 1
    out, none = np.zeros(len(docs)), np.full((reach + 1, 1 + len(model.settings.prefixes)), -1, np.int64)
    for i, ids in enumerate(docs):
        whole = np.concatenate([ids, none])
        out[i] = model.logits(_highest(model, whole, np.array([0]), np.array([len(ids) + 1]))[1])[0]
    return out


def _best_cut(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> float:
    """The logit with fewest errors, in the middle of its gap; of equal ones that nearest to 0."""
    order = np.argsort(logits)
    x, y, n = logits[order], labels[order], counts[order]
    errors = np.concatenate([[0], np.cumsum(y * n)]) + np.concatenate([[0], np.cumsum(((1 - y) * n)[::-1])])[::-1]
    edges = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
    found = np.flatnonzero(errors == errors.min())
    return float(edges[found[np.abs(edges[found]).argmin()]])


def _cuts(logits: np.ndarray, labels: np.ndarray, languages: list[str], s: Settings, counts: np.ndarray | None = None) -> dict[str, float]:
    """`counts` tells how many texts each entry stands for; one, if it is left out."""
    if not len(logits) or labels.min() == labels.max():
        return {"": 0.0}
    n = np.ones(len(logits), np.int64) if counts is None else counts
    cuts, lang = {"": _best_cut(logits, labels, n)}, np.array(languages)
    for name in sorted(set(languages)):
        own = lang == name
        if min((labels * n)[own].sum(), ((1 - labels) * n)[own].sum()) >= s.least_calibrated:
            cuts[name] = _best_cut(logits[own], labels[own], n[own])
    return cuts


ROWS = "h long, doc_id long, y int, lang string, common array<string>, ids binary"


def _labelled(documents: DataFrame, labels: DataFrame, label: str, s: Settings) -> DataFrame:
    """Bucket ids and most frequent words of every labelled row; of rows that repeat an id one is taken."""
    marked = (
        labels.select("doc_id", F.col(label).alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
        .groupBy("doc_id").agg(F.max((F.col("y") == 1).cast("int")).alias("y"))
        .withColumn("h", F.xxhash64("doc_id"))
    )
    one = F.min(F.struct(F.xxhash64("text", "lang").alias("k"), "y", "h", "text", "lang"))
    lang = F.col("lang").cast("string") if "lang" in documents.columns else F.lit(None).cast("string")
    texts = documents.select("doc_id", "text", lang.alias("lang")).join(marked, "doc_id")
    texts = texts.groupBy("doc_id").agg(one.alias("one")).select("doc_id", "one.text", "one.y", "one.h", "one.lang")

    def encode(batches):
        for batch in small_batches(batches, "text", 2 << 20):
            out = []
            for doc_id, y, h, lang, text in zip(*columns(batch, "doc_id", "y", "h", "lang", "text")):
                words = letter_words(text)
                known = {w: _buckets(w, s) for w in set(words)}
                flat = np.array([known[w] for w in words], np.int32)
                out.append((h, doc_id, y, lang, [w for w, _ in Counter(words).most_common(s.common)], flat.tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["h", "doc_id", "y", "lang", "common", "ids"])

    return texts.mapInArrow(encode, ROWS)


def _drawn(rows: DataFrame, counts: dict[int, int], s: Settings) -> pd.DataFrame:
    """A bounded number of labelled rows for the warm-up, those of lowest key hash; longer texts are left to the passes."""
    part = 4 * (1 + len(s.prefixes))
    short = rows.where(F.octet_length("ids") <= s.sample_words * part).drop("common")
    chosen = drawn(short.where("y = 1"), "doc_id", s.positives, counts.get(1, 0)).unionByName(
        drawn(short.where("y = 0"), "doc_id", s.negatives, counts.get(0, 0))
    ).toPandas()
    return chosen.sort_values(["h", "doc_id", "y"]).reset_index(drop=True)


def _sample(documents: DataFrame, labels: DataFrame, label: str, s: Settings) -> pd.DataFrame:
    """What the warm-up learns from."""
    rows = written(_labelled(documents, labels, label, s), "labelled")
    return _drawn(rows, {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}, s)


def _markers(rows: DataFrame, s: Settings) -> dict[str, list[str]]:
    """`learn_markers` over all labelled rows; only words of a large share of a language reach the driver."""
    named = rows.where("lang IS NOT NULL").select("lang", "common")
    texts = {r["lang"]: r["count"] for r in named.groupBy("lang").count().where(F.col("count") >= s.least_calibrated).collect()}
    if not texts:
        return {}
    total = F.create_map(*(F.lit(x) for pair in texts.items() for x in pair))[F.col("lang")]
    counts = written(
        named.where(F.col("lang").isin(list(texts))).select("lang", F.explode("common").alias("word")).groupBy("lang", "word").count(), "words"
    )
    large = counts.where(F.col("count") > s.marker_share * total).select("word").distinct()
    seen = {lang: Counter() for lang in sorted(texts)}
    for r in counts.join(large, "word").collect():
        seen[r["lang"]][r["word"]] = r["count"]
    return _told_apart(seen, texts, s)


def _passed(rows: DataFrame, trainer: Trainer, share: float, s: Settings) -> Model:
    """The model after every task has trained on all its rows; what the tasks learnt is averaged.

    A bucket's change is averaged over the tasks that moved it, by how often they did: a word that one task alone
    has seen is learnt from it. The rest is averaged by rows.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(trainer)
    numbers = [f"d{i}" for i in range(s.size)]

    def run(batches):
        own = shared.value
        before = own.model
        after = Trainer(
            replace(before, table=before.table.copy(), kernels=[k.copy() for k in before.kernels]),
            {k: [q.copy() for q in v] if k == "kernels" else np.copy(v) if k != "out_bias" else v for k, v in own.squares.items()},
            np.zeros(s.buckets, np.int64),
        )
        n, docs, labels = 0, [], []

        def learn():
            y = np.array(labels, np.float64)
            after.step(docs, y, _class_weight(y, share), s.pass_rate)
            docs.clear(), labels.clear()

        for batch in batches:
            for y, ids in zip(*columns(batch, "y", "ids")):
                docs.append(np.frombuffer(ids, np.int32).reshape(-1, 1 + len(s.prefixes)))
                labels.append(y)
                n += 1
                if len(docs) == s.batch:
                    learn()
        if docs:
            learn()
        moved = np.flatnonzero(after.touched)
        flat = _flat(after.model) - _flat(before)
        flat = np.concatenate([flat, np.zeros(-len(flat) % s.size)]).reshape(-1, s.size)
        keys = np.concatenate([moved, -1 - np.arange(len(flat))])
        weight = np.concatenate([after.touched[moved], np.full(len(flat), n)]).astype(np.float64)
        change = np.concatenate([after.model.table[moved] - before.table[moved], flat]).astype(np.float32)
        for low in range(0, len(keys) if n else 0, 10_000):
            part = slice(low, low + 10_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[part]), pa.array(weight[part]), *(pa.array(c) for c in np.ascontiguousarray(change[part].T))], names=["bucket", "weight", *numbers]
            )

    learnt = rows.select("h", "doc_id", "y", "ids").sortWithinPartitions("h", "doc_id").mapInArrow(run, "bucket long, weight double, " + ", ".join(f"{c} float" for c in numbers))
    found = learnt.groupBy("bucket").agg(F.sum("weight").alias("weight"), *(F.sum(F.col(c) * F.col("weight")).alias(c) for c in numbers)).select(
        "bucket", *((F.col(c) / F.col("weight")).cast("float").alias(c) for c in numbers)
    ).toArrow()
    shared.unpersist()
    buckets = found.column("bucket").to_numpy()
    change = np.stack([found.column(c).to_numpy() for c in numbers], axis=1) if len(buckets) else np.zeros((0, s.size), np.float32)
    model, own = trainer.model, buckets >= 0
    table = model.table.copy()
    table[trainer.touched == 0] = 0  # what no text has taught says nothing
    table[buckets[own]] = model.table[buckets[own]] + change[own]
    flat = _flat(model)
    if (~own).any():
        flat = flat + change[~own][np.argsort(-buckets[~own])].ravel()[: len(flat)]
    return _with_flat(replace(model, table=table), flat)


def _flat(model: Model) -> np.ndarray:
    """All parameters but the table."""
    return np.concatenate([*(k.ravel() for k in model.kernels), model.bias, model.out, [model.out_bias]]).astype(np.float64)


def _with_flat(model: Model, flat: np.ndarray) -> Model:
    ends = np.cumsum([*(k.size for k in model.kernels), len(model.bias), len(model.out)])
    *kernels, bias, out, out_bias = np.split(flat, ends)
    shaped = [k.reshape(old.shape).astype(np.float32) for k, old in zip(kernels, model.kernels)]
    return replace(model, kernels=shaped, bias=bias.astype(np.float32), out=out.astype(np.float32), out_bias=float(out_bias[0]))


def _calibrated(rows: DataFrame, model: Model, s: Settings) -> dict[str, float]:
    """The cuts on all rows held back, from counts of their logits in steps of a thousandth."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            docs = [np.frombuffer(b, np.int32).reshape(-1, 1 + len(s.prefixes)) for b in columns(batch, "ids")[0]]
            found = np.clip(_plain_logits(shared.value, docs), -40, 40)
            languages = [guess_language(c, shared.value.markers) for c in columns(batch, "common")[0]]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(languages), pa.array(np.round(found * 1000).astype(np.int64))], names=["y", "lang", "step"])

    counted = rows.select("y", "common", "ids").mapInArrow(run, "y int, lang string, step long").groupBy("y", "lang", "step").count().toPandas()
    return _cuts(counted["step"].to_numpy() / 1000, counted["y"].to_numpy(np.float64), counted["lang"].tolist(), s, counted["count"].to_numpy())


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = Settings()) -> Model | float:
    """A model, or the share of positive labels where they don't tell two classes apart.

    A bounded sample warms the model up in the driver; then every labelled row trains it, or sets the cuts if it is
    one of those held back. Markers are learnt from all labelled rows.
    """
    s = settings
    rows = written(_labelled(documents, labels, label, s), "labelled")
    held = F.pmod("h", F.lit(1000)) < int(1000 * s.calibration)
    found = rows.groupBy("y", held.alias("held")).count().collect()
    counts = {y: sum(r["count"] for r in found if r["y"] == y) for y in (0, 1)}
    if not counts[0] or not counts[1]:
        return 1.0 if counts[1] else 0.0
    learn = rows.where(~held)
    taught = {y: sum(r["count"] for r in found if r["y"] == y and not r["held"]) for y in (0, 1)}
    drawn_rows = _drawn(learn, taught, s)
    docs = [np.frombuffer(b, np.int32).reshape(-1, 1 + len(s.prefixes)) for b in drawn_rows["ids"]]
    trainer = _warm_up(docs, drawn_rows["y"].to_numpy(dtype=np.float64), np.arange(len(docs)), s, np.random.default_rng(s.seed))
    model = _passed(learn, trainer, taught[1] / max(sum(taught.values()), 1), s)
    model.markers = _markers(rows, s)
    model.cut = _calibrated(rows.where(held), model, s)
    return model


def _scored(documents: DataFrame, model: Model | float, schema, build) -> DataFrame:
    """Apply `build(batch, scores)` to every batch. The model has a fixed number of buckets."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = None if isinstance(shared.value, float) else Scorer(shared.value)
        for batch in small_batches(batches, "text", 2 << 20):
            texts = batch.column("text").to_pylist()
            yield build(batch, scorer.scores(texts) if scorer else np.full(len(texts), shared.value))

    return documents.mapInArrow(run, schema)


def score(documents: DataFrame, model: Model | float) -> DataFrame:
    """doc_id and toxicity of every row; texts are read whole."""

    def build(batch, found):
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "toxicity"])

    return _scored(documents.select("doc_id", "text"), model, "doc_id long, toxicity double", build)


def reject_toxic(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Documents that the classifier does not call toxic, with all their columns.

    Rows are scored in place, so no join is needed and repeated ids keep their own decision.
    """
    model = fit(documents, labels, settings=settings)
    return _scored(documents, model, documents.schema, lambda batch, found: batch.filter(pa.array(found < 0.5)))
