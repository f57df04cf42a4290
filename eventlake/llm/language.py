"""Language identification by averaged hashed subword embeddings with a linear softmax.

A word gives its character n-grams (with marks for its ends) and itself; each is a bucket with an
embedding. A text is the mean over all its subwords, a linear layer with softmax names the language.
Both are trained by stochastic gradient descent in numpy on a bounded sample. A temperature fitted on
rows held back makes the score a probability. The score only compares the learned languages, so a
text also has a familiarity: the mean log share of its subwords among those of the language named.
Texts below a cut of either are rejected. The cuts are set on runs of words of the rows held back, for
each length in words, so that about `lost` of texts in a learned language would be rejected at every
length; without rows held back there are none.

Defined results: a null text or one without a letter is `und` with score 0 and is not accepted; with
no row to learn from every text is `und`; a null or repeated doc_id is treated like any other row.
Training reads `doc_id`, `text` and the language column, prediction reads the text only, so further
columns of any name do no harm.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import columns, letter_words, small_batches

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """Production parameters.

    About `per_language` rows with an id of each language, drawn by a hash of the id, and `rows` in
    all train the model;
    All languages are told apart; over `languages` of them is an error, as the column then holds no
    languages. Of rows that repeat an id one is drawn. Texts over `sample_words`
    are left out of that sample. Prediction has no bound. Of every row held back, at most `runs` runs of
    each of the `lengths` are scored; a cut is at least `spread` standard deviations below their mean.
    """

    buckets: int = 1 << 16
    size: int = 16
    grams: tuple[int, ...] = (2, 3, 4)
    epochs: int = 10
    rate: float = 1.0
    per_language: int = 1000
    rows: int = 6000
    languages: int = 4096
    sample_words: int = 20_000
    calibration: float = 0.2
    lost: float = 0.001
    spread: float = 4.0
    lengths: tuple[int, ...] = (1, 2, 4, 8, 16, 32, 64)
    runs: int = 8
    cached_words: int = 400_000
    seed: int = 11


def subwords(word: str, s: Settings) -> list[int]:
    marked = f"<{word}>"
    parts = [marked[i : i + n] for n in s.grams for i in range(len(marked) - n + 1)]
    return [zlib.crc32(p.encode()) % s.buckets for p in (*parts, word)]


@dataclass
class Model:
    settings: Settings
    languages: list[str]
    table: np.ndarray  # buckets x languages: embeddings times the linear layer
    bias: np.ndarray
    temperature: float
    logs: np.ndarray  # buckets x languages: log share of the bucket among the subwords of the language
    least: np.ndarray  # lengths x 2: scores and familiarities below are rejected


class Predictor:
    """Predicts batches of texts; keeps what a worker's known words add to the logits."""

    def __init__(self, model: Model):
        self.model = model
        self.sums = np.zeros((model.settings.cached_words, 2 * len(model.languages) + 1), np.float64)
        self.both = np.hstack([model.table, model.logs])
        self.rows: dict[str, int] = {}

    def _rows(self, words: list[str]) -> np.ndarray:
        known, s = self.rows, self.model.settings
        fresh = set(words).difference(known)
        if fresh:
            if len(known) + len(fresh) > s.cached_words:
                known.clear()
                fresh = set(words)
            if len(fresh) > len(self.sums):
                self.sums = np.zeros((len(fresh), self.sums.shape[1]))
            fresh = list(fresh)
            ids = [subwords(w, s) for w in fresh]
            lengths = np.array([len(i) for i in ids])
            starts = np.cumsum(lengths) - lengths
            flat = np.fromiter((b for i in ids for b in i), np.int64, int(lengths.sum()))
            new = slice(len(known), len(known) + len(fresh))
            self.sums[new, :-1] = np.add.reduceat(self.both[flat], starts, axis=0)
            self.sums[new, -1] = lengths
            known.update(zip(fresh, range(new.start, new.stop)))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, scores, and which texts are accepted."""
        names, found = [UNKNOWN] * len(texts), np.zeros((len(texts), 2))
        lengths = np.zeros(len(texts), np.int64)
        for i, name, *values, n in self.measured(texts):
            names[i], found[i], lengths[i] = name, values, n
        # a text has the cut of the longest length that is not above its own
        at = np.searchsorted(self.model.settings.lengths, lengths, side="right") - 1
        kept = (lengths > 0) & (found >= self.model.least[np.maximum(at, 0)]).all(axis=1)
        return names, found[:, 0], kept

    def measured(self, texts: list[str | None]) -> Iterator[tuple[int, str, float, float, int]]:
        """Place, language, score, familiarity and number of words of every text with a letter."""
        model, languages = self.model, len(self.model.languages)
        for i, text in enumerate(texts):
            words = letter_words(text)
            if not words:
                continue
            found = np.zeros(self.sums.shape[1])
            for start in range(0, len(words), 65_536):
                found += self.sums[self._rows(words[start : start + 65_536])].sum(axis=0)
            mean = found[:-1] / found[-1]
            p = _softmax((mean[:languages] + model.bias) / model.temperature)
            best = int(p.argmax())
            yield i, model.languages[best], p[best], mean[languages + best], len(words)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _cuts(model: Model, runs: list[str], s: Settings) -> np.ndarray:
    """The lowest score and familiarity, for every length, by the runs of words of texts in a language."""
    least, predictor = np.full((len(s.lengths), 2), -np.inf), Predictor(model)
    for k, n in enumerate(s.lengths):
        words = [r.split() for r in runs]
        parts = [" ".join(w[a : a + n]) for w in words for a in range(0, min(len(w) - n + 1, n * s.runs), n)]
        found = np.array([values for _, _, *values, _ in predictor.measured(parts)])
        if len(found):
            least[k] = np.minimum(np.quantile(found, s.lost / 2, axis=0), found.mean(axis=0) - s.spread * found.std(axis=0))
        elif k:
            least[k] = least[k - 1]
    return least


def train(
    docs: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, languages: list[str], s: Settings,
    fold: np.ndarray, runs: list[str | None],
) -> Model:
    """Fit on (distinct bucket ids, their share of the text) per document.

    Rows of the fold are held back; `runs` are words of theirs.
    """
    rng = np.random.default_rng(s.seed)
    table = rng.normal(0, 0.3, (s.buckets, s.size)).astype(np.float32)
    layer, bias = np.zeros((s.size, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    if len(set(target[~fold])) < len(set(target)):
        fold = np.zeros(len(docs), bool)  # too few rows to hold any back
    fit = np.flatnonzero(~fold)
    steps, step = s.epochs * len(fit), 0
    for _ in range(s.epochs):
        for i in rng.permutation(fit):
            rate = s.rate * (1 - step / steps)
            step += 1
            ids, share = docs[i]
            x = share @ table[ids]
            slope = _softmax(x @ layer + bias)
            slope[target[i]] -= 1
            back = layer @ slope
            layer -= rate * np.outer(x, slope)
            bias -= 0.1 * rate * slope
            table[ids] -= (rate * len(ids) ** 0.5) * share[:, None] * back
    held = np.flatnonzero(fold) if fold.any() else fit
    logits = np.array([docs[i][1] @ table[docs[i][0]] @ layer + bias for i in held])
    options = np.geomspace(0.5, 20, 60)
    rows = np.arange(len(held))
    losses = [-np.log(_softmax(logits / t)[rows, target[held]] + 1e-12).mean() for t in options]
    temperature = float(options[int(np.argmin(losses))])
    seen = np.zeros((s.buckets, len(languages)))
    for i in fit:
        seen[docs[i][0], target[i]] += docs[i][1]  # every document counts alike
    logs = np.log((seen + 1e-6) / (seen + 1e-6).sum(axis=0)).astype(np.float32)
    none = np.full((len(s.lengths), 2), -np.inf)
    model = Model(s, languages, (table @ layer).astype(np.float32), bias, temperature, logs, none)
    if fold.any():
        model.least = _cuts(model, [runs[i] for i in np.flatnonzero(fold)], s)
    return model


def fit(documents: DataFrame, lang: str = "lang", settings: Settings = Settings()) -> Model | None:
    """A model from the rows with text and language; None if there are none."""
    s = settings
    rows = documents.select("doc_id", "text", F.col(lang).cast("string").alias("y")).where("text IS NOT NULL AND y IS NOT NULL")
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().limit(s.languages + 1).collect()}
    if not counts:
        return None
    if len(counts) > s.languages:
        raise ValueError(f"over {s.languages} languages: the column does not hold languages")
    each = max(1, min(s.per_language, s.rows // len(counts)))
    share = F.create_map([F.lit(v) for y, n in counts.items() for v in (y, min(1.0, each / n))])
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
    # about `each` rows per language, `rows` in all
    chosen = rows.where(F.col("doc_id").isNotNull() & (drawn < F.coalesce(share[F.col("y")], F.lit(0.0)))).select(
        F.xxhash64("doc_id").alias("h"), "doc_id", "y", "text"
    )

    # one row per id, chosen before the shuffle: a repeated id brings one text and not all
    one = F.min(F.struct(F.xxhash64("text", "y").alias("k"), "h", "y", "text"))
    chosen = chosen.groupBy("doc_id").agg(one.alias("one")).select("one.h", "doc_id", "one.y", "one.text")
    longest = s.lengths[-1] * s.runs

    def encode(batches):
        for batch in small_batches(batches, "text", 2 << 20):
            out = []
            for h, doc_id, y, text in zip(*columns(batch, "h", "doc_id", "y", "text")):
                words = letter_words(text)
                if 0 < len(words) <= s.sample_words:
                    ids, n = np.unique([b for w in words for b in subwords(w, s)], return_counts=True)
                    held = h % 1000 < 1000 * s.calibration
                    first = h // 1000 % max(len(words) - longest + 1, 1)
                    run = " ".join(words[first : first + longest]) if held else None
                    out.append((h, doc_id, y, ids.astype(np.int32).tobytes(), (n / n.sum()).astype(np.float32).tobytes(), run))
            cols = zip(*out) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.string()))],
                names=["h", "doc_id", "y", "ids", "share", "run"],
            )

    sample = chosen.mapInArrow(encode, "h long, doc_id long, y string, ids binary, share binary, run string").toPandas()
    if not len(sample):
        return None
    sample = sample.sort_values(["h", "doc_id", "y"]).reset_index(drop=True)
    languages = sorted(set(sample["y"]))
    docs = [(np.frombuffer(i, np.int32), np.frombuffer(n, np.float32)) for i, n in zip(sample["ids"], sample["share"])]
    fold = sample["run"].notna().to_numpy()
    return train(docs, np.array([languages.index(y) for y in sample["y"]]), languages, s, fold, sample["run"].tolist())


def _predicted(documents: DataFrame, model: Model | None, schema, build) -> DataFrame:
    """Apply `build(batch, languages, scores, accepted)` to every batch. The model has a fixed number of buckets."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        predictor = Predictor(shared.value) if shared.value else None
        for batch in small_batches(batches, "text", 2 << 20):
            texts = batch.column("text").to_pylist()
            none = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            yield build(batch, *(predictor.predict(texts) if predictor else none))

    return documents.mapInArrow(run, schema)


def predict(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, and accepted: a language was named with enough confidence."""

    def build(batch, names, scores, kept):
        arrays = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(kept)]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang_pred", "score", "accepted"])

    return _predicted(documents.select("doc_id", "text"), model, "doc_id long, lang_pred string, score double, accepted boolean", build)


def reject_unknown(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Documents whose language is recognised, with all their columns."""
    model = fit(documents, settings=settings)

    def build(batch, names, scores, kept):
        return batch.filter(pa.array(kept))

    return _predicted(documents, model, documents.schema, build)
