"""Log-likelihood of whole documents under a gated recurrent language model.

Everything counted comes from all training documents: the token counts, the frequent words that the
network knows one by one, and, for all other words, their class (by a hash of the last two bytes) and
their share of it. The network starts from these shares, is warmed up on a bounded sample, and then
every partition goes on training on all its training documents (one in `every`); the results are
averaged, weighted by tokens, over a tree of executors. So what training reads grows with the corpus.

Scoring adds to the network's log probabilities those of each other word within its class. Counts of
the `known` most frequent tokens at most travel with the tasks; the counts of all rarer ones are
joined by a shuffle, in which no training token is frequent by construction.

Tokens are runs of other than ASCII white space, A-Z lower-cased, and an end; a word never seen in
training has the share of one more word with count 0 in its class.

Defined results: a null or empty text is one end; rows with a null doc_id are training rows; null or
repeated doc_ids are scored row by row; without training text all counts are 0. Only `doc_id` and
`text` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import blocks, drawn, small_batches, written
from eventlake.llm.recurrent import Layout, Network, Scorer, Trainer, start

END = b""


@dataclass(frozen=True)
class Settings:
    """Production parameters; `warm_documents` bounds the sample of the warm-up."""

    words: int = 2000
    word_classes: int = 24
    tails: int = 24
    hidden: int = 24
    known: int = 262_144
    warm_documents: int = 1500
    warm_bytes: int = 100_000
    every: int = 1
    train_lanes: int = 256
    train_window: int = 16
    train_stretch: int = 512
    rate: float = 0.12
    lanes: int = 256
    window: int = 64
    held_words: int = 250_000
    seed: int = 5


class _Known(dict):
    def __missing__(self, token: bytes) -> int:
        return -1


@dataclass
class Model:
    settings: Settings
    network: Network
    tokens: int  # in training
    distinct: int
    rows: _Known  # known tokens
    symbols: np.ndarray  # per known token
    counts: np.ndarray
    tail_logs: np.ndarray  # per tail class: log10 of what divides count + 1
    trained: int = 0  # tokens that the network learnt from after the warm-up


def tokens(text: str | None) -> Iterator[list[bytes]]:
    """Tokens of a text in blocks, the end included."""
    parts = [b.lower().split() for b in blocks((text or "").encode())]
    parts[-1].append(END)
    return iter(parts)


def _tail(token: bytes, tails: int) -> int:
    return zlib.crc32(token[-2:]) % tails


def _tails(words: pa.Array, tails: int) -> np.ndarray:
    """The same of every word; words share few endings."""
    ends = pc.binary_slice(words.cast(pa.binary()), -2).dictionary_encode()
    found = np.fromiter((_tail(e, tails) for e in ends.dictionary.to_pylist()), np.int64, len(ends.dictionary))
    return found[ends.indices.to_numpy()]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The tokens of all texts but their ends, the text of each, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = split.flatten()
    real = pc.not_equal(flat, "")  # what stands before, behind or instead of all words
    owner = np.repeat(np.arange(len(texts)), split.value_lengths().to_numpy())[real.to_numpy(zero_copy_only=False)]
    return flat.filter(real), owner, np.bincount(owner, minlength=len(texts))


def token_counts(documents: DataFrame, held_words: int) -> DataFrame:
    """token (the end is empty) and c, over all rows; counted per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            coded = pa.concat_arrays([w for w, _ in held]).dictionary_encode()
            sums = np.bincount(coded.indices.to_numpy(), np.concatenate([c for _, c in held]), len(coded.dictionary))
            return pa.RecordBatch.from_arrays([coded.dictionary, pa.array(sums.astype(np.int64))], names=["token", "n"])

        for batch in small_batches(batches, "text"):
            words, _, _ = _words(batch.column("text"))
            found = words.value_counts()
            ends = pa.array([END.decode()])
            held += [(found.field("values"), found.field("counts").to_numpy()), (ends, np.array([batch.num_rows]))]
            if sum(len(w) for w, _ in held) > held_words:
                yield flush()
                held.clear()
        if held:
            yield flush()

    return documents.select("text").mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("c"))


def _head_layout(known: list[tuple[bytes, int]], s: Settings) -> tuple[list[bytes], Layout]:
    """The frequent words in order of frequency, cut into classes of equal sums of square roots."""
    words = [w for w, _ in known[: s.words]]
    if END not in words:
        words = [*words[: s.words - 1], END]
    counts = dict(known)
    mass = np.cumsum([max(counts.get(w, 0), 1) ** 0.5 for w in words])
    cuts = np.unique(np.searchsorted(mass, np.arange(s.word_classes) * mass[-1] / s.word_classes))
    return words, Layout(len(words), cuts, s.tails, words.index(END))


def fit(
    documents: DataFrame, learn: Column, settings: Settings = Settings(), symbols_of: Callable[[Model], DataFrame] | None = None
) -> tuple[Model, DataFrame]:
    """The model, and the written table of all token counts.

    `symbols_of` gives the `encoded` documents for a model, where they are used for more than training.
    """
    s, spark = settings, documents.sparkSession
    training = documents.select("doc_id", "text", learn.alias("learn")).where("learn")
    counts = written(token_counts(training, s.held_words), "token_counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    # the smallest count at which no more than `known` tokens are taken, by eighths of powers of two
    octave = F.floor(F.log2("c") * 8)
    steps = counts.groupBy(octave.alias("octave")).count().orderBy(F.desc("octave")).collect()  # a few hundred
    held, least = 0, None
    for row in steps:
        held += row["count"]
        if held > s.known:
            break
        least = row["octave"]
    # at most `known` rows
    rows = counts.where(octave >= least if least is not None else F.lit(False)).toPandas()
    known = sorted(zip((t.encode() for t in rows["token"]), rows["c"].tolist()), key=lambda t: (-t[1], t[0]))
    words, layout = _head_layout(known, s)

    symbol = {w: i for i, w in enumerate(words)}
    names = [w for w, _ in known] + [w for w in words if w == END and not any(k == END for k, _ in known[: s.words])]
    names = list(dict.fromkeys(names))
    of_known = dict(known)
    symbols = np.array([symbol.get(w, -1) if w in symbol else len(words) + _tail(w, s.tails) for w in names])
    known_counts = np.array([of_known.get(w, 0) for w in names], np.int64)
    # tail classes over all tokens but the frequent words
    bytes_ = F.col("token").cast("binary")
    last_two = F.when(F.length(bytes_) > 2, F.substring(bytes_, -2, 2)).otherwise(bytes_)
    tail_rows = counts.groupBy((F.crc32(last_two) % s.tails).alias("tail")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    tail_n, tail_v = np.zeros(s.tails), np.zeros(s.tails)
    for r in tail_rows:
        tail_n[r["tail"]], tail_v[r["tail"]] = r["n"], r["v"]
    for w in words:
        if of_known.get(w, 0):
            tail_n[_tail(w, s.tails)] -= of_known[w]
            tail_v[_tail(w, s.tails)] -= 1
    shares = np.concatenate([[of_known.get(w, 0) for w in words], tail_n])
    model = Model(
        s, start(layout, shares, s.hidden, s.seed), int(total["n"]), int(total["v"]),
        _Known(zip(names, range(len(names)))), symbols, known_counts, np.log10(tail_n + tail_v + 1),
    )
    if model.tokens:
        model.network = _warm(training, model, of_known.get(END, 0))
        model.network, model.trained = _averaged(encoded(training, model, F.lit(True)) if symbols_of is None else symbols_of(model), model)
    return model, counts


def fit_and_score(documents: DataFrame, learn: Column, *keep: Column, settings: Settings = Settings()) -> tuple[Model, DataFrame]:
    """The model of the documents that `learn` names, and the scores of all; texts are read and encoded once."""
    tables = []

    def symbols_of(model: Model) -> DataFrame:
        tables.append(encoded(documents, model, learn, *keep))
        return tables[0]

    model, counts = fit(documents, learn, settings, symbols_of)
    rows = tables[0] if tables else encoded(documents, model, learn, *keep)
    return model, scored(rows, model, counts)


class _Reader:
    """Texts as symbols."""
    def __init__(self, model: Model):
        self.model = model
        self.known = model.rows
        self.tails, self.words = model.settings.tails, model.network.layout.words

    def rows(self, part: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, part), np.int64, len(part))

    def symbols(self, part: list[bytes], rows: np.ndarray) -> np.ndarray:
        if not len(self.model.symbols):
            return np.array([self.words + _tail(w, self.tails) for w in part])
        found = self.model.symbols[rows]
        for i in np.flatnonzero(rows < 0):
            found[i] = self.words + _tail(part[i], self.tails)
        return found

    def text(self, text: str | None) -> np.ndarray:
        return np.concatenate([self.symbols(p, self.rows(p)) for p in tokens(text)])


def _warm(training: DataFrame, model: Model, total: int) -> Network:
    """One pass over a bounded sample of the `total` training documents."""
    s = model.settings
    sample = training.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= s.warm_bytes)
    texts = [r["text"] for r in drawn(sample, "doc_id", s.warm_documents, total).collect()]
    reader, trainer = _Reader(model), Trainer(model.network.copy(), s.train_lanes, s.train_window, s.rate, s.train_stretch)
    order = np.random.default_rng(s.seed).permutation(len(texts))
    for at in range(0, len(order), 300):
        trainer.feed([reader.text(texts[i]) for i in order[at : at + 300]])
    trainer.feed([], last=True)
    return trainer.net


def _averaged(rows: DataFrame, model: Model) -> tuple[Network, int]:
    """Every partition trains on from the warm network; the mean of all, weighted by their tokens, and these."""
    s, spark = model.settings, rows.sparkSession
    shared = spark.sparkContext.broadcast(model.network)
    chosen = rows.where("learn").where(F.pmod(F.xxhash64("row", F.lit("train")), F.lit(s.every)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(shared.value.copy(), s.train_lanes, s.train_window, s.rate * 0.5, s.train_stretch)
        for batch in batches:
            for part in _parts(batch, "symbols", shared.value.layout, 500_000):
                trainer.feed(part)
        trainer.feed([], last=True)
        values = trainer.net.flat().astype("<f4").tobytes() if trainer.tokens else b""
        yield pa.RecordBatch.from_arrays([pa.array([values], pa.binary()), pa.array([trainer.tokens], pa.int64())], names=["values", "n"])

    trained = chosen.select("symbols").mapInArrow(run, "values binary, n long").where("n > 0")

    def weighted(row) -> tuple:
        return np.frombuffer(row["values"], "<f4").astype(np.float64) * row["n"], row["n"]

    # a network per task: added up over a tree of executors, so that few reach the driver
    pairs = trained.rdd.map(weighted)
    zero = (0.0, 0)
    values, n = pairs.treeAggregate(zero, lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda a, b: (a[0] + b[0], a[1] + b[1]), depth=3)
    return (model.network.with_flat(values / n) if n else model.network), n


def _packed(symbols: np.ndarray, ends: np.ndarray, layout: Layout) -> pa.Array:
    """The symbols of all texts as a binary column, in as few bytes a symbol as their number needs."""
    own = symbols.astype(np.min_scalar_type(layout.symbols))
    offsets = np.concatenate([[0], ends * own.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(own)])


def _parts(batch: pa.RecordBatch, name: str, layout: Layout, most: int) -> Iterator[list[np.ndarray]]:
    """The texts of a packed column as arrays, some at a time: about `most` symbols, or one text."""
    column, kind = batch.column(batch.schema.get_field_index(name)), np.min_scalar_type(layout.symbols)
    if not len(column):
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4) // kind.itemsize
    flat = np.frombuffer(data, kind, ends[-1])
    place = (ends[1:] - ends[0]) // most
    cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(column)]
    for start, stop in zip(cuts, cuts[1:]):
        yield [flat[ends[i] : ends[i + 1]] for i in range(start, stop)]


FOUND = ("n_tokens", "n_known", "all_logs", "score_logs", "rare")


def encoded(documents: DataFrame, model: Model, learn: Column, *keep: Column) -> DataFrame:
    """A written table of all rows: doc_id, columns to keep, learn, the symbols of the text, and what no network
    is needed for: n_tokens, n_known, sums of logs, and the tokens whose counts are to be looked up."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)
    plain = documents.select("doc_id", *keep, F.coalesce(learn, F.lit(False)).alias("learn"), "text")
    kept = [f for f in plain.schema.fields if f.name != "text"]
    arrow = "row long, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema = f"{arrow}, n_tokens long, n_known long, all_logs double, score_logs double, rare array<string>, symbols binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        words = m.network.layout.words
        known_words = pa.array(list(m.rows), pa.binary())
        symbols_known = np.append(m.symbols, -1)  # the last for tokens that are not among the known
        counts = np.append(m.counts, 0)
        logs, tail_logs = np.log10(counts + 1.0), np.append(np.zeros(words), m.tail_logs)
        end_row = m.rows[END]
        number = TaskContext.get().partitionId() << 33
        for batch in small_batches(batches, "text"):
            flat, owner, sizes = _words(batch.column(batch.schema.get_field_index("text")))
            coded = flat.dictionary_encode()
            # every distinct word is looked up once
            rows = pc.fill_null(pc.index_in(coded.dictionary.cast(pa.binary()), known_words), -1).to_numpy()
            symbols = symbols_known[rows].astype(np.int32)
            unknown = np.flatnonzero(rows < 0)
            symbols[unknown] = words + _tails(coded.dictionary.take(pa.array(unknown)), m.settings.tails)
            word = coded.indices.to_numpy()
            texts = batch.num_rows

            def summed(of_word: np.ndarray) -> np.ndarray:
                """Sums over the words of each text, from a number for every distinct word."""
                return np.bincount(owner, of_word[word], texts).astype(np.float64)  # of no words at all it would be whole numbers

            n = sizes + 1
            known = summed(counts[rows] > 0).astype(np.int64) + int(counts[end_row] > 0)
            all_logs = summed(logs[rows]) + logs[end_row]
            score_logs = summed(np.where(symbols >= words, logs[rows] - tail_logs[symbols], 0.0))
            ends = np.cumsum(n)
            whole = np.full(int(ends[-1]), m.network.layout.end, np.int32)
            whole[np.arange(len(word)) + owner] = symbols[word]
            rare = (rows < 0)[word]
            rare_ends = np.cumsum(np.bincount(owner[rare], minlength=texts))
            rare_words = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], rare_ends]), pa.int32()), coded.dictionary.take(pa.array(word[rare]))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(number, number + texts)), *(batch.column(batch.schema.get_field_index(f.name)) for f in kept),
                    pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(all_logs), pa.array(score_logs), rare_words,
                    _packed(whole, ends, m.network.layout),
                ],
                names=["row", *(f.name for f in kept), *FOUND, "symbols"],
            )
            number += texts

    return written(plain.mapInArrow(run, schema), "symbols")


def score(documents: DataFrame, model: Model, counts: DataFrame, *keep: Column) -> DataFrame:
    """doc_id, columns to keep, n_tokens, n_known, base_score and score of every row."""
    return scored(encoded(documents, model, F.lit(False), *keep), model, counts)


def scored(rows: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """The scores of rows that are `encoded`."""
    s, spark = model.settings, rows.sparkSession
    shared = spark.sparkContext.broadcast(model.network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value, s.lanes, s.window)
        waiting: dict[int, int] = {}  # rows by their number in this task
        count = 0

        def finished(done: list[tuple[int, float]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([waiting.pop(i) for i, _ in done], pa.int64()), pa.array([log for _, log in done], pa.float64())],
                names=["row", "network_log"],
            )

        for batch in batches:
            numbers = iter(batch.column(0).to_pylist())
            for part in _parts(batch, "symbols", shared.value.layout, 500_000):
                own = range(count, count + len(part))
                waiting.update(zip(own, numbers))
                count += len(part)
                yield finished(scorer.feed(list(zip(own, part))))
        yield finished(scorer.feed([], last=True))

    judged = rows.select("row", "symbols").mapInArrow(run, "row long, network_log double")
    logs = F.log10(F.col("c") + 1.0)
    rare = rows.select("row", F.explode("rare").alias("token")).join(counts, "token").groupBy("row").agg(
        F.sum(logs).alias("rare_logs"), F.count("*").alias("rare_known")
    )
    divided = float(np.log10(model.tokens + model.distinct + 1))
    more = F.coalesce("rare_logs", F.lit(0.0))
    kept = [c for c in rows.columns if c not in ("row", "learn", "rare", "symbols", "all_logs", "score_logs", "n_tokens", "n_known")]
    known = rows.select("row", *kept, "n_tokens", "n_known", "all_logs", "score_logs")
    return known.join(judged, "row").join(rare, "row", "left").select(
        *kept, "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (F.col("all_logs") + more - F.col("n_tokens") * divided).alias("base_score"),
        (F.col("score_logs") + F.col("network_log") / float(np.log(10)) + more).alias("score"),
    )
