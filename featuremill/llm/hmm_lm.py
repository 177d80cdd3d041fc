"""A hidden Markov language model, trained by Baum-Welch and scored by the scaled forward recursion.

Tokens are the A-Z lower-cased words between ASCII white space, then one end. Latent states emit word classes: each of the
``own_classes`` most frequent words is a class of its own, all other words share ``shared_classes`` classes by their last
letters, and the end is one more. A word of a shared class has the add-one share of its count in that class, so the model gives
every word a probability, and what it knows of words is the count of every word of the corpus.

Counting is one aggregation over all training texts. The most frequent words, at most ``frequent``, go to every task with their
counts; the others are joined, once per text and word. Texts are kept as class numbers in the shared folder. Each
Baum-Welch step adds up the expected counts of all training tokens: tasks run forward and backward over segments of at most
``segment`` tokens, a segment inside a text beginning with the stationary state distribution. Expected counts are summed as
integers (2**20 to one), so no order of tasks changes the model. Scoring runs the forward recursion over whole texts, many texts
at a time; it is exact.

Defined results: NULL and empty texts are one end; without training texts counts are 0 and all probabilities come from the
smoothing alone; ties in frequency go to the smaller word; rows with equal ids are separate rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremill.llm.common import byte_texts, map_texts, staged

FIXED_POINT = float(1 << 20)


@dataclass(frozen=True)
class Shape:
    """Sizes of the model; all are fixed parameters."""

    states: int = 6
    own_classes: int = 2000
    shared_classes: int = 509
    frequent: int = 200_000
    segment: int = 256
    steps: int = 4

    @property
    def end(self) -> int:
        return self.own_classes + self.shared_classes

    @property
    def classes(self) -> int:
        return self.end + 1

    def shared(self, word: bytes) -> int:
        """Class of a word that has none of its own."""
        return self.own_classes + zlib.crc32(word[-3:]) % self.shared_classes


@dataclass(frozen=True)
class Counts:
    """Counts of all words, as far as every task needs them."""

    shape: Shape
    frequent: dict[bytes, int]  # rank by word
    rank_counts: np.ndarray
    rank_classes: np.ndarray
    class_tokens: np.ndarray  # training tokens of each class
    class_words: np.ndarray  # distinct training words of each class
    tokens: int  # N
    distinct: int  # V
    ends: int


@dataclass(frozen=True)
class Hmm:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # states x classes


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of all words of a one-column frame of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

        found: Counter = Counter()
        for batch in batches:
            for text in byte_texts(batch.column(0)):
                found.update(_words(text))
                if len(found) > 500_000:
                    yield rows(found)
                    found = Counter()
        yield rows(found)

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def count_corpus(texts: DataFrame, shape: Shape) -> tuple[DataFrame, Counts]:
    """All word counts as a table, and what of them goes to every task."""
    counts = staged(word_counts(texts), "word-counts")
    ends = texts.count()
    # A fixed number of words at most, whatever the corpus: a histogram of at most 512 bins says from which count on.
    size = F.floor(F.log2("n") * 8)
    least, total = None, 0
    for r in sorted(counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        total += r.words
        if total > shape.frequent:
            break
        least = r["size"]
    top = counts.filter(F.lit(False) if least is None else size >= least).toArrow()
    ranked = sorted(zip(top.column("n").to_pylist(), top.column("word").to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    words, numbers = [w for _, w in ranked], np.array([n for n, _ in ranked], np.int64)
    classes = np.array([i if i < shape.own_classes else shape.shared(w) for i, w in enumerate(words)], np.int64)
    owners = words[: shape.own_classes]

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {w: i for i, w in enumerate(owners)}
        for batch in batches:
            at = np.array([own[w] if w in own else shape.shared(w) for w in batch.column(0).to_pylist()], np.int64)
            n = np.bincount(at, weights=batch.column(1).to_numpy(), minlength=shape.classes).astype(np.int64)
            met = np.bincount(at, minlength=shape.classes)
            used = np.flatnonzero(met)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), pa.array(met[used])], names=["class", "n", "words"])

    class_tokens, class_words = np.zeros(shape.classes, np.int64), np.zeros(shape.classes, np.int64)
    for r in counts.mapInArrow(by_class, "class long, n long, words long").groupBy("class").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect():
        class_tokens[r["class"]], class_words[r["class"]] = r["n"], r["words"]
    distinct = int(class_words.sum()) + (ends > 0)
    class_tokens[shape.end], class_words[shape.end] = ends, int(ends > 0)
    made = Counts(shape, {w: i for i, w in enumerate(words)}, numbers, classes, class_tokens, class_words, int(class_tokens.sum()), distinct, ends)
    return counts, made


_ENCODED = T.StructType([
    T.StructField("classes", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
    T.StructField("own_log", T.DoubleType()), T.StructField("shared_log", T.DoubleType()),
    T.StructField("rare", T.ArrayType(T.BinaryType())), T.StructField("rare_n", T.ArrayType(T.LongType())),
])


def encode(docs: DataFrame, counts: Counts, text_col: str, carry: list[str]) -> DataFrame:
    """Texts to class numbers, sums over frequent words, and the other words with their numbers."""
    shape = counts.shape

    def open_task():
        get, logs = counts.frequent.get, np.log10(counts.rank_counts + 1.0)
        ranks = np.append(counts.rank_classes, 0).astype(np.uint16)

        def one(text: bytes) -> tuple:
            own = _words(text)
            rank = np.fromiter([get(w, -1) for w in own], np.int64, len(own))
            classes, known = ranks[rank], rank >= 0
            other = [own[i] for i in np.flatnonzero(~known)]
            classes[~known] = [shape.shared(w) for w in other]
            log_of, alone, rare = logs[rank[known]], rank[known] < shape.own_classes, Counter(other)
            return (
                np.append(classes, np.uint16(shape.end)).tobytes(), len(own) + 1, int(known.sum()) + (counts.ends > 0),
                float(log_of[alone].sum()), float(log_of[~alone].sum()), list(rare), list(rare.values()),
            )

        def work(_: dict[str, pa.Array], texts: list[bytes]) -> list[pa.Array]:
            kinds = pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64())
            return [pa.array(c, k) for c, k in zip(zip(*map(one, texts), strict=True), kinds, strict=True)]

        return work

    return map_texts(docs, text_col, _ENCODED, open_task, carry)


class TimeMajor:
    """Sequences side by side: all first tokens, all second tokens, ..., longest sequence first."""

    def __init__(self, sequences: list[np.ndarray]) -> None:
        lengths = np.array([len(x) for x in sequences], np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        # alive[t]: sequences with more than t tokens; these are the first ones.
        self.alive = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), "left")
        self.at = np.concatenate([[0], np.cumsum(self.alive)])
        step = np.concatenate([np.arange(n) for n in lengths]) if len(lengths) else np.zeros(0, np.int64)
        self.tokens = np.empty(len(step), np.int64)
        self.tokens[self.at[step] + np.repeat(np.arange(len(lengths)), lengths)] = np.concatenate([sequences[i] for i in self.order]) if len(lengths) else []


def log_likelihoods(sequences: list[np.ndarray], model: Hmm) -> np.ndarray:
    """Natural log-probability of each class sequence by the scaled forward recursion."""
    packed, emit = TimeMajor(sequences), np.ascontiguousarray(model.emit.T)
    total = np.zeros(len(sequences))
    state = np.broadcast_to(model.start, (len(sequences), len(model.start)))
    for t, n in enumerate(packed.alive):
        state = (state[:n] if t == 0 else state[:n] @ model.move) * emit[packed.tokens[packed.at[t] : packed.at[t] + n]]
        scale = state.sum(1)
        total[:n] += np.log(scale)
        state = state / scale[:, None]
    made = np.empty(len(sequences))
    made[packed.order] = total
    return made


def expected_counts(sequences: list[np.ndarray], first: np.ndarray, model: Hmm, still: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, moves and emissions; sequences that are not ``first`` begin in ``still``."""
    packed, emit = TimeMajor(sequences), np.ascontiguousarray(model.emit.T)
    k, n_classes = model.emit.shape
    begins = np.where(first[packed.order][:, None], model.start, still)
    forward, scales = np.empty((len(packed.tokens), k)), np.empty(len(packed.tokens))
    for t, n in enumerate(packed.alive):
        here = slice(packed.at[t], packed.at[t] + n)
        state = (begins if t == 0 else forward[packed.at[t - 1] : packed.at[t - 1] + n] @ model.move) * emit[packed.tokens[here]]
        scales[here] = state.sum(1)
        forward[here] = state / scales[here, None]
    moves, gamma = np.zeros((k, k)), np.empty_like(forward)
    back = np.ones((0, k))
    for t in range(len(packed.alive) - 1, -1, -1):
        n, here = packed.alive[t], slice(packed.at[t], packed.at[t] + packed.alive[t])
        after = np.ones((n, k))
        if len(back):
            ahead = slice(packed.at[t + 1], packed.at[t + 1] + len(back))
            reach = emit[packed.tokens[ahead]] * back / scales[ahead, None]
            moves += forward[packed.at[t] : packed.at[t] + len(back)].T @ reach
            after[: len(back)] = reach @ model.move.T
        gamma[here], back = forward[here] * after, after
    starts = gamma[: len(sequences)][first[packed.order]].sum(0)
    emissions = np.stack([np.bincount(packed.tokens, weights=gamma[:, z], minlength=n_classes) for z in range(k)])
    return starts, moves * model.move, emissions


def stationary(move: np.ndarray) -> np.ndarray:
    state = np.full(len(move), 1 / len(move))
    for _ in range(200):
        state = state @ move
    return state / state.sum()


def first_model(counts: Counts, seed: int = 11) -> Hmm:
    """Class shares, tilted at random for each state."""
    shape, rng = counts.shape, np.random.default_rng(seed)
    share = (counts.class_tokens + 1.0) / (counts.class_tokens + 1.0).sum()
    emit = share * rng.uniform(0.3, 1.7, (shape.states, shape.classes))
    move = np.full((shape.states, shape.states), 0.6 / shape.states) + 0.4 * np.eye(shape.states)
    return Hmm(np.full(shape.states, 1 / shape.states), move, emit / emit.sum(1, keepdims=True))


def baum_welch_step(encoded: DataFrame, model: Hmm, counts: Counts, chunk: int = 500_000) -> Hmm:
    """One re-estimation over all rows of ``encoded`` (column ``classes``)."""
    shape, still = counts.shape, stationary(model.move)
    k = shape.states

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k + k * shape.classes, np.int64)

        def add(parts: list[np.ndarray], first: list[bool]) -> None:
            made = expected_counts(parts, np.array(first), model, still)
            total[:] += np.rint(np.concatenate([x.ravel() for x in made]) * FIXED_POINT).astype(np.int64)

        for batch in batches:
            parts, first, size = [], [], 0
            for data in batch.column(0).to_pylist():
                whole = np.frombuffer(data, np.uint16)
                for at in range(0, len(whole), shape.segment):
                    parts.append(whole[at : at + shape.segment])
                    first.append(at == 0)
                    size += len(parts[-1])
                    if size >= chunk:
                        add(parts, first)
                        parts, first, size = [], [], 0
            if parts:
                add(parts, first)
        task = TaskContext.get()
        part = pa.array([(task.partitionId() if task else 0) % 32], pa.int32())
        yield pa.RecordBatch.from_arrays([part, pa.array([total.tobytes()], pa.binary())], names=["part", "total"])

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, np.int64) for x in rows["total"]], axis=0)
        return pd.DataFrame({"part": rows["part"].iloc[:1].to_numpy(), "total": [total.tobytes()]})

    # 32 vectors of a fixed length reach the driver, whatever the number of tasks.
    sums = encoded.select("classes").mapInArrow(run, "part int, total binary").groupBy("part").applyInPandas(together, "part int, total binary").collect()
    total = sum((np.frombuffer(r.total, np.int64) for r in sums), np.zeros(k + k * k + k * shape.classes, np.int64)) / FIXED_POINT
    starts, moves, emissions = total[:k] + 1.0, total[k : k + k * k].reshape(k, k) + 1.0, total[k + k * k :].reshape(k, -1)
    share = (counts.class_tokens + 1.0) / (counts.class_tokens + 1.0).sum()
    emissions = emissions + 10.0 * share
    return Hmm(starts / starts.sum(), moves / moves.sum(1, keepdims=True), emissions / emissions.sum(1, keepdims=True))


def _class_scores(encoded: DataFrame, model: Hmm, counts: Counts, chunk: int = 1_000_000) -> DataFrame:
    """``encoded`` with ``class_score``: log10 probability of the class sequence, times that of a word of no count in each class."""
    shape = counts.shape
    share = np.zeros(shape.classes)
    shared = slice(shape.own_classes, shape.end)
    share[shared] = -np.log10(counts.class_tokens[shared] + counts.class_words[shared] + 1.0)
    carry = [c for c in encoded.columns if c != "classes"]
    schema = T.StructType([*(encoded.schema[c] for c in carry), T.StructField("class_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequences = [np.frombuffer(x, np.uint16).astype(np.int64) for x in batch.column("classes").to_pylist()]
            scores, at = [], 0
            while at < len(sequences):
                stop, size = at, 0
                while stop < len(sequences) and (stop == at or size + len(sequences[stop]) <= chunk):
                    size, stop = size + len(sequences[stop]), stop + 1
                part = sequences[at:stop]
                words = np.array([share[x].sum() for x in part])
                scores.append(log_likelihoods(part, model) / np.log(10.0) + words)
                at = stop
            made = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), made], names=schema.names)

    return encoded.mapInArrow(run, schema)


def score_documents(docs: DataFrame, training: str, id_col: str = "doc_id", text_col: str = "text", shape: Shape | None = None) -> DataFrame:
    """Scores of all rows by a model learned from the rows where the boolean column ``training`` holds.

    Returns (id, training, n_tokens, n_known, train_tokens, base_score, score), logarithms to base 10.
    """
    table, counts = count_corpus(docs.filter(F.col(training)).select(text_col), shape or Shape())
    # The row numbers are written with the rows, so they stay what they are.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(training).alias("training"), F.col(text_col).alias("text"))
    encoded = staged(encode(rows, counts, "text", ["row", "id", "training"]), "encoded")

    model = first_model(counts)
    for _ in range(counts.shape.steps if counts.ends else 0):
        model = baum_welch_step(encoded.filter("training"), model, counts)

    pairs = encoded.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("p")).select("row", F.col("p.rare").alias("word"), F.col("p.rare_n").alias("times"))
    rare = pairs.join(table, "word").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare_log"), F.sum("times").alias("rare_known"))
    scored = _class_scores(encoded.drop("rare", "rare_n"), model, counts)
    per_token, end_log = float(np.log10(counts.tokens + counts.distinct + 1.0)), float(np.log10(counts.ends + 1.0))
    shared_log = F.col("shared_log") + F.coalesce("rare_log", F.lit(0.0))
    return scored.join(rare, "row", "left").select(
        F.col("id").alias(id_col), "training", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("own_log") + shared_log + end_log - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("class_score") + shared_log).alias("score"),
    )
