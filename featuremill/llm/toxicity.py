"""Toxic passages as maximum-scoring segments, and document scores by extreme-value calibration.

Token scores. A word and its beginnings of three letters and more are counted in toxic and in other labelled texts. The score is
the log-odds of the longest of them that was met ``min_count`` times, under a Dirichlet prior of half a count, pulled towards 0 by
one standard error; words that were never met so are 0. Beginnings let a score reach inflected and compound words.

Passages. Each token's score less a ``drift`` makes the expected score negative; one linear scan finds all maximal
segments. The best segment of a clean text of n words has an extreme-value distribution, P(best >= x) = 1 - exp(-K n exp(-lambda x)),
whose parameters are fitted to clean labelled texts. Listed passages are expected less than ``SIGNIFICANT`` times in such a text.

Documents. The chance of the best segment, the summed evidence of all segments expected less than once, and their density go into a
logistic regression. Token scores and calibration use different labelled rows, at most ``per_class`` rows of each class, the
first in order of a hash of the id; scoring covers every row and every word.

Defined results: NULL, empty and wordless texts have no passages and the score of a text without evidence; without labelled rows of
both classes all texts have score 0; several labels of one id count as toxic if one is; rows with equal ids are separate.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import copysign, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from featuremill.llm.common import byte_texts, map_texts, staged
from featuremill.llm.decontamination import words as folded_words

SHORTEST, LONGEST = 3, 14
#: A passage is listed where fewer than so many are expected in a clean text of the same length.
SIGNIFICANT = 0.05


def words(text: bytes) -> list[bytes]:
    """Lower-case words of digits, letters and non-ASCII characters."""
    return folded_words(text if text.isascii() else text.decode().lower().encode())


def pieces(word: bytes) -> list[bytes]:
    """Beginnings of a word from short to long, then the whole word."""
    text = word.decode("utf-8", "replace")
    return [*(text[:k].encode() for k in range(SHORTEST, min(len(text), LONGEST) + 1)), word + b"$"]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    start: list[int] = []
    end: list[int] = []
    low: list[float] = []
    high: list[float] = []
    link: list[int] = []  # the nearest segment before it that begins at a lower total
    for i in np.flatnonzero(scores > 0).tolist():
        s, lo, hi = i, float(total[i]), float(total[i + 1])
        while True:
            j = len(start) - 1
            while j >= 0 and low[j] >= lo:
                j = link[j]
            if j < 0 or high[j] >= hi:
                break
            # It goes on from segment j to a higher total: they are one.
            s, lo = start[j], low[j]
            del start[j:], end[j:], low[j:], high[j:], link[j:]
        start.append(s)
        end.append(i + 1)
        low.append(lo)
        high.append(hi)
        link.append(j)
    return [(a, b, y - x) for a, b, x, y in zip(start, end, low, high, strict=True)]


@dataclass(frozen=True)
class ToxicityModel:
    scores: dict[bytes, float]
    drift: float
    decay: float  # lambda
    scale: float  # K
    weights: tuple[float, ...]  # intercept first

    def expected(self, n_words: int, score: np.ndarray) -> np.ndarray:
        """Segments of this score or more to be met in a clean text of this length."""
        return self.scale * max(n_words, 1) * np.exp(-self.decay * score)

    def evidence(self, n_words: int, found: np.ndarray) -> np.ndarray:
        """What the regression sees of a text with these segment scores."""
        if not n_words or not len(found):
            return np.zeros(3)
        expected = np.maximum(self.expected(n_words, found), 1e-26)
        least = expected.min()
        significant = expected < 1  # evidence below the level of a listed passage counts too
        return np.array([
            min(60.0, -log(-np.expm1(-least))),
            np.log1p(-np.log(expected[significant]).sum()),
            min(10.0, 100.0 * float(found[significant].sum()) / (n_words + 20.0)) ** 0.5,
        ])

    def probability(self, evidence: np.ndarray) -> float:
        z = self.weights[0] + float(np.dot(self.weights[1:], evidence))
        return 0.0 if z <= -500 else float(1 / (1 + np.exp(-min(z, 500.0))))


class Scorer:
    """Token scores inside one task."""

    def __init__(self, model: ToxicityModel, limit: int = 400_000) -> None:
        self.model, self.limit = model, limit
        self.memo: dict[bytes, float] = {}

    def _score(self, word: bytes) -> float:
        return next((s for p in reversed(pieces(word)) if (s := self.model.scores.get(p)) is not None), 0.0)

    def segments(self, text: bytes) -> tuple[int, list[tuple[int, int, float]]]:
        own, memo = words(text), self.memo
        for w in {x for x in own if x not in memo}:
            memo[w] = self._score(w)
        scores = np.fromiter(map(memo.__getitem__, own), np.float64, len(own)) - self.model.drift
        if len(memo) > self.limit:
            memo.clear()
        return len(own), segments(scores)


def token_scores(counts: Iterator[tuple[bytes, int, int]], toxic: int, other: int, min_count: int) -> dict[bytes, float]:
    """(piece, count in toxic texts, count in others) to scores; pieces that say what a shorter one says are left out."""
    made = {}
    for piece, t, c in counts:
        if t + c >= min_count:
            odds = log((t + 0.5) / (toxic + 0.5)) - log((c + 0.5) / (other + 0.5))
            made[piece] = copysign(max(0.0, abs(odds) - sqrt(1 / (t + 0.5) + 1 / (c + 0.5))), odds)
    kept = {}
    for piece, score in made.items():
        whole = piece.endswith(b"$")
        before = [p for p in pieces(piece[:-1] if whole else piece)[:-1] if whole or p != piece]
        shorter = next((made[p] for p in reversed(before) if p in made), 0.0)
        if score != shorter:
            kept[piece] = score
    return kept


def extreme_value(best: np.ndarray, n_words: np.ndarray) -> tuple[float, float]:
    """Likeliest (lambda, K) of best segment scores of clean texts."""
    if not len(best):
        return 1.0, 1.0
    grid, size = np.linspace(0.05, 4.0, 400), len(best)
    scale = np.array([size / max(1e-300, (n_words * np.exp(-d * best)).sum()) for d in grid])
    fit = size * np.log(scale) + size * np.log(grid) - grid * best.sum()
    top = int(np.argmax(fit))
    return float(grid[top]), float(scale[top])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 30) -> tuple[float, ...]:
    """Weights of a ridge-regularised logistic regression, intercept first."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty @ w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _labelled(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """Texts of a bounded sample (toxic, fold, text), and the number of labelled ids of each class."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("id").isNotNull()).groupBy("id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64("id", F.lit(17)), F.col("id")
    parts = [known.filter(F.col("toxic") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    # At most twice ``per_class`` short rows: small enough to send to all tasks.
    sample = parts[0].unionByName(parts[1]).withColumn("fold", F.pmod(F.xxhash64("id", F.lit(23)), F.lit(4)).cast("int"))
    return docs.join(F.broadcast(sample), "id").select("toxic", "fold", "text"), sizes


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", per_class: int = 10_000,
    min_count: int = 10, drift: float = 0.5,
) -> ToxicityModel:
    """Fit to the texts of labelled rows, at most ``per_class`` of each class."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample, sizes = _labelled(texts, labels.select(F.col(id_col).alias("id"), F.col(toxic_col).alias("toxic")), per_class)
    sample = staged(sample, "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: tuple[Counter, Counter]) -> pa.RecordBatch:
            keys = [*(found[0].keys() | found[1].keys())]
            columns = [pa.array(keys, pa.binary()), *(pa.array([f[k] for k in keys], pa.int64()) for f in reversed(found))]
            return pa.RecordBatch.from_arrays(columns, names=["piece", "t", "c"])

        found = Counter(), Counter()
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                for word, n in Counter(words(text)).items():
                    found[toxic][b"$"] += n
                    for piece in pieces(word):
                        found[toxic][piece] += n
                if len(found[0]) + len(found[1]) > 500_000:
                    yield rows(found)
                    found = Counter(), Counter()
        yield rows(found)

    counted = (
        sample.filter("fold > 0").select("toxic", "text").mapInArrow(count, "piece binary, t long, c long")
        .groupBy("piece").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).filter(F.col("t") + F.col("c") >= min_count)
    ).toArrow()
    piece, t, c = (counted.column(x).to_pylist() for x in ("piece", "t", "c"))
    at = piece.index(b"$") if b"$" in piece else -1
    toxic, other = (t[at], c[at]) if at >= 0 else (0, 0)
    if not toxic or not other:
        return ToxicityModel({}, drift, 1.0, 1.0, (-500.0, 0.0, 0.0, 0.0))
    first = ToxicityModel(token_scores((x for x in zip(piece, t, c, strict=True) if x[0] != b"$"), toxic, other, min_count), drift, 1.0, 1.0, (0.0,) * 4)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(first)
        for batch in batches:
            n, found = zip(*map(scorer.segments, byte_texts(batch.column(1))), strict=True) if batch.num_rows else ((), ())
            scores = pa.array([[x[2] for x in f] for f in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), scores], names=["toxic", "n", "found"])

    held = sample.filter("fold = 0").select("toxic", "text").mapInArrow(score, "toxic int, n long, found array<double>").toArrow()
    label, n = np.array(held.column("toxic").to_pylist(), np.int64), np.array(held.column("n").to_pylist(), np.int64)
    found = [np.array(x, np.float64) for x in held.column("found").to_pylist()]
    order = np.lexsort((np.array([x.sum() for x in found]), n, label))  # sums do not depend on the order of tasks
    label, n, found = label[order], n[order], [found[i] for i in order]
    clean = np.flatnonzero((label == 0) & (n > 0))
    decay, scale = extreme_value(np.array([found[i].max(initial=0.0) for i in clean]), n[clean])
    model = ToxicityModel(first.scores, drift, decay, scale, (0.0,) * 4)
    if not len(label) or not 0 < label.sum() < len(label):
        return ToxicityModel(first.scores, drift, decay, scale, (-3.0, 0.5, 0.5, 0.5))
    seen = np.array([model.evidence(int(k), f) for k, f in zip(n, found, strict=True)])
    # The sample holds more toxic texts than the labels do.
    share = [sizes[k] / max(1, int((label == k).sum())) for k in (0, 1)]
    weight = np.where(label == 1, share[1], share[0])
    return ToxicityModel(first.scores, drift, decay, scale, logistic(seen, label.astype(float), weight * len(label) / weight.sum()))


PASSAGE = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType()),
]))


def score_documents(
    docs: DataFrame, model: ToxicityModel, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), passages: bool = True
) -> DataFrame:
    """``carry`` columns with ``score`` and, with ``passages``, every significant passage as a word interval."""
    fields = [T.StructField("score", T.DoubleType()), *([T.StructField("passages", PASSAGE)] if passages else [])]

    def open_task():
        scorer = Scorer(model)

        def work(columns: dict[str, pa.Array], texts: list[bytes]) -> list[pa.Array]:
            chances, ends, flat = [], [0], ([], [], [], [])
            for text in texts:
                n, found = scorer.segments(text)
                values = np.array([x[2] for x in found])
                chances.append(model.probability(model.evidence(n, values)))
                if passages and found:
                    expected = model.expected(n, values)
                    for i in np.flatnonzero(expected < SIGNIFICANT):
                        for column, value in zip(flat, (*found[i], float(expected[i])), strict=True):
                            column.append(value)
                ends.append(len(flat[0]))
            made = [pa.array(chances, pa.float64())]
            if passages:
                kind = to_arrow_type(PASSAGE)
                parts = [pa.array(column, field.type) for column, field in zip(flat, kind.value_type, strict=True)]
                made.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(kind.value_type))))
            return made

        return work

    return map_texts(docs, text_col, T.StructType(fields), open_task, list(carry))

