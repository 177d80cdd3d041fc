"""Periodic runs of words: recursive frequency splitting, then a scan over lags.

Words are stretches without ASCII white space, compared as bytes. A run is a stretch of words with smallest period q (words q
apart are the same) and a length of at least max(``min_words``, ``repeats`` * q) that no neighbouring word extends.

Splitting. Every word of a run occurs at least ``repeats`` times inside it, so a word that occurs less often inside the
current segment lies in no run: it splits the segment. Segments that became too short go, changed ones are counted anew, until
none changes. All texts of a slice are split together, as one array of word numbers.

Lag scan. What survives is tested at every lag p up to a ``repeats``-th of the segment: a run of period p holds one of evenly
spaced checkpoints whose block equals the block p words later, found by sums of word hashes. From there the run is extended
to both sides by binary search on the same sums, and then compared word by word, so that a chance agreement of hashes can
neither make nor hide a run. A segment of m words has about m log m checkpoints, whatever it holds; they are taken in
portions, so memory stays bounded.

Defined results: NULL and empty texts have no words and no runs; rows with equal ids are separate rows; texts that are not
UTF-8 are compared as the bytes they are.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from featuremill.llm.common import map_texts

#: Bytes of text whose words are numbered together, and checkpoints that are compared together.
SLICE_BYTES, PORTION = 4 << 20, 1 << 20
_GOLD, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)

RUN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])
RUNS = T.ArrayType(RUN)


def frequent_segments(codes: np.ndarray, breaks: np.ndarray, min_words: int, repeats: int) -> list[tuple[int, int]]:
    """Segments [a, b) of ``codes`` in which every word occurs ``repeats`` times or more; ``breaks`` are ends of texts."""
    at = np.arange(len(codes), dtype=np.int64)
    # One free place behind each text keeps neighbours of different texts apart.
    shift = np.searchsorted(breaks, at, "right")
    stable: list[tuple[int, int]] = []
    changed = np.ones(len(at), bool)
    while len(at):
        place = at + shift[at]
        first = np.flatnonzero(np.concatenate([[True], np.diff(place) != 1]))
        sizes = np.diff(np.append(first, len(at)))
        touched = np.logical_or.reduceat(changed, first)
        stable += [(int(at[f]), int(at[f]) + int(n)) for f, n in zip(first[~touched & (sizes >= min_words)], sizes[~touched & (sizes >= min_words)], strict=True)]
        keep = np.repeat(touched & (sizes >= min_words), sizes)
        segment = np.repeat(np.arange(len(first)), sizes)[keep]
        at = at[keep]
        if not len(at):
            break
        _, which, counts = np.unique(segment * np.int64(codes.max() + 1) + codes[at], return_inverse=True, return_counts=True)
        rare = counts[which.ravel()] < repeats
        # A segment that loses a word has to be counted again.
        changed = np.bincount(segment, weights=rare)[segment] > 0
        at, changed = at[~rare], changed[~rare]
    return sorted(stable)


class LagScan:
    """Runs of one segment."""

    def __init__(self, words: np.ndarray, min_words: int, repeats: int) -> None:
        self.words, self.min_words, self.repeats = words, min_words, repeats
        n = len(words)
        with np.errstate(over="ignore"):
            mixed = (words.astype(np.uint64) + np.uint64(1)) * _GOLD
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * self.powers[:n], dtype=np.uint64)])

    def _same(self, at: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ``size`` words from ``at`` have the sum of those ``lag`` later."""
        with np.errstate(over="ignore"):
            return self.sums[at + lag + size] - self.sums[at + lag] == (self.sums[at + size] - self.sums[at]) * self.powers[lag]

    def _longest(self, limit: np.ndarray, test) -> np.ndarray:
        """Of each: the largest size up to ``limit`` that ``test`` accepts, where it accepts all smaller ones."""
        low, high = np.zeros(len(limit), np.int64), limit.astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            good = test(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) by start, then period."""
        n, found = len(self.words), {}
        lags = np.arange(1, n // self.repeats + 1, dtype=np.int64)
        least = np.maximum(self.min_words, self.repeats * lags)
        lags, least = lags[least <= n], least[least <= n]
        # A run of the least length holds a checkpoint with its block and the block one lag later.
        step = np.maximum(1, (least - lags) // 2)
        block = least - lags - step + 1
        counts = (n - lags - block) // step + 1
        ends = np.cumsum(counts)
        a = 0
        while a < len(lags):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PORTION, "right")))
            which = np.repeat(np.arange(a, b), counts[a:b])
            at = (np.arange(len(which)) - np.repeat(ends[a:b] - counts[a:b] - (ends[a - 1] if a else 0), counts[a:b])) * step[which]
            hit = self._same(at, lags[which], block[which])
            at, lag, size = at[hit], lags[which[hit]], least[which[hit]]
            if len(at):
                right = self._longest(n - lag - at, lambda x, at=at, lag=lag: self._same(at, lag, x))
                left = self._longest(at, lambda x, at=at, lag=lag: self._same(at - x, lag, x))
                long_ = left + right + lag >= size
                for start, end, p in np.unique(np.stack([at - left, at + lag + right, lag])[:, long_], axis=1).T.tolist():
                    self._take(found, start, end, p)
            a = b
        return sorted((start, end - start, p) for (start, end), p in found.items())

    def _take(self, found: dict[tuple[int, int], int], start: int, end: int, p: int) -> None:
        """Enter a stretch under its smallest period, if its words bear it out; else what the words themselves say."""
        if found.get((start, end), p + 1) <= p:
            return
        w = self.words
        if np.array_equal(w[start : end - p], w[start + p : end]):
            found[start, end] = p
            return
        same = np.concatenate([[False], w[:-p] == w[p:], [False]])
        edges = np.flatnonzero(np.diff(same.astype(np.int8)))
        for s, e in zip(edges[::2].tolist(), (edges[1::2] + p).tolist(), strict=True):
            if e - s >= max(self.min_words, self.repeats * p):
                found[s, e] = min(p, found.get((s, e), p))


def runs_of(texts: list[list[bytes]], min_words: int, repeats: int) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text, given as its words."""
    numbers: dict[bytes, int] = {}
    ends = np.cumsum([0, *map(len, texts)])
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in chain.from_iterable(texts)), np.int64, int(ends[-1]))
    made: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in frequent_segments(codes, ends[1:], min_words, repeats):
        text = int(np.searchsorted(ends, a, "right")) - 1
        made[text] += [(a - int(ends[text]) + s, n, p) for s, n, p in LagScan(codes[a:b], min_words, repeats).runs()]
    return made


def kept_words(own: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats: of each run its first period stays."""
    if not runs:
        return own
    keep = np.ones(len(own), bool)
    for start, n, p in runs:
        keep[start + p : start + n] = False
    return [own[i] for i in np.flatnonzero(keep)]


def _slices(texts: list[bytes]):
    """Texts together up to about ``SLICE_BYTES``, each as its words."""
    part, size = [], 0
    for text in texts:
        part.append(text.split())  # without an argument: at ASCII white space
        size += len(text)
        if size >= SLICE_BYTES:
            yield part
            part, size = [], 0
    yield part


def find_runs(
    docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, min_words: int = 24, repeats: int = 3, collapsed: str = "text",
) -> DataFrame:
    """``carry`` (all columns) with ``n_words``, ``runs`` by start and period, and the collapsed text.

    ``collapsed`` is ``text`` (column ``collapsed``: the kept words joined by one space), ``digest`` (``collapsed_sha256``) or
    ``none``. Columns of these names are replaced.
    """
    if repeats < 2:
        raise ValueError("a run repeats its period at least once")
    extra = {"text": [T.StructField("collapsed", T.StringType())], "digest": [T.StructField("collapsed_sha256", T.StringType())], "none": []}[collapsed]
    fields = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), *extra])

    def open_task():
        def work(columns: dict[str, pa.Array], texts: list[bytes]) -> list[pa.Array]:
            sizes, runs, short = [], [], []
            for part in _slices(texts):
                found = runs_of(part, min_words, repeats)
                sizes += map(len, part)
                runs += [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in found]
                if collapsed != "none":
                    kept = [b" ".join(kept_words(own, rs)) for own, rs in zip(part, found, strict=True)]
                    short += [hashlib.sha256(x).hexdigest() if collapsed == "digest" else x.decode("utf-8", "replace") for x in kept]
            made = [pa.array(sizes, pa.int64()), pa.array(runs, to_arrow_type(RUNS))]
            return [*made, pa.array(short, pa.string())] if extra else made

        return work

    return map_texts(docs, text_col, fields, open_task, docs.columns if carry is None else carry)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties by smallest start, then period. NULL if none."""

    def better(best: Column, x: Column) -> Column:
        ahead = x["length"] * best["period"] - best["length"] * x["period"]
        return F.when(best.isNull() | (ahead > 0), x).otherwise(best)

    # The runs are in order of start and period, so the first of equals stays.
    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def runs_text(runs: Column) -> Column:
    """A line ``start,length,period`` for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
