"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is bound by rotating the vector of its letter i by n-1-i places and
multiplying the rotated vectors; a text is the sum (bundle) of the vectors of its n-grams, and a language the sum over its
training texts. A document gets the language whose prototype has the largest cosine with the document's bundle.

Texts are lower-cased; every run of other characters is one blank, also at both ends. Letter vectors are drawn from a seed
and the letter's code point, so no letter table is kept. Prototypes are sums of integers: they do not depend on the order or
number of tasks. A task sends one vector per language; these are added in two steps, so that neither a task nor the driver
meets all of them. The driver holds one vector per language, at most ``max_languages``.

Defined results: ``und`` and score 0 for NULL text, text without a letter, or where no language could be learned; ties go to the
first language in order; rows with equal ids are separate rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremill.llm.common import byte_texts, map_texts

TABLE_CELLS = 1 << 24


@dataclass(frozen=True)
class Profile:
    """Languages and their prototypes, one row each."""

    languages: list[str]
    prototypes: np.ndarray
    n: int
    seed: int


class Bundler:
    """Texts to bundles, inside one task."""

    def __init__(self, dimensions: int, n: int, seed: int) -> None:
        self.dimensions, self.n, self.seed = dimensions, n, seed
        self.is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        self.letters: dict[int, np.ndarray] = {}

    def letter(self, code: int) -> np.ndarray:
        """Vector of a letter; code 0 is the blank."""
        if code not in self.letters:
            if len(self.letters) > 20_000:
                self.letters.clear()
            self.letters[code] = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions, np.int8) * np.int8(2) - np.int8(1)
        return self.letters[code]

    def grams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct n-grams (rows of code points), the n-gram number at each place, and the text of each place."""
        lowered = [x.lower() for x in texts]
        codes = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le", "replace"), np.uint32)
        codes = np.where(self.is_letter[codes], codes, 0)
        ends = np.cumsum([len(x) + 1 for x in lowered])  # place of the blank behind each text
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        # A text without letters still ends: its blank may be dropped, its place in the order may not.
        owner = np.searchsorted(ends, np.flatnonzero(keep) - 1, "right")
        codes = codes[keep]
        alphabet, small = self._compact(codes, 0x110000)
        count = len(codes) - self.n + 1
        if count <= 0:
            return np.zeros((0, self.n), np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        packed, size = np.zeros(count, np.int64), len(alphabet)
        for i in range(self.n):
            packed = packed * size + small[i : i + count]
        # An n-gram belongs to the text of its last letter; those that reach over two texts are left out.
        first, last = owner[:count], owner[self.n - 1 : self.n - 1 + count]
        own = (first == last) | ((codes[:count] == 0) & (owner[1 : 1 + count] == last))
        own &= np.any(np.stack([codes[i : i + count] != 0 for i in range(self.n)]), 0) & (last < len(texts))
        distinct, which = self._compact(packed[own], size**self.n)
        rows = np.empty((len(distinct), self.n), np.uint32)
        for i in range(self.n - 1, -1, -1):
            rows[:, i] = alphabet[distinct % size]
            distinct = distinct // size
        return rows, which, last[own]

    @staticmethod
    def _compact(values: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values in order, and the number of each value among them."""
        if bound > TABLE_CELLS:
            return np.unique(values, return_inverse=True)
        seen = np.zeros(bound, bool)
        seen[values] = True
        distinct = np.flatnonzero(seen)
        number = np.zeros(bound, np.int32)
        number[distinct] = np.arange(len(distinct), dtype=np.int32)
        return distinct, number[values]

    def bind(self, grams: np.ndarray) -> np.ndarray:
        """One vector per n-gram."""
        codes, where = np.unique(grams, return_inverse=True)
        where = where.reshape(grams.shape)
        table = np.array([self.letter(int(c)) for c in codes], np.int8).reshape(len(codes), self.dimensions)
        bound = np.ones((len(grams), self.dimensions), np.int8)
        for i in range(self.n):
            bound *= np.roll(table, self.n - 1 - i, axis=1)[where[:, i]]
        return bound

    def bundle(self, texts: list[str], chars: int = 4_000_000):
        """Yields (number of the text, its bundle or None where it has no letter), in order."""
        at = 0
        while at < len(texts):
            size, stop = 0, at
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= chars):
                size, stop = size + len(texts[stop]), stop + 1
            grams, which, owner = self.grams(texts[at:stop])
            # Vectors of the n-grams of a few texts at a time: their number is bounded by the letters read.
            edges = np.searchsorted(owner, np.arange(stop - at + 1))
            bound = self.bind(grams).astype(np.float32) if len(grams) <= 24_000 else None
            for i in range(stop - at):
                own = which[edges[i] : edges[i + 1]]
                if not len(own):
                    yield at + i, None
                    continue
                counts = np.bincount(own, minlength=len(grams))
                used = np.flatnonzero(counts)
                weights = counts[used].astype(np.float32)
                if bound is not None:
                    yield at + i, weights @ bound[used]
                else:
                    parts = (weights[j : j + 4096] @ self.bind(grams[used[j : j + 4096]]).astype(np.float32) for j in range(0, len(used), 4096))
                    yield at + i, sum(parts)
            at = stop


def learn_profiles(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = 1024, n: int = 3, seed: int = 7, max_languages: int = 20_000
) -> Profile:
    """Prototypes of all languages found in rows with a language."""
    source = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def partial(batches):
        bundler, sums = Bundler(dimensions, n, seed), {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            by_lang: dict[str, list[int]] = {}
            for i, lang in enumerate(langs):
                by_lang.setdefault(lang, []).append(i)
            texts = [x.decode() for x in byte_texts(batch.column(1))]
            for lang, rows in by_lang.items():
                grams, which, _ = bundler.grams([texts[i] for i in rows])
                counts = np.bincount(which, minlength=len(grams))
                total = sums.setdefault(lang, np.zeros(dimensions, np.int64))
                for j in range(0, len(grams), 8192):
                    total += np.rint(counts[j : j + 8192].astype(np.float64) @ bundler.bind(grams[j : j + 8192]).astype(np.float64)).astype(np.int64)
        names, task = list(sums), TaskContext.get()
        salts = [((task.partitionId() if task else 0) + i) % 64 for i in range(len(names))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(salts, pa.int32()), pa.array([sums[x].tobytes() for x in names], pa.binary())],
            names=["lang", "salt", "total"],
        )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, np.int64) for x in rows["total"]], axis=0)
        return pd.DataFrame({"lang": rows["lang"].iloc[:1].to_numpy(), "salt": [0], "total": [total.tobytes()]})

    schema = "lang string, salt int, total binary"
    # Added by language and 1 of 64 parts first, then by language.
    sums = source.mapInArrow(partial, schema).groupBy("lang", "salt").applyInPandas(add, schema).groupBy("lang").applyInPandas(add, schema)
    rows = sorted((r.lang, r.total) for r in sums.limit(max_languages + 1).collect())
    if len(rows) > max_languages:
        raise ValueError(f"{lang_col} has more than {max_languages} values: it does not name languages")
    vectors = np.array([np.frombuffer(v, np.int64) for _, v in rows], np.float64).reshape(len(rows), dimensions)
    norms = np.linalg.norm(vectors, axis=1)
    known = [i for i in range(len(rows)) if norms[i] > 0]
    return Profile([rows[i][0] for i in known], (vectors[known] / norms[known, None]).astype(np.float32), n, seed)


FIELDS = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def identify(docs: DataFrame, profile: Profile, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns with ``lang_pred`` and ``score``, the cosine with the prototype (0 where it is negative)."""

    def open_task():
        bundler = Bundler(profile.prototypes.shape[1], profile.n, profile.seed)

        def work(columns: dict[str, pa.Array], texts: list[bytes]) -> list[pa.Array]:
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            if profile.languages:
                for i, bundle in bundler.bundle([x.decode() for x in texts]):
                    if bundle is not None:
                        cosines = profile.prototypes @ bundle / max(float(np.linalg.norm(bundle)), 1e-12)
                        best = int(np.argmax(cosines))
                        langs[i], scores[i] = profile.languages[best], min(1.0, max(0.0, float(cosines[best])))
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

        return work

    return map_texts(docs, text_col, FIELDS, open_task, list(carry))
