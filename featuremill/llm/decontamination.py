"""Benchmark decontamination with suffix arrays over shards of the documents.

Texts are A-Z lower-cased and read as words of digits, letters and non-ASCII characters. A window is ``window`` consecutive
words of a benchmark item; an item of fewer words, but not none, is one window. A document word inside any occurrence of a
window is hit.

A shard is one Arrow batch of documents. Its suffix array holds the positions where a match can begin (a run of benchmark
words that is long enough), sorted by the words that follow, packed several to an integer. Every test suffix is
binary-searched in it: the range of suffixes that share its first ``window`` words gives all locations, and the
neighbours of its full insertion point give its longest verbatim match. Equal windows are searched once, so a position meets one
window of each length, whatever the number of items that hold it.

The benchmark comes in blocks of bounded size (``block_bytes`` of text); the documents pass all blocks in one stage, without a
shuffle. Defined results: NULL text has no words; an empty benchmark hits nothing; rows with equal ids are separate rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from featuremill.llm.common import byte_texts, map_texts

_WORD_BYTES = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_FOLD = bytes(b if (b := (c + 32 if 65 <= c <= 90 else c)) in _WORD_BYTES else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class TestBlock:
    """Items of one block as word numbers (0 behind each item), and their distinct windows."""

    vocabulary: dict[bytes, int]
    tokens: np.ndarray
    starts: np.ndarray  # of each suffix, in words
    item_of: np.ndarray  # item number of each suffix
    items: list[str]
    first: np.ndarray  # suffix that stands for each distinct window
    lengths: np.ndarray  # words of each distinct window
    holders: list[list[int]]  # item numbers of each distinct window
    deepest: int  # words of the longest item

    @property
    def longest_window(self) -> int:
        return int(self.lengths.max(initial=1))


def test_block(rows: list[tuple[str, str | None]], window: int) -> TestBlock:
    vocabulary: dict[bytes, int] = {}
    tokens, starts, item_of, items, distinct = [], [], [], [], {}
    deepest = 0
    for item, text in rows:
        own = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words((text or "").encode())]
        if not own:
            continue
        length, base = min(window, len(own)), len(tokens)
        deepest = max(deepest, len(own))
        for at in range(len(own)):
            if at + length <= len(own):
                _, holders = distinct.setdefault(tuple(own[at : at + length]), (len(starts), []))
                if not holders or holders[-1] != len(items):
                    holders.append(len(items))
            starts.append(base + at)
            item_of.append(len(items))
        items.append(item)
        tokens += [*own, 0]
    return TestBlock(
        vocabulary, np.array(tokens, np.int32), np.array(starts, np.int64), np.array(item_of, np.int32), items,
        np.array([s for s, _ in distinct.values()], np.int64), np.array([len(k) for k in distinct], np.int64),
        [h for _, h in distinct.values()], deepest,
    )


class SuffixArray:
    """Suffixes of ``tokens`` that begin with at least ``shortest`` non-zero tokens, sorted to ``depth`` tokens.

    Windows need the depth of the longest window only, longest matches that of the longest item.
    """

    def __init__(self, tokens: np.ndarray, top: int, shortest: int, depth: int) -> None:
        self.bits = max(1, int(top).bit_length())
        self.per_key = 62 // self.bits
        self.tokens, self.run = self._runs(tokens)
        at = np.flatnonzero(self.run[: len(tokens)] >= shortest)
        self.levels = -(-depth // self.per_key)
        # Sort by the first keys, then refine only suffixes that are still tied.
        order = at[np.argsort(self.key(self.tokens, self.run, at, 0), kind="stable")]
        group = self._groups(np.zeros(len(order), np.int64), self.key(self.tokens, self.run, order, 0))
        for level in range(1, self.levels):
            tied = np.flatnonzero(np.bincount(group, minlength=1)[group] > 1) if len(group) else group
            if not len(tied):
                break
            keys = self.key(self.tokens, self.run, order[tied], level)
            by = np.lexsort((keys, group[tied]))
            order[tied], keys = order[tied][by], keys[by]
            finer = np.zeros(len(order), np.int64)
            finer[tied] = self._groups(group[tied], keys)
            group = self._groups(group, finer)
        self.order = order

    @staticmethod
    def _groups(coarse: np.ndarray, fine: np.ndarray) -> np.ndarray:
        """Numbers of the runs of equal (coarse, fine)."""
        if not len(coarse):
            return coarse
        new = (np.diff(coarse) != 0) | (np.diff(fine) != 0)
        return np.concatenate([[0], np.cumsum(new)])

    @staticmethod
    def _runs(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens with a zero behind them, and from each position the number of tokens before the next zero."""
        tokens = np.concatenate([tokens, np.zeros(1, np.int32)])
        zeros = np.flatnonzero(tokens == 0)
        at = np.arange(len(tokens))
        return tokens, zeros[np.searchsorted(zeros, at)] - at

    def key(self, tokens: np.ndarray, run: np.ndarray, at: np.ndarray, level: int) -> np.ndarray:
        """``per_key`` tokens from ``at`` on, as one integer in their order; nothing behind a zero counts."""
        made, own = np.zeros(len(at), np.int64), run[at]
        for k in range(level * self.per_key, (level + 1) * self.per_key):
            made = (made << self.bits) | np.where(own > k, tokens[np.minimum(at + k, len(tokens) - 1)], 0)
        return made

    def bounds(self, tokens: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each query (``lengths`` tokens from ``at``, at most the array's depth): the range of suffixes that begin with it."""
        query = (*self._runs(tokens), at, lengths)
        return self._search(*query, False), self._search(*query, True)

    def _search(self, tokens: np.ndarray, run: np.ndarray, at: np.ndarray, lengths: np.ndarray, right: bool) -> np.ndarray:
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(self.order), np.int64)
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) >> 1
            suffix = self.order[mid]
            less, undecided = np.zeros(len(mid), bool), np.arange(len(mid))
            for level in range(self.levels):
                # Only the first tokens of a query count; a level is looked at where all before it were the same.
                q = open_[undecided]
                cut = np.clip((level + 1) * self.per_key - lengths[q], 0, self.per_key) * self.bits
                want = self.key(tokens, run, at[q], level) >> cut
                have = self.key(self.tokens, self.run, suffix[undecided], level) >> cut
                less[undecided[have < want]] = True
                undecided = undecided[have == want]
                if not undecided.size:
                    break
            if right:
                less[undecided] = True
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        return lo

    def longest(self, tokens: np.ndarray, at: np.ndarray, deepest: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each test suffix: words of its longest verbatim match (0: shorter than a window), and where it begins."""
        best, where = np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64)
        if not len(self.order):
            return best, where
        insert, _ = self.bounds(tokens, at, np.full(len(at), deepest))
        tokens = np.concatenate([tokens, np.zeros(deepest + 1, np.int32)])
        held = np.concatenate([self.tokens, np.zeros(deepest + 1, np.int32)])
        for side in (-1, 0):
            near = self.order[np.clip(insert + side, 0, len(self.order) - 1)]
            same, alive = np.zeros(len(at), np.int64), np.arange(len(at))
            for k in range(deepest):
                here = tokens[at[alive] + k]
                alive = alive[(here != 0) & (here == held[near[alive] + k])]
                if not alive.size:
                    break
                same[alive] += 1
            where, best = np.where(same > best, near, where), np.maximum(same, best)
        return best, where


class Shard:
    """The documents of one batch as numbers of benchmark words, with their suffix array."""

    def __init__(self, texts: list[bytes], block: TestBlock, depth: int) -> None:
        get, parts, sizes = block.vocabulary.get, [], []
        for text in texts:
            own = words(text)
            sizes.append(len(own))
            parts.append(np.fromiter(map(get, own, repeat(0)), np.int32, len(own)))
            parts.append(np.zeros(1, np.int32))
        self.block, self.sizes = block, sizes
        self.starts = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)])
        shortest = int(block.lengths.min()) if len(block.lengths) else 1
        self.array = SuffixArray(np.concatenate(parts), len(block.vocabulary) + 1, shortest, max(depth, 1))

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document number and word of each position."""
        doc = np.searchsorted(self.starts, at, "right") - 1
        return doc, at - self.starts[doc]

    def windows(self) -> list[tuple[int, np.ndarray, set[int]]]:
        """Per document: words; merged hit intervals (start, end); numbers of the items with occurring windows."""
        block = self.block
        found: list[tuple[int, np.ndarray, set[int]]] = [(n, np.zeros((0, 2), np.int32), set()) for n in self.sizes]
        if not len(block.first):
            return found
        lo, hi = self.array.bounds(block.tokens, block.starts[block.first], block.lengths)
        counts = hi - lo
        if not counts.sum():
            return found
        which = np.repeat(np.arange(len(counts)), counts)
        doc, begin = self.place(self.array.order[np.repeat(lo - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())])
        by = np.lexsort((begin, doc))
        which, begin, doc = which[by], begin[by], doc[by]
        end = begin + block.lengths[which]
        edges = np.flatnonzero(np.diff(doc)) + 1
        for a, b in zip([0, *edges], [*edges, len(doc)], strict=True):
            ends = np.maximum.accumulate(end[a:b])
            first = np.flatnonzero(np.concatenate([[True], begin[a + 1 : b] > ends[:-1]]))
            spans = np.stack([begin[a:b][first], np.append(ends[first[1:] - 1], ends[-1])], 1).astype(np.int32)
            found[doc[a]] = (self.sizes[doc[a]], spans, {i for w in np.unique(which[a:b]) for i in block.holders[w]})
        return found

    def longest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Test suffixes with a match of a window or more: suffix number, words, document number, word."""
        best, where = self.array.longest(self.block.tokens, self.block.starts, self.block.deepest)
        own = np.flatnonzero(best > 0)
        return own, best[own], *self.place(where[own])


def blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int) -> list[TestBlock]:
    """The benchmark in blocks of about ``block_bytes``, each fetched on its own."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [test_block(sorted((r.item, r.text) for r in items.filter(block == i).collect() if r.text), window) for i in range(n)]


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("hit_spans", SPAN), T.StructField("items", T.ArrayType(T.StringType()))])


def _search_block(docs: DataFrame, text: str, block: TestBlock, carry: list[str], name: str) -> DataFrame:
    def open_task():
        def work(columns: dict[str, pa.Array], texts: list[bytes]) -> list[pa.Array]:
            rows = [
                {"n_words": n, "hit_spans": [{"start": int(a), "end": int(b)} for a, b in spans], "items": sorted({block.items[i] for i in items})}
                for n, spans, items in Shard(texts, block, block.longest_window).windows()
            ]
            return [pa.array(rows, to_arrow_type(FOUND))]

        return work

    return map_texts(docs, text, T.StructType([T.StructField(name, FOUND)]), open_task, carry)


def match_documents(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = 13, block_bytes: int = 8 << 20,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word intervals, merged) and ``items``, in place of columns of these names."""
    found = _with_found(docs, benchmark, text_col, item_col, item_text_col, window, block_bytes)
    kept = [F.col(c) for c in docs.columns if c.lower() not in FOUND.names]
    return found.select(*kept, "_found.*")


def _with_found(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, window: int, block_bytes: int) -> DataFrame:
    """``docs`` with one struct ``_found``."""
    found, made = docs, []
    for i, block in enumerate(blocks(benchmark, item, item_text, window, block_bytes)):
        carry = [*docs.columns, *made]
        made.append(f"_found{i}")
        found = _search_block(found, text, block, carry, made[-1])
    if len(made) == 1:
        return found.withColumnRenamed(made[0], "_found")
    spans = _merged(F.array_sort(F.concat(*[F.col(c)["hit_spans"] for c in made])))
    items = F.array_sort(F.array_distinct(F.concat(*[F.col(c)["items"] for c in made])))
    joint = F.struct(F.col(made[0])["n_words"].alias("n_words"), spans.alias("hit_spans"), items.alias("items"))
    return found.withColumn("_found", joint).drop(*made)


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = 13, block_bytes: int = 8 << 20,
) -> DataFrame:
    """Of each test suffix with a match of a window or more: (item, item_word, n_words, doc, doc_word) of its longest one.

    Each shard reports one match per suffix, so at most (shards x benchmark words) rows are reduced.
    """
    source = docs.select(F.col(id_col).cast("string").alias("doc"), F.col(text_col).alias("text"))
    parts = []
    for block in blocks(benchmark, item_col, item_text_col, window, block_bytes):

        def run(batches, block=block):
            first_of_item = np.searchsorted(block.item_of, np.arange(len(block.items)))
            for batch in batches:
                if batch.num_rows:
                    suffix, n, doc, word = Shard(byte_texts(batch.column(1)), block, block.deepest).longest()
                    item = block.item_of[suffix]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.items[i] for i in item], pa.string()), pa.array(suffix - first_of_item[item]), pa.array(n), batch.column(0).take(pa.array(doc)), pa.array(word)],
                        names=["item", "item_word", "n_words", "doc", "doc_word"],
                    )

        parts.append(source.mapInArrow(run, "item string, item_word long, n_words long, doc string, doc_word long"))
    every = reduce(DataFrame.unionByName, parts)
    best = F.max_by(F.struct("n_words", "doc", "doc_word"), F.struct("n_words", "doc", "doc_word")).alias("best")
    return every.groupBy("item", "item_word").agg(best).select("item", "item_word", "best.*")


def _merged(spans: Column) -> Column:
    """Sorted intervals, with those that overlap or touch made one."""
    none = F.array().cast(SPAN)

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        joins = (F.size(done) > 0) & F.coalesce(x["start"] <= F.try_element_at(done, F.lit(-1))["end"], F.lit(False))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(spans, none, add)


def n_hit(spans: Column) -> Column:
    return F.coalesce(F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]), F.lit(0).cast("long"))


def is_contaminated(hits: Column, n_words: Column) -> Column:
    """Hit in at least a twentieth of its words."""
    return (hits > 0) & (20 * hits >= n_words)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = 13, block_bytes: int = 8 << 20,
) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    found = _with_found(docs, benchmark, text_col, item_col, item_text_col, window, block_bytes)
    return found.filter(~is_contaminated(n_hit(F.col("_found.hit_spans")), F.col("_found.n_words"))).drop("_found")
