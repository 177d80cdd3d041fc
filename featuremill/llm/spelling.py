"""Spelling variants: a bit-sliced position index, searched with at most one error.

Two words are near if one inserted, deleted or replaced code point makes one of the other. The form of a word is its near word
with the largest count (ties: smallest in code-point order), if that is at least ``ratio`` times the word's own count.

Index. For every position and letter one bitset over the words of a block tells which words have that letter there. A query
walks through its letters once and keeps, by word-parallel operations on bitsets of the whole block, the words that equal it so
far (no error) and those with one error so far: replaced (same position), one letter more (next position), one letter less
(previous position). Bitsets of word lengths select what is near at the end.

Blocks. One edit leaves a half of a word alone: of two near words, the shorter of length l, the first or the last l // 2 letters
agree. So a word goes to groups (l, side, half) for l its own length and one less, and near words meet in exactly one of them:
the group of the first half, or, where first halves differ, that of the last half. Groups with more than ``block`` words are
dealt to blocks by hash, and every ordered pair of blocks is a unit of its own: queries of one against the index of the
other. A unit returns one row for each query word with its number of near words and the best of them; pairs are never listed.

Defined results: NULL and empty words are left out; repeated words of the vocabulary count as one with the sum of their counts; an empty
vocabulary gives an empty result. Lengths, positions and order are those of code points; text that is not UTF-8 reads as U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.llm.common import staged

#: Words of a unit's index at most, on average.
BLOCK = 32_768

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class PositionIndex:
    """Bitsets by position and letter over words of length ``shorter`` or one more, which share their first ``same`` letters."""

    def __init__(self, words: list[str], shorter: int, same: int) -> None:
        self.shorter, self.same = shorter, same
        self.full = (1 << len(words)) - 1
        at: list[dict[str, list[int]]] = [{} for _ in range(shorter + 2)]
        long_ = []
        for i, word in enumerate(words):
            for held, letter in zip(at[same:], word[same:], strict=False):
                held.setdefault(letter, []).append(i)
            if len(word) > shorter:
                long_.append(i)
        size = len(words)
        self.at = [{c: _bits(own, size) for c, own in held.items()} for held in at]
        self.long = _bits(long_, size)
        self.short = self.full ^ self.long

    def near(self, word: str) -> int:
        """Bitset of the near words; pairs of two words of the greater length belong to another group."""
        at, same = self.at, self.same
        # All words agree up to ``same``, so that no error and one letter more or less there are open to all.
        equal, full = self.full, self.full
        if len(word) > self.shorter:
            less = full if same else 0
            for i in range(same, len(word)):
                letter = word[i]
                less = (less & at[i - 1].get(letter, 0) if i > same else self._shared(word, i) & less) | equal
                equal &= at[i].get(letter, 0)
            return less & self.short
        replaced, more = 0, full
        for i in range(same, len(word)):
            letter = word[i]
            here = equal & at[i].get(letter, 0)
            replaced = (replaced & at[i].get(letter, 0)) | (equal ^ here)
            equal = here
            more = (more & at[i + 1].get(letter, 0)) | equal
        return (replaced & self.short) | (more & self.long)

    def _shared(self, word: str, i: int) -> int:
        """Words whose letter before position ``i``, in the shared part, is the one at ``i``."""
        return self.full if i and word[i - 1] == word[i] else 0


def _bits(own: list[int], size: int) -> int:
    """A bitset of positions."""
    if len(own) * 64 < size:
        made = 0
        for i in own:
            made |= 1 << i
        return made
    flags = bytearray((size >> 3) + 1)
    for i in own:
        flags[i >> 3] |= 1 << (i & 7)
    return int.from_bytes(flags, "little")


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str = r"[A-Za-zÀ-ÿ]+") -> DataFrame:
    """(id, word) of every maximal run of the pattern's letters, with A-Z lower-cased."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(0))
    return docs.select(F.col(id_col), F.explode(runs).alias("word")).withColumn("word", F.translate("word", UPPER, LOWER))


def vocabulary(words: DataFrame, min_length: int = 7, min_count: int = 2) -> DataFrame:
    """(word, n) of the words with at least ``min_length`` code points and ``min_count`` occurrences."""
    counted = words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _unit_rows(vocab: DataFrame, block: int) -> DataFrame:
    """(l, side, half, qb, ib, role, word, n): words of each unit; role 1 asks, 2 is in the index, 3 does both."""
    length = F.length("word")
    lengths = vocab.withColumn("l", F.explode(F.array(length, length - 1))).filter("l > 0")
    reach = F.floor(F.col("l") / 2).cast("int")
    sides = F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.substring("word", F.lit(1), reach).alias("half")),
        F.struct(F.lit(1).alias("side"), F.substring("word", length - reach + 1, reach).alias("half")),
    ))
    rows = lengths.withColumn("s", sides).select("l", "s.side", "s.half", "word", "n")
    sizes = rows.groupBy("l", "side", "half").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = rows.join(sizes, ["l", "side", "half"]).withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    whole = dealt.filter("blocks = 1").select("l", "side", "half", F.lit(0).alias("qb"), F.lit(0).alias("ib"), F.lit(3).alias("role"), "word", "n")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    large = dealt.filter("blocks > 1").select("l", "side", "half", "own", other, "word", "n")
    asks = large.select("l", "side", "half", F.col("own").alias("qb"), F.col("other").alias("ib"), F.lit(1).alias("role"), "word", "n")
    held = large.select("l", "side", "half", F.col("other").alias("qb"), F.col("own").alias("ib"), F.lit(2).alias("role"), "word", "n")
    return whole.unionByName(asks).unionByName(held)


def unit_results(shorter: int, side: int, rows: list[tuple[int, str, int]]) -> list[tuple[str, int, str, int]]:
    """(word, n_near, best, best_n) of the query words of one unit that have near words; rows are (role, word, n)."""
    reach = shorter // 2
    # The first of a set of words is the best of them.
    index = sorted((x for x in rows if x[0] & 2), key=lambda x: (-x[2], x[1]))
    turned = [w[::-1] if side else w for _, w, _ in index]
    bits = PositionIndex(turned, shorter, reach)
    apart: dict[str, int] = {}
    if side:  # pairs that share the first half too are found there
        for i, (_, w, _) in enumerate(index):
            apart[w[:reach]] = apart.get(w[:reach], 0) | 1 << i
    made = []
    for role, word, _ in rows:
        if role & 1:
            near = bits.near(word[::-1] if side else word)
            if side:
                near &= ~apart.get(word[:reach], 0)
            if near:
                _, best, n = index[(near & -near).bit_length() - 1]
                made.append((word, near.bit_count(), best, n))
    return made


FOUND = "word string, n_near long, best string, best_n long"


def near_words(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, best, best_n) of every word; ``best`` is its near word of the largest n, NULL if it has none."""
    vocab = vocab.filter(F.length("word") > 0).groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    vocab = staged(vocab, "vocabulary")
    unit = ["l", "side", "half", "qb", "ib"]
    dealt = _unit_rows(vocab, block).repartition(*unit).sortWithinPartitions(*unit).select(*unit, "role", "word", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays(
                [pa.array([*map(itemgetter(i), out)], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.int64()))], names=["word", "n_near", "best", "best_n"]
            )
            out.clear()

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for here, row in zip(zip(*columns[:5], strict=True), zip(*columns[5:], strict=True), strict=True):
                if here != key:
                    if len(rows) > 1:
                        out += unit_results(key[0], key[1], rows)
                    key, rows = here, []
                rows.append(row)
            if len(out) >= 10_000:
                yield from flush()
        if len(rows) > 1:
            out += unit_results(key[0], key[1], rows)
        yield from flush()

    best = F.min_by(F.struct("best", "best_n"), F.struct(-F.col("best_n"), F.col("best"))).alias("b")
    found = dealt.mapInArrow(run, FOUND).groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return vocab.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("b.best").alias("best"), F.col("b.best_n").alias("best_n")
    )


def spelling_forms(vocab: DataFrame, ratio: int = 10, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word; the root is the last of its chain of forms, or the word itself."""
    common = F.col("best_n") >= ratio * F.col("n")
    near = staged(near_words(vocab, block).select(
        "word", F.when(common, F.col("best")).alias("form"), "n", "n_near", F.when(common, F.col("best_n")).alias("form_n")
    ), "near-words")
    # A form has at least ``ratio`` times the count, so chains are short; each round doubles the steps taken.
    links = staged(near.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    while True:
        up = links.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        on = staged(links.join(up, links["root"] == up["_at"], "left").select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved")), "roots")
        links = on.drop("moved")
        if on.filter("moved").isEmpty():
            break
    rooted = near.join(links, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def without_point(word: Column, at: Column) -> Column:
    """The word without its code point number ``at``, from 0."""
    return F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
