"""Text quality by weak supervision: rules vote or abstain, and the votes are weighed by accuracies that no label teaches.

Each rule votes keep (1), reject (0) or abstains (NULL). Expectation-maximisation fits the share of good documents, and for
every rule its chance of a keep vote on good and on bad documents; the posterior probability of being good is the verdict.
Abstentions say nothing. Weak Beta priors start each rule as right more often than wrong and keep the classes from changing
places. Spark counts the vote patterns; the steps run on these counts, which are at most 3 to the power of the number of rules
whatever the corpus.

Everything is Column expressions: the repeated windows of a text are found on arrays, by hashes of eight words built from hashes
of four and two, so no row is exploded and no text is shuffled.

Defined results: NULL text is empty text and fails the base rules; a table that is empty, or whose rules all abstain, leaves the
priors as they are; rows with equal ids are separate rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.llm.common import staged

SPACE = r"[\x20\x09-\x0D]"
WINDOW = 8
#: A word of prose: letters, inner apostrophes or hyphens, or a number, with at most one mark behind it.
PLAIN = r"^[\"'(]?[\p{L}\p{M}\p{N}]+(['’.,-][\p{L}\p{M}\p{N}]+)*[.,;:!?)\"']?$"

#: Counts that the rules look at.
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_capitals", "n_exclaims", "n_letters", "n_plain")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _shifted(hashes: Column, by: int) -> Column:
    """Hash of each place with the one ``by`` places on."""
    return F.zip_with(hashes, F.slice(hashes, by + 1, F.size(hashes)), lambda a, b: F.xxhash64(a, b))


def _window_hashes(words: Column) -> Column:
    """A hash for each window of eight words."""
    eights = _let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: _let(_shifted(h, 1), lambda h2: _let(_shifted(h2, 2), lambda h4: _shifted(h4, 4))),
    )
    return F.slice(eights, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))


def _covered(windows: Column) -> Column:
    """Words in windows found twice or more."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def equal(all_: Column, x: Column, at: Column) -> Column:
        return F.coalesce(F.get(all_, at)["h"] == x["h"], F.lit(False))

    twice = _let(placed, lambda s: F.filter(s, lambda x, i: equal(s, x, i - 1) | equal(s, x, i + 1)))
    starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
    steps = _let(starts, lambda p: F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))))
    total = F.aggregate(steps, F.lit(0), lambda n, x: n + x)
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(total)


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with one struct ``_quality`` of the counts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(text, f"{SPACE}+", -1), "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counts(words: Column, lines: Column) -> Column:
        made = {
            "n_words": F.size(words),
            "word_chars": F.char_length(F.array_join(words, "")),
            "n_symbols": F.char_length(text) - F.char_length(F.regexp_replace(text, r"[#*$%&|<>]", "")),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": _let(_window_hashes(words), _covered),
            "n_lines": F.size(lines),
            "n_distinct_words": F.size(F.array_distinct(words)),
            "n_capitals": F.char_length(text) - F.char_length(F.regexp_replace(text, r"\p{Lu}", "")),
            "n_exclaims": F.char_length(text) - F.char_length(F.replace(text, F.lit("!"), F.lit(""))),
            "n_letters": F.char_length(F.regexp_replace(text, r"[^\p{L}\p{M}]+", "")),
            "n_plain": F.size(F.filter(words, lambda w: w.rlike(PLAIN))),
        }
        return F.struct(*[made[c].cast("long").alias(c) for c in FEATURES])

    return docs.withColumn("_quality", _let(words, lambda w: _let(lines, lambda x: counts(w, x))))


@dataclass(frozen=True)
class Rule:
    """Votes by a rate: keep on the side of ``keep``, reject beyond ``reject``, abstain between."""

    name: str
    above: str
    below: str
    keep: float
    reject: float

    def vote(self, counts: Callable[[str], Column]) -> Column:
        rate = counts(self.above) / F.greatest(counts(self.below), F.lit(1))
        if self.keep < self.reject:
            return F.when(rate <= self.keep, 1).when(rate > self.reject, 0)
        return F.when(rate >= self.keep, 1).when(rate < self.reject, 0)


RULES = (
    Rule("symbols per word", "n_symbols", "n_words", 0.02, 0.2),
    Rule("letters per character", "n_letters", "word_chars", 0.92, 0.88),
    Rule("share of plain words", "n_plain", "n_words", 0.8, 0.6),
    Rule("capitals per character", "n_capitals", "word_chars", 0.2, 0.5),
    Rule("exclamation marks per word", "n_exclaims", "n_words", 0.05, 0.3),
    Rule("share of words in repeated windows", "n_repeat_words", "n_words", 0.05, 0.2),
    Rule("share of repeated lines", "n_dup_lines", "n_lines", 0.1, 0.4),
    Rule("characters per word", "word_chars", "n_words", 12.0, 20.0),
    Rule("words per distinct word", "n_words", "n_distinct_words", 4.0, 12.0),
)


@dataclass(frozen=True)
class QualityModel:
    """Share of good documents, and each rule's chance of a keep vote on good and on bad ones."""

    good: float
    keep_if_good: tuple[float, ...]
    keep_if_bad: tuple[float, ...]

    def posterior(self, votes: list[Column]) -> Column:
        odds = F.lit(log(self.good / (1 - self.good)))
        for vote, a, b in zip(votes, self.keep_if_good, self.keep_if_bad, strict=True):
            odds = odds + F.when(vote == 1, log(a / b)).when(vote == 0, log((1 - a) / (1 - b))).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))

    def posterior_of(self, votes: tuple[int | None, ...]) -> float:
        odds = log(self.good / (1 - self.good))
        for vote, a, b in zip(votes, self.keep_if_good, self.keep_if_bad, strict=True):
            if vote is not None:
                odds += log(a / b) if vote else log((1 - a) / (1 - b))
        return 1 / (1 + exp(-odds)) if odds > -700 else 0.0


PRIOR = QualityModel(0.8, (0.95,) * len(RULES), (0.6,) * len(RULES))


def votes_of(counts: Callable[[str], Column]) -> list[Column]:
    return [rule.vote(counts) for rule in RULES]


def _counts(name: str) -> Column:
    return F.col("_quality")[name]


def learn(featured: DataFrame, steps: int = 60, weight: float = 4.0, prior: QualityModel = PRIOR) -> QualityModel:
    """Fit to the vote patterns of ``featured``; the prior counts as ``weight`` documents."""
    names = [f"v{j}" for j in range(len(RULES))]
    votes = [v.alias(c) for v, c in zip(votes_of(_counts), names, strict=True)]
    counted = featured.select(*votes).groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()
    return fit([(tuple(r[c] for c in names), r["n"]) for r in sorted(counted, key=str)], steps, weight, prior)


def fit(patterns: list[tuple[tuple[int | None, ...], int]], steps: int, weight: float, prior: QualityModel) -> QualityModel:
    """Expectation-maximisation on (votes, number of documents)."""
    model, rules = prior, range(len(prior.keep_if_good))
    for _ in range(steps):
        good = total = 0.0
        # For each rule and class: documents with a keep vote, documents with a vote.
        sums = [[[0.0, 0.0], [0.0, 0.0]] for _ in rules]
        for votes, n in patterns:
            q = model.posterior_of(votes)
            good, total = good + n * q, total + n
            for j in rules:
                if votes[j] is not None:
                    for own, part in zip(sums[j], (n * q, n * (1 - q)), strict=True):
                        own[0] += part * votes[j]
                        own[1] += part
        model = QualityModel(
            (good + weight * prior.good) / (total + weight),
            tuple((sums[j][0][0] + weight * prior.keep_if_good[j]) / (sums[j][0][1] + weight) for j in rules),
            tuple((sums[j][1][0] + weight * prior.keep_if_bad[j]) / (sums[j][1][1] + weight) for j in rules),
        )
    return model


def base_failed() -> Column:
    return (_counts("n_words") < 20) | (100 * _counts("n_repeat_words") > 30 * _counts("n_words"))


def judged(featured: DataFrame, model: QualityModel) -> DataFrame:
    """``featured`` with ``base_failed``, ``quality`` (posterior) and ``kept`` in a struct ``_verdict``."""
    quality = model.posterior(votes_of(_counts))
    verdict = F.struct(base_failed().alias("base_failed"), quality.alias("quality"), (~base_failed() & (quality >= 0.5)).alias("kept"))
    return featured.withColumn("_verdict", verdict)


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts, base_failed, quality, kept) of every row; texts are read once."""
    featured = staged(with_features(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text").select("_id", "_quality"), "quality")
    return judged(featured, learn(featured)).select(F.col("_id").alias(id_col), *[_counts(c).alias(c) for c in FEATURES], "_verdict.*")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that are kept, with their own columns; texts are read once, rows and counts staged to learn and to filter."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text_col).alias("_text"))
    featured = staged(with_features(rows, "_text").select("_row", "_quality"), "quality")
    return judged(featured, learn(featured)).filter(F.col("_verdict.kept")).select("_row.*")
