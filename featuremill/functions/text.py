"""Query-text kernels: folding, normalisation and the canonical key."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Apostrophe look-alikes folded to one sign, and the letter pair folded together.
QUOTE_SIGNS = "[`'ʻ']"
YO, YE = "ё", "е"

_REGEX_SPECIALS = set(r"\.^$|?*+()[]{}-&#~ ")


def fold_quotes(col: Column) -> Column:
    return F.regexp_replace(col, QUOTE_SIGNS, "'")


def non_blank(col: Column) -> Column:
    """Trimmed text with folded quotes; NULL when nothing is left."""
    return F.nullif(F.trim(fold_quotes(col)), F.lit(""))


def normalise_query(col: Column) -> Column:
    """Lower case, yo->ye, runs of white space to one blank, trimmed."""
    folded = F.regexp_replace(F.lower(col), YO, YE)
    return F.trim(F.regexp_replace(folded, r"\s+", " "))


def has_text(col: Column) -> Column:
    """True for text with at least one visible character; NULL is not text."""
    return F.coalesce(F.length(F.trim(col)) > 0, F.lit(False))


def lowered_key(col: Column) -> Column:
    return F.lower(F.trim(F.replace(col, F.lit(YO), F.lit(YE))))


def stop_word_regex(words: Iterable[str]) -> str | None:
    """Whole-word alternation with longer phrases first, so a phrase wins over its prefix."""
    cleaned = {w.strip().lower() for w in words}
    ordered = sorted((w for w in cleaned if w), key=lambda w: (-len(w), w))
    if not ordered:
        return None
    escaped = ("".join("\\" + c if c in _REGEX_SPECIALS else c for c in w) for w in ordered)
    return r"(?iU)\b(?:" + "|".join(escaped) + r")\b"


def strip_stop_words(col: Column, words: Iterable[str]) -> Column:
    pattern = stop_word_regex(words)
    lowered = F.lower(col)
    if pattern:
        lowered = F.regexp_replace(lowered, pattern, " ")
    return F.trim(F.regexp_replace(lowered, r"(?U)\s+", " "))


def stop_list(lines: Iterable[str]) -> list[str]:
    """Stop words and phrases of a text with one entry a line; blank lines and lines that begin with # are no entries."""
    entries = (line.strip().lower() for line in lines)
    return [e for e in entries if e and not e.startswith("#")]


def read_stop_list(spark: SparkSession, path: str) -> list[str]:
    """The entries of a small text that Spark can read."""
    line = F.trim(F.regexp_replace("value", r"(?U)^\s+|\s+$", ""))
    kept = spark.read.text(path).select(line.alias("line")).where("line <> '' and not startswith(line, '#')")
    return stop_list(r.line for r in kept.collect())


def word_stem(token: Column, suffixes: Iterable[str], min_stem: int = 3) -> Column:
    """The token without the longest of the suffixes that leaves ``min_stem`` letters; one suffix is taken off."""
    known = sorted({x.lower() for x in suffixes if x}, key=lambda x: (-len(x), x))
    if not known:
        return token
    escaped = ("".join("\\" + c if c in _REGEX_SPECIALS else c for c in x) for x in known)
    # The shortest stem that fits has the longest suffix.
    return F.regexp_replace(token, f"^(.{{{min_stem},}}?)(?:{'|'.join(escaped)})$", "$1")


def synonym_groups(groups: Iterable[Iterable[str]]) -> dict[str, str]:
    """The word that stands for each word of a group: the first one in order. Give the words as they are after stemming."""
    made: dict[str, str] = {}
    for group in groups:
        words = sorted({w.strip().lower() for w in group if w.strip()})
        for w in words:
            if made.setdefault(w, words[0]) != words[0]:
                raise ValueError(f"{w!r} is in two groups")
    return made


def canonical_query_key(
    col: Column, stop_words: Iterable[str] = (), suffixes: Iterable[str] = (), synonyms: Mapping[str, str] | None = None, min_stem: int = 3
) -> Column:
    """Word-order-free key: stop words out, tokens to their stems and those to their synonyms, sorted and joined; NULL when nothing is left."""
    tokens = F.split(strip_stop_words(col, stop_words), " ")
    suffixes = list(suffixes)
    if suffixes or synonyms:
        known = F.create_map(*[F.lit(x) for pair in sorted((synonyms or {}).items()) for x in pair]) if synonyms else None

        def form(token: Column) -> Column:
            stem = word_stem(token, suffixes, min_stem)
            return stem if known is None else F.coalesce(F.try_element_at(known, stem), stem)

        tokens = F.transform(tokens, form)
    return F.nullif(F.array_join(F.array_sort(tokens), " "), F.lit(""))


def canonical_key_of_tokens(tokens: Column) -> Column:
    """The same key from an analyser's tokens, ARRAY<STRUCT<position, token>>: of the variants at a position the first in order.

    Tokens without a position or a text are left out; NULL when nothing is left.
    """
    used = F.filter(tokens, lambda t: t["position"].isNotNull() & t["token"].isNotNull())
    positions = F.array_distinct(F.transform(used, lambda t: t["position"]))
    first = F.transform(positions, lambda p: F.array_min(F.transform(F.filter(used, lambda t: t["position"] == p), lambda t: t["token"])))
    return F.nullif(F.array_join(F.array_sort(first), " "), F.lit(""))
