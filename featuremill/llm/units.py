"""Encoding texts by their distinct space-separated units, exactly as the whole text would be.

The split pattern of byte-level BPE starts a new match at every single space between two characters that are not white
space: no alternative goes on from such a character into a space, and the space opens the match of what follows it. Cutting a
text there and encoding every piece on its own gives the same tokens, so each distinct piece is encoded once per task.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from typing import Any

import numpy as np

# White space in Python holds all of the pattern's white space, so a cut is never made where the pattern sees one.
_ODD_SPACE = re.compile(r"\s | \s")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def cut(text: str) -> tuple[str, list[str]]:
    """The first unit, and the others without the space that begins each of them."""
    head, *rest = _CUT.split(text) if _ODD_SPACE.search(text) else text.split(" ")
    return head, rest


def one_thread() -> None:
    """A task has one core: the tokenizers library must not start threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


class UnitEncoder:
    """Ids of units by a byte-level tokenizer, ``together`` units to a text.

    Units that begin with a single space and end with a character that is not white space may stand side by side: the text
    of several is cut back into them by the bytes of its tokens. All others are encoded alone.
    """

    def __init__(self, tokenizer: Any, together: int = 100) -> None:
        self.tokenizer, self.together = tokenizer, together
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)  # one character stands for one byte
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def _alone(self, units: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def _joins(self, unit: str) -> bool:
        return len(unit) > 1 and unit[0] == " " and not unit[1].isspace() and not unit[-1].isspace() and not any(x in unit for x in self.added)

    def __call__(self, units: list[str]) -> list[list[int]]:
        made: list[list[int]] = [[]] * len(units)
        joining = [i for i, u in enumerate(units) if self._joins(u)]
        alone = sorted({*range(len(units))} - {*joining})
        groups = [joining[a : a + self.together] for a in range(0, len(joining), self.together)]
        for group, ids in zip(groups, self._alone(["".join([units[i] for i in g]) for g in groups]), strict=True):
            ends, wanted = np.cumsum(self.sizes[ids]), np.cumsum([len(units[i].encode()) for i in group])
            cuts = np.searchsorted(ends, wanted, "right")
            if len(ends) and (cuts > 0).all() and np.array_equal(ends[cuts - 1], wanted):
                for i, a, b in zip(group, [0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
                    made[i] = ids[a:b]
            else:
                alone += group
        for i, ids in zip(alone, self._alone([units[i] for i in alone]), strict=True):
            made[i] = ids
        return made


class UnitMemo:
    """Results of ``encode`` by unit; holds at most about ``limit`` short units between calls."""

    def __init__(self, encode: Callable[[list[str]], list[Any]], limit: int = 250_000, longest: int = 64) -> None:
        self.encode, self.limit, self.longest = encode, limit, longest
        self.first: dict[str, Any] = {}
        self.spaced: dict[str, Any] = {}

    def _fill(self, memo: dict[str, Any], wanted: set[str], prefix: str) -> None:
        new = [x for x in wanted if x not in memo]
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            memo.update(zip(part, self.encode([prefix + x for x in part]), strict=True))

    def results(self, texts: Iterable[str], chars: int = 2_000_000) -> Iterator[list[Any]]:
        """One list of unit results for each text; texts are taken together up to about ``chars`` characters."""
        todo = iter(texts)
        while part := list(_up_to(todo, chars)):
            pieces = [cut(x) for x in part]
            self._fill(self.first, {head for head, _ in pieces}, "")
            self._fill(self.spaced, set().union(*(rest for _, rest in pieces)), " ")
            get = self.spaced.__getitem__
            for head, rest in pieces:
                yield [self.first[head], *map(get, rest)]
            for memo in (self.first, self.spaced):
                if len(memo) > self.limit:
                    # The oldest entries are the frequent ones: they were met first.
                    kept = dict(islice(((k, v) for k, v in memo.items() if len(k) <= self.longest), self.limit // 2))
                    memo.clear()
                    memo.update(kept)


def _up_to(texts: Iterator[str], chars: int) -> Iterator[str]:
    total = 0
    for text in texts:
        yield text
        total += len(text)
        if total >= chars:
            return
